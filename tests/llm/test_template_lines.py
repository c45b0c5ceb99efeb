"""Template lines: planted boilerplate goes, prose stays."""

from alpina.llm import template_lines as L

# extra columns carry the operator's own column names
SCHEMA = "doc_id long, text string, n_lines int, leaf string, no int"


def test_recurring_lines_go_and_prose_stays(spark):
    rows, names = [], "amy bob cat dan eve fay gus hal ida jon kim lee".split()
    for i in range(12):
        rows.append((i, f"{names[i]} wrote prose of no other kind\nLicensed  under the terms of use\nPosted on 20{i}-01-02 by user{i} in news\n"
                        f"shared by {names[i]} with all friends today\n\nok"))
    rows += [(100, None), (101, ""), (102, "Licensed under the terms of use"), (103, "the end of all things\nthe start of some things"),
             (104, "x" * 200_000 + " 1"), (105, "shared by nobody at any other time"), (102, "Licensed under the terms of use"), (None, "Posted on 9 by x9 in news")]
    df = spark.createDataFrame([(*r, 1, "l", 2) for r in rows], SCHEMA)
    got = {}
    for r in L.drop_template_lines(df).collect():
        got.setdefault(r.row.doc_id, []).append((r.text, r.n_lines, r.n_dropped))
    for i in range(12):
        assert got[i] == [(f"{names[i]} wrote prose of no other kind\n", 6, 4)]  # short lines recur as any other
    assert got[100] == [(None, 0, 0)] and got[101] == [("", 1, 0)]
    assert got[102] == [("", 1, 1)] * 2 and got[None] == [("", 1, 1)]
    assert got[103][0][2] == 0 and got[104][0][2] == 0 and got[105][0][2] == 0


def test_empty(spark):
    assert L.drop_template_lines(spark.createDataFrame([], SCHEMA)).count() == 0


def test_templates_of_one_leaf_are_found_among_prose(spark):
    names = "amy bob cat dan eve fay gus hal ida jon kim lee".split()
    rows = [(i, f"shared by {m} with all friends today\nshared by {m} under some other terms") for i, m in enumerate(names)]
    # prose of the same leaf outweighs both templates; no two lines have more than their first words and one other in common
    prose = [f"shared by a{chr(97 + i)} b{chr(97 + i)} c{chr(97 + i)} d{chr(97 + i)} {'now' if i % 2 else 'e' + chr(97 + i)}" for i in range(26)]
    rows += [(100 + i, t) for i, t in enumerate(prose)]
    # ten like lines in one document recur in no other
    rows += [(200, "\n".join(f"listed as {m} in this one table" for m in names))]
    got = {r.row.doc_id: (r.text, r.n_dropped) for r in L.drop_template_lines(spark.createDataFrame([(*r, 1, "l", 2) for r in rows], SCHEMA)).collect()}
    assert all(got[i] == ("", 2) for i in range(12))
    assert all(got[100 + i] == (t, 0) for i, t in enumerate(prose))
    assert got[200][1] == 0
