"""Registered queries of the corpus operators, each over its whole table, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import (exact_dedup, filter_audit, html_content, mixing, near_join, notice_search, positional_index, quality, rotated_centroids,
               template_lines, token_output, toxicity, warc_index)
from .common import read_table


def op4_mix_sources(spark, sf_dir):
    m = mixing.mix(read_table(spark, sf_dir, "documents"))
    return m.select("doc_id", "size", "source_size", "target", "taken", "source", "copies", "partial")


QUERIES = {"op4_mix_sources": op4_mix_sources}

_MIX_SYMBOLS = mixing.SYMBOLS.replace("'", "''")
ORACLE = {
    "op4_mix_sources": rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         (('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u
  FROM documents),
k AS (
  SELECT doc_id, source, size,
         -ln(u) / (0.1 + 0.9 * CASE WHEN length(text) > 0
            THEN length(translate(text, '{_MIX_SYMBOLS}', ''))::DOUBLE / length(text) ELSE 1.0 END) AS key
  FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM k GROUP BY source),
w AS (SELECT *, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight,
             2 * source_size AS cap FROM s),
f AS (SELECT *, (sum(source_size) OVER () * 1.5
        - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
        / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lv FROM w),
t AS (SELECT *, least(cap::DOUBLE, weight * (SELECT max(lv) FROM f WHERE cap >= lv * weight)) AS target FROM f),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM t),
p AS (SELECT k.*, e.source_size, e.target, e.epochs, round(e.target)::BIGINT - e.epochs * e.source_size AS rest,
             coalesce(sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
      FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source),
q AS (SELECT *, greatest(0, least(size, rest - ahead))::BIGINT AS part FROM p)
SELECT doc_id, size, source_size, target, (epochs * size + part)::BIGINT AS taken, source,
       (epochs + CASE WHEN part = size AND size > 0 THEN 1 ELSE 0 END)::BIGINT AS copies,
       (CASE WHEN part = size AND size > 0 THEN 0 ELSE part END)::BIGINT AS partial
FROM q""",
}


def op5_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_duplicates(read_table(spark, sf_dir, "documents"))


QUERIES["op5_exact_dedup"] = op5_exact_dedup
ORACLE["op5_exact_dedup"] = r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents),
r AS (SELECT *, first_value(doc_id) OVER w AS keep_id, row_number() OVER w = 1 AS kept, count(*) OVER (PARTITION BY text_sha256) AS group_size
      FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY doc_id NULLS LAST))
SELECT doc_id, keep_id, group_size, kept, text_sha256 FROM r"""


def op10_warc_index(spark, sf_dir):
    return warc_index.archive_round_trip(read_table(spark, sf_dir, "pages")).drop("url")


QUERIES["op10_warc_index"] = op10_warc_index


def op8_token_output(spark, sf_dir):
    return token_output.token_round_trip(read_table(spark, sf_dir, "documents"))


QUERIES["op8_token_output"] = op8_token_output


def op3_decontaminate(spark, sf_dir):
    return positional_index.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")).drop("key")


QUERIES["op3_decontaminate"] = op3_decontaminate
# the word class of DuckDB's regular expressions needs no escapes below; A-Z are lower-cased one by one
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
ORACLE["op3_decontaminate"] = rf"""
WITH b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, array_to_string(w[s + 1 : s + 10], ' ') AS phrase, least(10, len(w)) AS n
        FROM (SELECT *, unnest(range(0, greatest(len(w) - 10, 0) + 1)) AS s FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM win),
d AS (SELECT doc_id, row_number() OVER () AS rid, {_WORDS} AS w FROM documents),
grams AS (SELECT rid, n, s, array_to_string(w[s + 1 : s + n], ' ') AS phrase
          FROM (SELECT rid, w, n, unnest(range(0, len(w) - n + 1)) AS s FROM d, lens WHERE len(w) >= n)),
hits AS (SELECT g.rid, g.s, g.n, win.item_id FROM grams g JOIN win ON g.phrase = win.phrase AND g.n = win.n),
per AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(s, s + n)) AS p FROM hits) GROUP BY rid),
its AS (SELECT rid, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
        FROM (SELECT DISTINCT rid, item_id::VARCHAR AS item FROM hits) GROUP BY rid)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN per USING (rid) LEFT JOIN its USING (rid)"""


def op7_template_lines(spark, sf_dir):
    d = template_lines.drop_template_lines(read_table(spark, sf_dir, "documents"))
    return d.select(F.col("row.doc_id").alias("doc_id"), "text", "n_lines", "n_dropped")


def _template_level_sql(k: int, last: bool) -> str:
    """The constants of every node of level ``k``, the lines alike, and the lines of the next level."""
    sql = f"""
node{k} AS (SELECT node, sum(docs) AS node_docs FROM o{k} GROUP BY node HAVING sum(docs) >= 10 AND count(*) > 1),
tok{k} AS (SELECT line, n, node, docs, node_docs, unnest(range(1, n + 1)) AS p, unnest(w) AS token FROM o{k} JOIN node{k} USING (node)),
wt{k} AS (SELECT node, p, token, sum(docs) AS weight, sum(docs) * 2 > node_docs AS con FROM tok{k} GROUP BY node, p, token, node_docs),
like{k} AS (SELECT line, node, docs FROM tok{k} JOIN wt{k} USING (node, p, token) WHERE con GROUP BY line, n, node, docs HAVING count(*) >= n * 0.6),
alike{k} AS (SELECT line, node FROM like{k} JOIN (SELECT node FROM like{k} GROUP BY node HAVING sum(docs) >= 10) USING (node)),"""
    return sql if last else sql + f"""
at{k} AS (SELECT node, arg_min(p, (-weight, p)) AS p FROM wt{k} WHERE weight >= 10 AND NOT con GROUP BY node),
o{k + 1} AS (SELECT line, w, n, docs, o{k}.node || '/' || at{k}.p || '=' || coalesce(wt{k}.token, '') AS node
       FROM o{k} JOIN at{k} USING (node) LEFT JOIN wt{k} ON wt{k}.node = o{k}.node AND wt{k}.p = at{k}.p AND wt{k}.token = w[at{k}.p] AND weight >= 10
       WHERE NOT EXISTS (SELECT 1 FROM alike{k} a WHERE a.line = o{k}.line)),"""


QUERIES["op7_template_lines"] = op7_template_lines
ORACLE["op7_template_lines"] = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, text FROM documents),
l AS (SELECT rid, i, string_split(coalesce(text, ''), chr(10))[i] AS raw,
             trim(regexp_replace(regexp_replace(string_split(coalesce(text, ''), chr(10))[i], '[^\x20\x09-\x0D]*[0-9][^\x20\x09-\x0D]*', '<*>', 'g'),
                                 '[\x20\x09\x0B-\x0D]+', ' ', 'g'), ' ') AS line
      FROM (SELECT rid, text, unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS i FROM d)),
t AS (SELECT *, string_split(line, ' ') AS w FROM l),
u AS (SELECT line, len(w) AS n, array_to_string(w[1:2], ' ') AS lead, w, count(DISTINCT rid) AS docs FROM t WHERE line <> '' GROUP BY ALL),
o0 AS (SELECT line, w, n, docs, n || ':' || lead AS node FROM u WHERE n >= 4),
""" + "".join(_template_level_sql(k, k == template_lines.LEVELS) for k in range(template_lines.LEVELS + 1)) + r"""
alike AS (""" + " UNION ALL ".join(f"SELECT line, node FROM alike{k}" for k in range(template_lines.LEVELS + 1)) + r"""),
general AS (SELECT line FROM alike JOIN (SELECT node FROM alike JOIN t USING (line) GROUP BY node HAVING count(DISTINCT rid) >= 10) USING (node)),
bad AS (SELECT line FROM u WHERE docs >= 10 UNION SELECT line FROM general),
r AS (SELECT rid, i, raw, line IN (SELECT line FROM bad) AS gone FROM t)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(g.kept, '') END AS text,
       CASE WHEN d.text IS NULL THEN 0 ELSE g.n_lines END AS n_lines, g.n_dropped
FROM d JOIN (SELECT rid, string_agg(raw, chr(10) ORDER BY i) FILTER (NOT gone) AS kept, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped
             FROM r GROUP BY rid) g USING (rid)"""


def op1_toxicity(spark, sf_dir):
    return toxicity.toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op2_quality(spark, sf_dir):
    return quality.quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


QUERIES["op1_toxicity"] = op1_toxicity
QUERIES["op2_quality"] = op2_quality


def op6_html_content(spark, sf_dir):
    return html_content.main_text(read_table(spark, sf_dir, "pages"))


QUERIES["op6_html_content"] = op6_html_content


def op9_near_join(spark, sf_dir):
    return near_join.near_duplicates(read_table(spark, sf_dir, "documents"))


QUERIES["op9_near_join"] = op9_near_join


def op11_license_notices(spark, sf_dir):
    return notice_search.license_query(read_table(spark, sf_dir, "documents"))


QUERIES["op11_license_notices"] = op11_license_notices


def op12_filter_audit(spark, sf_dir):
    return filter_audit.audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


QUERIES["op12_filter_audit"] = op12_filter_audit
ORACLE["op12_filter_audit"] = r"""
WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
f AS (SELECT part, (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT
             + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text))::INT + 8 * regexp_matches(text, '[#$%&*|]')::INT
             + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)::INT AS m,
             coalesce(doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL), false) AS good,
             coalesce(doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL), false) AS toxic FROM t),
c AS (SELECT part, m, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f GROUP BY part, m),
b AS (SELECT unnest([0, 1, 2, 3, 4]) AS x),
o AS (SELECT [p.x, q.x, r.x, s.x, u.x] AS bits FROM b p, b q, b r, b s, b u
      WHERE len(list_distinct([p.x, q.x, r.x, s.x, u.x])) = 5),
st AS (SELECT array_to_string(list_transform(bits, lambda x: substr('ABCDE', x + 1, 1)), '') AS filter_order, step, (1 << bits[step])::BIGINT AS own,
              coalesce(list_sum(list_transform(bits[1:step - 1], lambda x: 1 << x)), 0)::BIGINT AS passed FROM (SELECT bits, unnest(range(1, 6)) AS step FROM o)),
r AS (SELECT part, filter_order, step, own,
             sum(CASE WHEN m & (passed | own) = 0 THEN n ELSE 0 END) AS kept, sum(CASE WHEN m & passed = 0 AND m & own <> 0 THEN n ELSE 0 END) AS removed,
             sum(CASE WHEN m & passed <> 0 AND m & own <> 0 THEN n ELSE 0 END) AS redundant, sum(CASE WHEN m = own THEN n ELSE 0 END) AS unique_fails,
             sum(CASE WHEN m & passed = 0 AND m & own <> 0 THEN good ELSE 0 END) AS good_lost,
             sum(CASE WHEN m & passed = 0 AND m & own <> 0 THEN toxic ELSE 0 END) AS toxic_lost
      FROM c, st GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
       good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM r"""


def op13_rotated_centroids(spark, sf_dir):
    return rotated_centroids.clustered(read_table(spark, sf_dir, "embeddings"))


QUERIES["op13_rotated_centroids"] = op13_rotated_centroids


def _centroid_sql() -> str:
    """Rounds written out one after the other; components in rows."""
    steps = [f"""
WITH e AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = {rotated_centroids.LENGTH} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {rotated_centroids.LENGTH}),
x AS MATERIALIZED (SELECT rid, unnest(range(1, {rotated_centroids.LENGTH + 1})) AS i, unnest(v) AS q FROM e),
s AS (SELECT row_number() OVER (ORDER BY sha256('{rotated_centroids.SEED}:' || coalesce(vec_id::VARCHAR, '')), v) - 1 AS c, v FROM e),
c0 AS MATERIALIZED (SELECT c, unnest(range(1, {rotated_centroids.LENGTH + 1})) AS i, unnest(v) AS q FROM s WHERE c < {rotated_centroids.K})"""]
    for r in range(rotated_centroids.ROUNDS + 1):
        steps.append(f"""
d{r} AS (SELECT x.rid, c.c, sum((x.q - c.q) * (x.q - c.q))::BIGINT AS dist FROM x JOIN c{r} c ON x.i = c.i GROUP BY x.rid, c.c),
a{r} AS MATERIALIZED (SELECT rid, arg_min(c, dist * {rotated_centroids.K} + c) AS c, min(dist) AS dist FROM d{r} GROUP BY rid)""")
        if r < rotated_centroids.ROUNDS:
            steps.append(f"""
m{r} AS (SELECT a.c, x.i, sum(x.q) AS t, count(*) AS n FROM a{r} a JOIN x ON a.rid = x.rid GROUP BY a.c, x.i),
c{r + 1} AS MATERIALIZED (SELECT c.c, c.i, coalesce(((t - ((t % n) + n) % n) // n)::BIGINT, c.q) AS q FROM c{r} c LEFT JOIN m{r} m ON c.c = m.c AND c.i = m.i)""")
    last = rotated_centroids.ROUNDS
    return ",".join(steps) + f"""
SELECT e.vec_id, a.c::INT AS cluster, a.dist AS distance, (sum(a.dist) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia, (sum(a.dist) OVER ())::BIGINT AS inertia, h.sha AS centroid_sha256
FROM a{last} a JOIN e ON a.rid = e.rid JOIN (SELECT c, sha256(string_agg(q::VARCHAR, ',' ORDER BY i)) AS sha FROM c{last} GROUP BY c) h ON a.c = h.c"""


ORACLE["op13_rotated_centroids"] = _centroid_sql()
