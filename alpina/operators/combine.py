"""Merge table variants by id with per-column coalescing.

n inputs become one ``unionByName`` tagged with the input's position and a
single aggregation on the id: for every column the first non-null value in
input order wins. One shuffle for any number of inputs, no chain of n-1 full
outer joins. The same aggregation counts each id's rows per input: a null id,
or an id that an input holds twice, fails the job instead of losing rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def combine(dfs: list[DataFrame], id_col: str = "observation_uuid", how: str = "union") -> DataFrame:
    """J4 (``how='union'``) / J5 (``'intersect'``): one row per id.

    Output columns: id first, then the first input's columns, then new ones in
    input order. Same-named columns of different types are merged as text.
    """
    if not dfs:
        raise ValueError("no input to combine")
    if how not in ("union", "intersect"):
        raise ValueError("how must be 'union' or 'intersect'")
    for i, d in enumerate(dfs):
        if id_col not in d.columns:
            raise ValueError(f"input {i} lacks the id column '{id_col}'")
    cols: list[str] = []
    types: dict[str, set] = {}
    for d in dfs:
        for f in d.schema.fields:
            if f.name == id_col:
                continue
            if f.name not in cols:
                cols.append(f.name)
            types.setdefault(f.name, set()).add(f.dataType.simpleString())
    text = {c for c, t in types.items() if len(t) > 1}
    tagged = None
    for i, d in enumerate(dfs):
        sel = [F.col(id_col)] + [(F.col(c).cast("string") if c in text else F.col(c)).alias(c)
                                 for c in d.columns if c != id_col]
        t = d.select(*sel).withColumn("_src", F.lit(i))
        tagged = t if tagged is None else tagged.unionByName(t, allowMissingColumns=True)
    aggs = [F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("_src"))).alias(c) for c in cols]
    here = [F.count_if(F.col("_src") == i).alias(f"_n{i}") for i in range(len(dfs))]
    out = tagged.groupBy(id_col).agg(*aggs, *here)
    counts = [F.col(f"_n{i}") for i in range(len(dfs))]
    twice = F.greatest(*counts, F.lit(0)) > 1
    problem = F.when(F.col(id_col).isNull(), F.lit("an input has a row without an id")).when(
        twice, F.concat(F.lit("an input has duplicate ids: "), F.col(id_col).cast("string")))
    id_type = out.schema[id_col].dataType
    out = out.withColumn(id_col, F.when(problem.isNotNull(), F.raise_error(problem).cast(id_type)).otherwise(F.col(id_col)))
    if how == "intersect":
        everywhere = F.lit(True)
        for c in counts:
            everywhere = everywhere & (c > 0)
        # the id is read in the filter, so that the check is made before rows are dropped
        out = out.where(F.col(id_col).isNotNull() & everywhere)
    return out.select(id_col, *cols)
