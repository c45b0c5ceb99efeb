"""Tile worklists.

The needed-URL filter keeps a URL when its file name contains ``_<key>_`` for a
needed key. Written naively that is a substring theta join (a nested loop).
Here the file name is split on ``_`` and every token is a candidate key, so the
match becomes an equi semi-join; the URL keeps its position (``pos``) and is
emitted once even when two of its tokens match.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.raster import basename
from .elevation import with_tile_key


def tiles_needed(obs: DataFrame, lon: str | None = None, lat: str | None = None) -> DataFrame:
    """A2: distinct tile keys of all rows with parseable coordinates."""
    return with_tile_key(obs, lon, lat).where(F.col("_tk").isNotNull()) \
        .select(F.col("_tk").alias("tile_key")).distinct()


def urls_needed(urls: DataFrame, needed: DataFrame, url_col: str = "url") -> DataFrame:
    """URLs whose file name holds ``_<key>_`` for a needed key; order by ``pos`` at the sink."""
    name = basename(url_col)
    toks = F.split(name, "_")
    # inner tokens only: ``_<key>_`` needs an underscore on both sides
    inner = F.slice(toks, 2, F.greatest(F.size(toks) - 2, F.lit(0)))
    cand = urls.select("pos", F.explode(F.array_distinct(inner)).alias("tile_key"))
    hit = cand.join(needed.select("tile_key").distinct(), "tile_key", "left_semi").select("pos").distinct()
    return urls.join(hit, "pos", "left_semi")


def urls_missing(urls: DataFrame, present: DataFrame, url_col: str = "url", name_col: str = "name",
                 force: bool = False) -> DataFrame:
    """URLs whose file name is not already present (all of them when ``force``)."""
    if force:
        return urls
    named = urls.withColumn("_name", basename(url_col))
    have = present.select(F.col(name_col).alias("_name")).distinct()
    return named.join(have, "_name", "left_anti").drop("_name")
