"""Taxon enrichment and the metadata worklist."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.coerce import column_type, to_long
from ..functions.labels import taxon_group
from .quality import require_columns
from .ranking import global_rank

# Ids per metadata request (the service's cap).
MAX_IDS_PER_CALL = 200
TAXA_COLUMNS = ["iconic_taxon_name", "common_name", "group"]


def _dedup_dim(taxa: DataFrame) -> DataFrame:
    """One row per taxon id (the dimension is keyed like a map)."""
    v = F.struct("iconic_taxon_name", "common_name")
    return (taxa.where(F.col("taxon_id").isNotNull())
                .groupBy("taxon_id").agg(F.max_by(v, F.struct("common_name", "iconic_taxon_name")).alias("v"))
                .select("taxon_id", "v.iconic_taxon_name", "v.common_name"))


def enrich_taxa(obs: DataFrame, taxa: DataFrame) -> DataFrame:
    """J1 + P10: left lookup on the integer taxon id; adds iconic, common name, group.

    No match (or a null/unparseable id) gives null, null, ``unknown``. Existing
    columns of the same names are replaced.
    """
    require_columns(obs, "taxon_id")
    dim = _dedup_dim(taxa).select(F.col("taxon_id").alias("_tid"), "iconic_taxon_name", "common_name")
    base = obs.drop(*[c for c in TAXA_COLUMNS if c in obs.columns])
    base = base.withColumn("_key", to_long(F.col("taxon_id"), column_type(obs, "taxon_id")))
    out = base.join(dim, F.col("_key") == F.col("_tid"), "left")
    return out.withColumn("group", taxon_group("iconic_taxon_name")).drop("_key", "_tid")


def distinct_taxon_ids(obs: DataFrame) -> DataFrame:
    """A1: distinct integer taxon ids (null and unparseable dropped)."""
    require_columns(obs, "taxon_id")
    return (obs.select(to_long(F.col("taxon_id"), column_type(obs, "taxon_id")).alias("taxon_id"))
               .where(F.col("taxon_id").isNotNull()).distinct())


def missing_taxa(obs: DataFrame, cache: DataFrame) -> DataFrame:
    """Ids used by observations that the cache lacks."""
    return distinct_taxon_ids(obs).join(cache.select("taxon_id"), "taxon_id", "left_anti")


def cached_taxa_for(obs: DataFrame, cache: DataFrame) -> DataFrame:
    """Cache rows for the ids in use."""
    return cache.join(distinct_taxon_ids(obs), "taxon_id", "left_semi")


def required_taxon_ids(obs: DataFrame) -> DataFrame:
    """A1 with its error: raises if no row holds a valid taxon id."""
    ids = distinct_taxon_ids(obs)
    if ids.isEmpty():
        raise ValueError("no valid taxon id in the input")
    return ids


def request_batches(ids: DataFrame, batch_size: int = MAX_IDS_PER_CALL) -> DataFrame:
    """Consecutive batches of ascending ids, cut at ``batch_size`` and, inside, at the service limit.

    650 ids at a size of 300 give batches of 200, 100, 200, 100 and 50. Returns
    ``(taxon_id, batch_no, pos_in_batch)``; numbering is distributed (range
    partitions + offsets), never a single-task window.
    """
    size = int(batch_size)
    if size < 1:
        raise ValueError("batch_size must be at least 1")
    inner = -(-size // MAX_IDS_PER_CALL)
    r = global_rank(ids.select("taxon_id"), ["taxon_id"])
    within = F.col("rank0") % size
    no = F.floor(F.col("rank0") / size) * inner + F.floor(within / MAX_IDS_PER_CALL)
    return r.select("taxon_id", no.cast("long").alias("batch_no"),
                    (within % MAX_IDS_PER_CALL).cast("int").alias("pos_in_batch"))


def upsert_taxa(cache: DataFrame, fresh: DataFrame) -> DataFrame:
    """Merge fresh entries over the cache; a fresh entry wins for its id, one without an id is skipped (F8)."""
    cols = ["iconic_taxon_name", "common_name"]
    u = (cache.select("taxon_id", *cols).withColumn("_prio", F.lit(0))
         .unionByName(fresh.where(F.col("taxon_id").isNotNull()).select("taxon_id", *cols).withColumn("_prio", F.lit(1))))
    return (u.groupBy("taxon_id").agg(F.max_by(F.struct(*cols), "_prio").alias("v"))
             .select("taxon_id", "v.iconic_taxon_name", "v.common_name"))
