"""Row-local operators on a streaming source.

Filters, projections and the stream-static lookups (taxa, elevation) need no
state, so the same operator functions apply unchanged to a DataFrame from
``readStream``. Clustering needs whole years and stays batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators import quality
from ..operators.taxa import enrich_taxa


def observation_stream(spark: SparkSession, path: str, schema: T.StructType,
                       max_files_per_trigger: int = 64) -> DataFrame:
    """Parquet files arriving in ``path`` as a stream (schema given, never inferred)."""
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
                 .parquet(path))


def enrich_stream(stream: DataFrame, taxa: DataFrame, max_accuracy: float = 100.0) -> DataFrame:
    """F1 then J1 on each micro-batch; ``taxa`` is a static dimension."""
    return enrich_taxa(quality.filter_position(stream, max_accuracy), taxa)
