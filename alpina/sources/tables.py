"""Table sources: CSV (S1, S2), JSON dimension (S3), text lines (S4),
manifest (S7), GeoJSON (S8)."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.coerce import na_to_null, to_double, to_int_exact

# The observation columns with a numeric contract type.
DOUBLE_COLUMNS = ["longitude", "latitude", "lon", "lat", "elevation_m", "E_lv95", "N_lv95"]
INT_COLUMNS = ["year", "cluster_year", "cluster_id", "cluster_local_id"]

TAXA_ENTRY = T.StructType([
    T.StructField("iconic_taxon_name", T.StringType()),
    T.StructField("common_name", T.StringType()),
])


def read_csv_strings(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Header CSV with every column kept as text; empty header is an error.

    Quotes are doubled inside quoted fields, which may hold line feeds. A file
    that may hold them cannot be split: pass ``multi_line=False`` where no field
    does, or write Parquet once and go on from there.
    """
    df = (spark.read.option("header", "true").option("inferSchema", "false").option("quote", '"').option("escape", '"')
          .option("multiLine", str(multi_line).lower()).csv(path))
    if not df.columns:
        raise ValueError(f"empty CSV: {path}")
    return df


def read_observations(spark: SparkSession, path: str, typed: bool = True, multi_line: bool = True) -> DataFrame:
    """Header CSV with the pandas NA tokens read as null.

    Columns with a contract type are coerced (unparseable -> null); all other
    columns stay text, and ``positional_accuracy`` / ``taxon_id`` stay raw so
    the filters can apply their own coercion.
    """
    df = read_csv_strings(spark, path, multi_line)
    cols = []
    for name in df.columns:
        c = na_to_null(F.col(f"`{name}`"))
        if typed and name in DOUBLE_COLUMNS:
            c = to_double(c)
        elif typed and name in INT_COLUMNS:
            c = to_int_exact(c)
        cols.append(c.alias(name))
    return df.select(*cols)


def read_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Trimmed non-blank lines with their position, ``(pos, line)``."""
    df = spark.read.text(path)
    return (df.select(F.trim("value").alias("line"))
              .where(F.length("line") > 0)
              .withColumn("pos", F.monotonically_increasing_id())
              .select("pos", "line"))


def _whole_text(spark: SparkSession, *paths: str) -> DataFrame:
    """The first of the documents that exists as one ``value`` row; no row if none does."""
    for path in paths:
        try:
            return spark.read.text(path, wholetext=True)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    return spark.createDataFrame([], "value string")


def parse_taxa_json(documents: DataFrame, value: str = "value") -> DataFrame:
    """``{id: {iconic_taxon_name, common_name}}`` texts -> ``(taxon_id, iconic_taxon_name, common_name)``.

    A document of another kind yields no rows; non-numeric keys are dropped.
    """
    m = F.from_json(value, T.MapType(T.StringType(), TAXA_ENTRY))
    return (documents.select(F.explode(m).alias("k", "v"))
            .select(to_double("k").try_cast("long").alias("taxon_id"),
                    F.col("v.iconic_taxon_name").alias("iconic_taxon_name"),
                    F.col("v.common_name").alias("common_name"))
            .where(F.col("taxon_id").isNotNull()))


def read_taxa_json(spark: SparkSession, path: str) -> DataFrame:
    """S3: the cached taxa document; a missing file is an empty cache. Keep the result as Parquet after the first load."""
    return parse_taxa_json(_whole_text(spark, path))


def parse_manifest(documents: DataFrame, value: str = "value") -> DataFrame:
    """JSON arrays of relative paths -> ``(pos, entry)``, every entry; other documents give no rows."""
    arr = F.from_json(value, T.ArrayType(T.StringType()))
    return documents.select(F.posexplode(arr).alias("pos", "entry"))


def csv_entries(manifest: DataFrame) -> DataFrame:
    """The entries that the map offers: those that end in ``.csv``. An append keeps the others too."""
    return manifest.where(F.lower("entry").endswith(".csv"))


def read_manifest(spark: SparkSession, *paths: str) -> DataFrame:
    """The manifest at the first location with a CSV entry, else at the first that exists; none is an empty manifest.

    A manifest is a short list of run outputs: a location is probed by one row.
    """
    for path in paths:
        found = parse_manifest(_whole_text(spark, path))
        if not csv_entries(found).limit(1).isEmpty():
            return found
    return parse_manifest(_whole_text(spark, *paths))


FEATURE_SCHEMA = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("properties", T.StructType([
        T.StructField("cluster_id", T.IntegerType()),
        T.StructField("cluster_local_id", T.IntegerType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("n_points", T.LongType()),
        T.StructField("alt_mean", T.DoubleType()),
    ])),
    T.StructField("geometry", T.StructType([
        T.StructField("type", T.StringType()),
        T.StructField("coordinates", T.StringType()),
    ])),
])


def parse_geojson(documents: DataFrame, value: str = "value") -> DataFrame:
    """Features of GeoJSON texts, each a Feature (a line of a file) or a whole FeatureCollection."""
    whole = T.StructType([T.StructField("type", T.StringType()), T.StructField("features", T.ArrayType(FEATURE_SCHEMA))])
    kind = F.get_json_object(value, "$.type")
    many = documents.where(kind == "FeatureCollection").select(F.explode(F.from_json(value, whole)["features"]).alias("f"))
    one = documents.where(kind == "Feature").select(F.from_json(value, FEATURE_SCHEMA).alias("f"))
    return many.unionByName(one).select("f.*")


def read_geojson_features(spark: SparkSession, *candidates: str) -> DataFrame:
    """GeoJSON features from the first candidate path that exists (a collection or a feature per line).

    Mirrors the map's fallback from ``<base>_4326.geojson`` to ``<base>.geojson``.
    """
    for path in candidates:
        try:
            return parse_geojson(spark.read.text(path))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    raise FileNotFoundError(f"no GeoJSON among {candidates}")
