"""Helpers shared by the corpus operators: shared-folder tables, text expressions, file access."""

from __future__ import annotations

import string
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import remove_table, shared_path, store, table_path  # noqa: F401  (shared by the operators)

#: fixed values: the word of the decontamination and shingle contracts, and white-space words
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPACED_WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def text_or_empty(col: str | Column) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit("")).cast("string")


def ascii_lower(c: Column) -> Column:
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def words(col: str | Column) -> Column:
    """Array of the words of a text, A-Z lower-cased; a null text has none."""
    return F.regexp_extract_all(ascii_lower(text_or_empty(col)), F.lit(WORD), F.lit(0))


def packed(df: DataFrame) -> DataFrame:
    """The whole row as one struct column ``row``, so that operator columns cannot clash with its own."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))


def unpacked(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[F.col("row").getField(c).alias(c) for c in columns])


def open_fs(uri: str):
    """``(filesystem, path)`` for a folder or file, in tasks as on the driver."""
    from pyarrow import fs
    if "://" not in uri and uri.startswith("file:"):
        uri = "file://" + uri[5:]
    if "://" in uri:
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri


def trim_memory() -> None:
    """Give freed memory back to the system: a Python worker outlives its stage beside those that follow."""
    import ctypes
    import gc

    import pyarrow as pa
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def text_groups(texts: list[str], most: int = 2_000_000) -> Iterator[slice]:
    """Slices of about ``most`` characters; a longer text is a slice of its own."""
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most:
            yield slice(start, i)
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield slice(start, len(texts))


def map_texts(docs: DataFrame, make: Callable, fields: str, keep_rows: bool, most: int = 2_000_000) -> DataFrame:
    """Columns ``fields`` for every document, from its whole text.

    ``make()`` is called once per task and gives a function from a list of texts
    (null as empty) to a list of columns. The result has ``row`` (the whole
    input row) with ``keep_rows``, else ``doc_id``.
    """
    rows = packed(docs if keep_rows else docs.select("doc_id", "text"))

    def run(batches):
        import pyarrow as pa
        call = make()
        for batch in batches:
            row = batch.column(0)
            texts = row.field("text").to_pylist()  # rows are never null themselves
            kept = row if keep_rows else row.field("doc_id")
            for part in text_groups(texts := ["" if t is None else str(t) for t in texts], most):
                columns = call(texts[part])
                arrays = [pa.array(c, type=kind) for c, kind in zip(columns, kinds)]
                yield pa.RecordBatch.from_arrays([kept.slice(part.start, part.stop - part.start), *arrays], names=names)
            del batch, row, texts, kept
        trim_memory()

    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import StructField, StructType, _parse_datatype_string
    wanted = _parse_datatype_string(fields)
    first = rows.schema[0] if keep_rows else StructField("doc_id", docs.schema["doc_id"].dataType)
    schema = StructType([first, *wanted.fields])
    kinds, names = [to_arrow_type(f.dataType) for f in wanted.fields], schema.fieldNames()
    return rows.mapInArrow(run, schema)
