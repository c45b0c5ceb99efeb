"""Token ids as binary files: frequency-ranked ids in Stream VByte, decoded by numpy table lookup.

1. Documents are tokenised where they are read; the ids (two bytes each where
   the vocabulary allows it) are stored in the shared folder. Texts are never
   shuffled.
2. Token counts per task are summed over all documents; ids are ranked by
   falling count, ties by id. The rank table has a row per vocabulary entry,
   which bounds what goes to the driver and to the tasks.
3. The ids are range-partitioned by (``doc_id``, text hash, row number), so
   files hold disjoint ascending ranges and one repeated document cannot fill a
   range. Each task writes ranks to one file of chunks of about
   ``CHUNK_TOKENS`` tokens. The manifest (file, range, documents, tokens) is a
   stored table; only files named there count, so retried tasks leave no trace.
4. Files are read back by a task each.

Tokenising: white space never joins tokens in the vocabulary used, so the texts
of a group (about ``GROUP`` bytes) are cut at ASCII white space and each piece
is treated once a group, by Arrow's kernels: a run of letters with punctuation
behind it becomes the lower-cased run and the punctuation, all other pieces stay
whole. Each distinct one goes through the tokenizers library, a run of letters
through its model, the others through the whole tokenizer. They are remembered
in two generations of at most ``MEMO`` each (about 50 MB): a full generation
becomes the old one, and what is asked for again moves on. A worker keeps them
between its tasks.

Defined results: a null or empty text is the end id alone; a null ``doc_id``
comes first; repeated rows are separate documents; an empty table gives no
file. Texts of any length are one document and are never cut. ``doc_id`` is
cast to long. Only ``doc_id`` and ``text`` are read, so further columns cannot
clash.
"""

from __future__ import annotations

import codecs
import struct
import unicodedata
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import stream_vbyte
from .common import open_fs, shared_path, store, text_or_empty

CHUNK_TOKENS = 1 << 20
MEMO = 250_000
GROUP = 8_000_000
#: magic, documents, tokens, control bytes, data bytes
HEAD = "<4sQQQQ"
MAGIC = b"TKV1"
#: ASCII punctuation that is a word of its own behind letters (no apostrophe, which begins contractions, and no "<", which begins marks)
TAILS = "!\"#$%&()*+,-./:;=>?@[\\]^_`{|}~"
#: letters up to U+024F, which lower-case one by one (all but U+0130)
LETTERS = "".join(c for c in map(chr, range(0x250)) if c.isalpha() and len(c.lower()) == 1)


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class PieceTokenizer(dict):
    """Ids of whole texts through the tokenizers library; a dict from piece or word to its ids that learns what is missing."""

    def __init__(self, path: str, memo: int = MEMO):
        from tokenizers import Tokenizer
        super().__init__()
        self.library = Tokenizer.from_file(path)
        self.kind = "<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4"
        self.code = "H" if self.kind == "<u2" else "I"
        self.tokenize, self.old, self.limit = self.library.model.tokenize, {}, memo

    def __missing__(self, piece: str) -> bytes:
        found = self.old.get(piece)
        if found is None:
            found = self._learned(piece)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[piece] = found
        return found

    def _learned(self, piece: str) -> bytes:
        # a run of letters is one word of the model, spelt in its byte alphabet, and so is a run of punctuation;
        # letters up to U+024F lower-case one by one
        core = piece if piece.isalpha() else piece.rstrip(TAILS)
        if core.isascii():
            if not core.isalpha():
                return array(self.code, self.library.encode(piece, add_special_tokens=False).ids).tobytes()
            spelt = low = core.lower()
        else:
            low = core.lower()
            if not core.isalpha() or max(core) >= "\u0250" or len(low) != len(core) or not unicodedata.is_normalized("NFC", core):
                return array(self.code, self.library.encode(piece, add_special_tokens=False).ids).tobytes()
            spelt = codecs.charmap_decode(low.encode(), "strict", BYTE_LETTERS)[0]
        if low == core:
            found = array(self.code, [t.id for t in self.tokenize(spelt)]).tobytes()
        else:
            found = self[low]
        return found + self[piece[len(core):]] if len(core) < len(piece) else found

    def _ids(self, pieces):
        """Ids of each piece, an Arrow column as ``pieces``."""
        import pyarrow as pa
        import pyarrow.compute as pc
        words, tails = pc.ascii_rtrim(pieces, TAILS), pc.utf8_ltrim(pieces, LETTERS)
        # letters and then punctuation: what is left by either cut makes up the piece
        plain = pc.equal(pc.add(pc.binary_length(words), pc.binary_length(tails)), pc.binary_length(pieces))
        parts = []
        for part in (pc.if_else(plain, pc.utf8_lower(words), pieces), pc.if_else(plain, tails, "")):
            distinct = part.dictionary_encode()
            known = [self[x] for x in distinct.dictionary.to_numpy(zero_copy_only=False)]
            parts.append(pa.array(known, pa.large_binary()).take(distinct.indices))
        return pc.binary_join_element_wise(*parts, pa.scalar(b"", pa.large_binary()))

    def encode(self, texts) -> list[bytes]:
        """Ids of each text (a list or an Arrow column without nulls) as little-endian unsigned integers of ``kind``."""
        import pyarrow as pa
        import pyarrow.compute as pc
        if not len(texts):
            return []
        pieces = pc.ascii_split_whitespace(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()))
        distinct = pieces.flatten().dictionary_encode()
        ids = self._ids(distinct.dictionary).take(distinct.indices)
        # the ids of all pieces stand one behind the other
        _, ends, data = ids.buffers()
        places = pieces.offsets.to_numpy()
        places = np.frombuffer(ends, "<i8")[places - places[0]].tolist()
        data = memoryview(data or b"")
        return [data[a:b].tobytes() for a, b in zip(places, places[1:])]


#: fixed rule of byte-level vocabularies: printable bytes stand for themselves, the others for U+0100 and up, in order
_OTHERS = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255)]
BYTE_LETTERS = "".join(chr(256 + _OTHERS.index(b) if b in _OTHERS else b) for b in range(256))


_WORKER: dict[str, PieceTokenizer] = {}


def worker_tokenizer(path: str) -> PieceTokenizer:
    """The tokenizer of this Python worker, kept between tasks."""
    if path not in _WORKER:
        _WORKER[path] = PieceTokenizer(path)
    return _WORKER[path]


def tokenised(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """Stored rows ``doc_id, h, no, width, ids`` (ids as little-endian unsigned integers of ``width`` bytes, end id included)."""
    text = text_or_empty("text")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("h"), F.monotonically_increasing_id().alias("no"), text.alias("text"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        from alpina.llm.token_output import worker_tokenizer  # the worker's own module keeps the memo
        tokenizer = worker_tokenizer(path)
        width = int(tokenizer.kind[-1])
        end = end_id.to_bytes(width, "little")
        for batch in batches:
            texts = batch.column(3)
            # groups of about GROUP bytes; a longer text is in one of its own or ends one
            starts = np.unique(np.cumsum(pc.binary_length(texts).to_numpy()) // GROUP, return_index=True)[1].tolist()
            for start, stop in zip(starts, [*starts[1:], len(texts)]):
                ids = [x + end for x in tokenizer.encode(texts.slice(start, stop - start))]
                kept = [batch.column(i).slice(start, len(ids)) for i in range(3)]
                yield pa.RecordBatch.from_arrays([*kept, pa.array([width] * len(ids), pa.int32()), pa.array(ids, pa.binary())], names=["doc_id", "h", "no", "width", "ids"])

    made = rows.mapInArrow(run, "doc_id long, h long, no long, width int, ids binary")
    p = shared_path(docs.sparkSession, "token-ids")
    made.write.option("compression", "zstd").parquet(p)
    return docs.sparkSession.read.schema(made.schema).parquet(p)


def _ids(width: int, data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<u2" if width == 2 else "<u4")


def token_counts(tokens: DataFrame) -> DataFrame:
    """``id, n`` over all documents."""

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa
        total = np.zeros(0, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            # one width per vocabulary; the ids of a batch stand one behind the other
            c = np.bincount(_ids(batch.column(0)[0].as_py(), b"".join(batch.column(1).to_pylist())))
            if len(c) > len(total):
                c, total = total, c
            total[: len(c)] += c
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], names=["id", "n"])

    return tokens.select("width", "ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write_files(tokens: DataFrame, ids_by_rank: np.ndarray, folder: str) -> DataFrame:
    """Write rank files below ``folder`` in ``doc_id`` order; returns the stored manifest ``file, range, documents, tokens``."""
    rank = np.zeros(int(ids_by_rank.max(initial=0)) + 1, np.uint32)
    rank[ids_by_rank] = np.arange(len(ids_by_rank), dtype=np.uint32)
    spark = tokens.sparkSession
    shared = spark.sparkContext.broadcast(rank)  # one entry per vocabulary entry
    order = ["doc_id", "h", "no"]
    rows = tokens.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", F.spark_partition_id().alias("range"), "width", "ids")

    def write(batches: Iterator) -> Iterator:
        import pyarrow as pa
        fs, path = open_fs(folder)
        out, name, place, total, documents = None, "", 0, 0, 0
        doc_ids: list = []
        held: list[bytes] = []
        size = width = 0

        def flush():
            nonlocal size
            if held:
                lengths = np.array([len(x) // width for x in held], "<u8")
                known = np.array([d is not None for d in doc_ids], np.uint8)
                control, data = stream_vbyte.encode(shared.value[_ids(width, b"".join(held))])
                out.write(struct.pack(HEAD, MAGIC, len(held), int(lengths.sum()), len(control), len(data)))
                for x in (known.tobytes(), np.array([d or 0 for d in doc_ids], "<i8").tobytes(), lengths.tobytes(), control, data):
                    out.write(x)
            doc_ids.clear()
            held.clear()
            size = 0

        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                fs.create_dir(path, recursive=True)
                name = f"{uuid.uuid4().hex}.tkv"
                out = fs.open_output_stream(f"{path}/{name}", compression=None)
                place, width = batch.column(1)[0].as_py(), batch.column(2)[0].as_py()
            for doc_id, ids in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist()):
                doc_ids.append(doc_id)
                held.append(ids)
                size += len(ids)
                total, documents = total + len(ids) // width, documents + 1
                if size >= CHUNK_TOKENS * width:
                    flush()
        if out is not None:
            flush()
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([place], pa.int32()), pa.array([documents], pa.int64()), pa.array([total], pa.int64())],
                                             names=["file", "range", "documents", "tokens"])

    return store(rows.mapInArrow(write, "file string, range int, documents long, tokens long"), "token-manifest")


def read_file(fs, path: str, ids_by_rank: np.ndarray) -> Iterator[tuple[int | None, np.ndarray]]:
    """``(doc_id, token ids)`` of each document of a file, one chunk in memory at a time."""
    with fs.open_input_stream(path, compression=None) as f:
        while head := f.read(struct.calcsize(HEAD)):
            magic, documents, tokens, n_control, n_data = struct.unpack(HEAD, head)
            if magic != MAGIC:
                raise ValueError(f"{path} is no token file")
            known = np.frombuffer(f.read(documents), np.uint8)
            doc_ids, lengths = np.frombuffer(f.read(8 * documents), "<i8"), np.frombuffer(f.read(8 * documents), "<u8").astype(np.int64)
            ids = ids_by_rank[stream_vbyte.decode(f.read(n_control), f.read(n_data), tokens)]
            ends = np.cumsum(lengths)
            for known_id, doc_id, a, b in zip(known, doc_ids, ends - lengths, ends):
                yield (int(doc_id) if known_id else None), ids[a:b]


def read_documents(manifest: DataFrame, ids_by_rank: np.ndarray, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of each document, from the files."""
    spark = manifest.sparkSession
    shared = spark.sparkContext.broadcast(ids_by_rank.astype("<u4"))
    ahead = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    files = manifest.select("file", F.coalesce(F.sum("tokens").over(ahead), F.lit(0)).alias("start"))
    # a stated number is not coalesced by the bytes of the manifest: a task per file
    files = files.repartition(max(1, manifest.count()), "file")

    def read(batches):
        fs, path = open_fs(folder)
        for pdf in batches:
            for name, start in zip(pdf["file"], pdf["start"]):
                made = []
                for doc_id, ids in read_file(fs, f"{path}/{name}", shared.value):
                    made.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
                    start += len(ids)
                    if len(made) >= 10_000:
                        yield _frame(made)
                        made = []
                yield _frame(made)

    return files.mapInPandas(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _frame(rows: list) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["doc_id", "start", "n_tokens", "ids_crc32"]).astype(
        {"doc_id": "Int64", "start": "int64", "n_tokens": "int64", "ids_crc32": "int64"})


def token_files(docs: DataFrame, path: str | None = None, end_id: int = 2) -> tuple[DataFrame, np.ndarray, str]:
    """Encode ``docs`` into files; returns ``(manifest, ids by rank, folder)``."""
    folder = shared_path(docs.sparkSession, "token-files")
    tokens = tokenised(docs, path or vocabulary_path(), end_id)
    counts = token_counts(tokens).collect()  # a row per vocabulary entry
    ids_by_rank = np.array([r["id"] for r in sorted(counts, key=lambda r: (-r["n"], r["id"]))], np.int64)
    return write_files(tokens, ids_by_rank, folder), ids_by_rank, folder


def token_round_trip(docs: DataFrame, path: str | None = None, end_id: int = 2) -> DataFrame:
    """Write the token files of ``docs`` and read every document back from them."""
    return read_documents(*token_files(docs, path, end_id))
