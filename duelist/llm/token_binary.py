"""Token ids in binary shards: one zstandard dictionary for all, one frame per document, an offset index per shard.

Layout of a folder written by ``write``::

    shards/part-NNNNN...   frames in ascending doc_id order, each followed by a line end, then the index, then the trailer
    dictionary/            Parquet, one row: hash, bytes, id width, end id
    manifest/              Parquet, one row per shard: shard number, file, first and last doc_id, documents, tokens, start

An index entry is (doc_id, offset, bytes, tokens); the trailer names the place of the index, the number of entries
and the hash of the dictionary, which a reader compares before it decompresses. A short document costs one
index entry and one small frame: the shared dictionary stands in for what a frame that short cannot learn.

Shards come from one range shuffle by doc_id. Spark's text writer commits them, so they may lie in any store that
Spark reaches, and a lost executor leaves no half shard. Ids take two bytes where the vocabulary allows.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duelist.llm.common import importable
from duelist.llm.tokens import encoded_texts, encoder

END_ID = 0
LEVEL = 3
SHARD_CHARS = 16_000_000
DICTIONARY_BYTES = 64 * 1024
#: The dictionary is trained on about so many documents of at most so many characters, those with the smallest hash of
#: their id. It changes sizes only; what is read back never depends on it.
SAMPLE_DOCUMENTS, SAMPLE_CHARS = 1_000, 8_192

_ENTRY = np.dtype([("doc_id", "<i8"), ("offset", "<u8"), ("bytes", "<u4"), ("tokens", "<u4"), ("null_id", "u1")])
_TRAILER = "<8sQQ16sB"
_MAGIC = b"TOKENS01"
_BATCH = 4 << 20


def dictionary_hash(data: bytes) -> bytes:
    return hashlib.sha256(data).digest()[:16]


def train_dictionary(docs: DataFrame, tokenizer: str, n: int) -> bytes:
    """A dictionary from the bounded sample above, out of ``n`` short documents; empty if there is too little to train on."""
    share = min(1.0, SAMPLE_DOCUMENTS / max(n, 1))
    sample = (
        docs.filter(F.length("text").between(1, SAMPLE_CHARS))
        .filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 40)) < int(share * (1 << 40)))
        .select("text").limit(2 * SAMPLE_DOCUMENTS)
    )
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, encoder(tokenizer).encode_batch(sorted(r[0] for r in sample.collect()))).as_bytes()
    except zstandard.ZstdError:
        return b""


def _codec(data: bytes) -> dict:
    if not data:
        return {}
    return {"dict_data": zstandard.ZstdCompressionDict(data)}


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, text: str = "text", doc_id: str = "doc_id",
          shard_chars: int = SHARD_CHARS) -> None:
    """Encodes every whole text, adds ``end_id`` and writes the folder ``path``, which must not exist.

    NULL and empty texts hold the end id alone. Repeated ids are kept, ordered by text; NULL ids come first.
    """
    spark = docs.sparkSession
    narrow = importable(docs).select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    sizes = narrow.agg(F.sum(F.length("text")).alias("chars"), F.count_if(F.length("text").between(1, SAMPLE_CHARS)).alias("short")).first()
    chars = sizes["chars"] or 0
    dictionary = train_dictionary(narrow, tokenizer, sizes["short"])
    width = encoder(tokenizer).dtype.itemsize
    digest = dictionary_hash(dictionary)

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, codec = encoder(tokenizer), zstandard.ZstdCompressor(level=LEVEL, write_content_size=True, **_codec(dictionary))
        end, index, at, held, size = np.array([end_id], enc.dtype).tobytes(), [], 0, [], 0
        for batch in batches:
            for key, ids in zip(batch.column(0), encoded_texts(enc, batch.column(1))):
                raw = ids + end
                frame, key = codec.compress(raw), key.as_py()
                index.append((key or 0, at, len(frame), len(raw) // width, key is None))
                held.append(frame)
                at += len(frame) + 1
                size += len(frame)
                if size > _BATCH:
                    yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], names=["value"])
                    held, size = [], 0
        if index:
            tail = [np.array(index, _ENTRY).tobytes(), struct.pack(_TRAILER, _MAGIC, at, len(index), digest, width)]
            yield pa.RecordBatch.from_arrays([pa.array([*held, *tail], pa.binary())], names=["value"])

    ordered = narrow.repartitionByRange(max(1, -(-chars // shard_chars)), "doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(frames, "value binary").select(F.col("value").cast("string")).write.option("lineSep", "\n").text(f"{path}/shards")
    spark.createDataFrame([(digest.hex(), bytearray(dictionary), width, end_id)],
                          "hash string, dictionary binary, id_bytes int, end_id int").coalesce(1).write.parquet(f"{path}/dictionary")
    per_shard = _shards(spark, path).mapInArrow(_summaries, "shard int, file string, first_id long, last_id long, documents long, tokens long")
    # one row per shard
    per_shard.selectExpr(
        "*", "coalesce(sum(tokens) OVER (ORDER BY shard ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start",
    ).write.parquet(f"{path}/manifest")


def _shards(spark: SparkSession, path: str, files: list[str] | None = None) -> DataFrame:
    found = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(files or f"{path}/shards")
    return importable(found).select(F.regexp_extract("path", r"part-(\d+)", 1).cast("int").alias("shard"), "path", "content")


def read_index(content: memoryview) -> tuple[np.ndarray, bytes, int]:
    """Index entries, dictionary hash and id width of a shard."""
    magic, at, n, digest, width = struct.unpack(_TRAILER, content[-struct.calcsize(_TRAILER) - 1 : -1])
    if magic != _MAGIC:
        raise ValueError("not a token shard")
    return np.frombuffer(content[at : at + n * _ENTRY.itemsize], _ENTRY), digest, width


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for shard, path, content in zip(*batch.columns):
            index, _, _ = read_index(memoryview(content.as_buffer()))
            ids = index["doc_id"][index["null_id"] == 0]
            rows.append((shard.as_py(), path.as_py(), *((int(ids[0]), int(ids[-1])) if len(ids) else (None, None)),
                         len(index), int(index["tokens"].sum())))
        if rows:
            types = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), types)],
                names=["shard", "file", "first_id", "last_id", "documents", "tokens"])


def _decode(shards: DataFrame, path: str, wanted: frozenset[int] | None = None) -> DataFrame:
    stored = shards.sparkSession.read.parquet(f"{path}/dictionary").first()
    dictionary, expected = bytes(stored["dictionary"]), bytes.fromhex(stored["hash"])
    if dictionary_hash(dictionary) != expected:
        raise ValueError("the dictionary does not match its hash")

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = zstandard.ZstdDecompressor(**_codec(dictionary))
        for batch in batches:
            for shard, content in zip(batch.column(0), batch.column(2)):
                view = memoryview(content.as_buffer())
                index, digest, width = read_index(view)
                if digest != expected:
                    raise ValueError("a shard was written with another dictionary")
                starts, rows, size = np.cumsum(index["tokens"], dtype=np.int64) - index["tokens"], [], 0
                for k, e in enumerate(index):
                    if wanted is not None and (e["null_id"] or int(e["doc_id"]) not in wanted):
                        continue
                    raw = codec.decompress(view[int(e["offset"]) : int(e["offset"]) + int(e["bytes"])])
                    ids = np.frombuffer(raw, f"<u{width}").astype("<u4").tobytes()
                    rows.append((None if e["null_id"] else int(e["doc_id"]), shard.as_py(), int(starts[k]), int(e["tokens"]), ids))
                    size += len(ids)
                    if size > _BATCH:
                        yield _rows(rows)
                        rows, size = [], 0
                if rows:
                    yield _rows(rows)

    return shards.mapInArrow(decoded, "doc_id long, shard int, start_in_shard long, n_tokens long, ids binary")


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                      names=["doc_id", "shard", "start_in_shard", "n_tokens", "ids"])


def read(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before it), ``n_tokens``, ``ids`` (little-endian, four bytes each)."""
    starts = spark.read.parquet(f"{path}/manifest").select("shard", "start")
    return _decode(_shards(spark, path), path).join(starts, "shard").select(
        "doc_id", (F.col("start") + F.col("start_in_shard")).alias("start"), "n_tokens", "ids")


def fetch(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """A few documents by id: only shards whose range holds one are opened, only their frames are decompressed."""
    wanted = frozenset(doc_ids)
    near = F.exists(F.array(*map(F.lit, wanted)), lambda i: i.between(F.col("first_id"), F.col("last_id")))
    files = [r["file"] for r in spark.read.parquet(f"{path}/manifest").filter(near).select("file").collect()] if wanted else []
    found = _shards(spark, path, files or [f"{path}/shards"])
    return _decode(found if files else found.limit(0), path, wanted).select("doc_id", "n_tokens", "ids")


def as_array(ids: str | Column = "ids") -> Column:
    """The ids of ``read`` as an array of integers."""
    raw = F.hex(ids)
    bytes_ = lambda i, k: F.substr(raw, i * 8 + 1 + 2 * k, F.lit(2))
    return F.transform(
        F.when(F.length(raw) > 0, F.sequence(F.lit(0), (F.length(raw) / 8 - 1).cast("int"))).otherwise(F.array().cast("array<int>")),
        lambda i: F.conv(F.concat(*(bytes_(i, k) for k in (3, 2, 1, 0))), 16, 10).cast("int"),
    )
