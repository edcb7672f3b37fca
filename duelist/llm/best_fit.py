"""Best-fit packing by large-item matching.

Texts become token ids with an end id; longer ones than a sequence are cut into full pieces, the first takes
what is left over. Pieces above a third of the capacity fit at most twice into a sequence: from the longest
down, each is matched with the longest other one that still fits. Smaller pieces then go, longest first, where
the remaining gap is smallest.

Pieces of one length are interchangeable, so the packing needs only their counts, one for each length: at most
``capacity`` numbers, whatever the corpus. It is worked out for all pieces of a length at once, and says which
ranks of a length go where. A piece learns its rank from its place in the staged table of pieces: rows of the
same length in earlier parts plus earlier rows in its own part. No task holds a length, a group or a sequence.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelist.llm.common import importable, staged
from duelist.llm.tokens import encoded_texts, encoder

CAPACITY = 1024
END_ID = 2

_PIECES = pa.schema([
    ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
    ("ids_crc32", pa.int64()), ("ids", pa.binary()), ("part", pa.int32()), ("seen", pa.int64()),
])


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` tokens."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] * (first > 0) + [(s, capacity) for s in range(first, n, capacity)]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, text: str = "text",
           doc_id: str = "doc_id") -> DataFrame:
    """One row per piece with its ids (little-endian, four bytes each), staged. ``part`` and ``seen``: which task wrote
    it, and how many pieces of its length that task had written before. A NULL or empty text is one piece of the end id."""

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, seen = encoder(tokenizer), TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            rows: list[tuple] = []
            held = 0
            for key, raw_ids in zip(batch.column(0).to_pylist(), encoded_texts(enc, batch.column(1))):
                ids = np.append(np.frombuffer(raw_ids, enc.dtype).astype("<u4"), np.array([end_id], "<u4"))
                for k, (start, length) in enumerate(cut(len(ids), capacity)):
                    raw = ids[start : start + length].tobytes()
                    rows.append((key, k, start, length, zlib.crc32(raw), raw, part, int(seen[length])))
                    seen[length] += 1
                held += ids.nbytes
                if held > 8 << 20:
                    yield _batch(rows, _PIECES)
                    rows, held = [], 0
            if rows:
                yield _batch(rows, _PIECES)

    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    ddl = ("doc_id long, piece int, start long, length long, ids_crc32 long, ids binary, part int, seen long")
    return staged(importable(narrow).mapInArrow(encoded, ddl), "pieces")


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Where the pieces of each length go: (length, first rank, first sequence, pieces a sequence, offset), by length and rank.

    Every step uses up a length or a gap, and each use more than halves a gap, so the number of rows depends on
    ``capacity`` alone.
    """
    left = {n: c for n, c in counts.items() if c > 0}
    rows: list[tuple[int, int, int, int, int]] = []
    placed = dict.fromkeys(left, 0)
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap: (first sequence, sequences)
    end = 0

    def put(length: int, first: int, sequences: int, each: int, offset: int) -> None:
        rows.append((length, placed[length], first, each, offset))
        placed[length] += sequences * each
        left[length] -= sequences * each

    large = sorted(n for n in left if 3 * n > capacity)
    for a in reversed(large):
        while left[a]:
            k = bisect_right(large, capacity - a) - 1
            while k >= 0 and left[large[k]] - (large[k] == a) <= 0:
                k -= 1
            b = large[k] if k >= 0 else 0
            if not b:
                n = left[a]
                put(a, end, n, 1, 0)
            elif b == a:
                n = left[a] // 2
                put(a, end, n, 2, 0)
            else:
                n = min(left[a], left[b])
                put(a, end, n, 1, 0)
                put(b, end, n, 1, a)
            gaps.setdefault(capacity - a - b, []).append((end, n))
            end += n

    for s in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        for gap in sorted(g for g in gaps if g >= s):
            each, kept = gap // s, []
            for first, n in gaps.pop(gap):
                full = min(n, left[s] // each)
                if full:
                    put(s, first, full, each, capacity - gap)
                    gaps.setdefault(gap - each * s, []).append((first, full))
                if full < n and left[s]:
                    some = left[s]
                    put(s, first + full, 1, some, capacity - gap)
                    gaps.setdefault(gap - some * s, []).append((first + full, 1))
                    full += 1
                if full < n:
                    kept.append((first + full, n - full))
            if kept:
                gaps.setdefault(gap, []).extend(kept)
            if not left[s]:
                break
        each = capacity // s
        full, some = divmod(left[s], each)
        if full:
            put(s, end, full, each, 0)
            gaps.setdefault(capacity - each * s, []).append((end, full))
        if some:
            put(s, end + full, 1, some, 0)
            gaps.setdefault(capacity - some * s, []).append((end + full, 1))
        end += full + (some > 0)
    return sorted(rows)


def place(cut_pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The staged pieces with ``sequence_id`` and ``offset``; sequences are numbered from 0 without gaps."""
    counted = cut_pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    bases = staged(counted.selectExpr(
        "length", "part", "n",
        "sum(n) OVER (PARTITION BY length ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - n AS base",
    ), "piece-counts")
    # at most `capacity` rows
    totals = {r["length"]: r["n"] for r in bases.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = np.array(plan(totals, capacity), np.int64).reshape(-1, 5)
    order = (table[:, 0] << 48) + table[:, 1]

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            row = table[np.searchsorted(order, (length << 48) + rank, side="right") - 1]
            k = rank - row[:, 1]
            each = row[:, 3] if len(row) else k
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(row[:, 2] + k // each), pa.array(row[:, 4] + k % each * length)],
                names=[*batch.schema.names[:-1], "sequence_id", "offset"])

    kept = [c for c in cut_pieces.columns if c not in ("part", "seen")]
    ranked = cut_pieces.join(bases.select("length", "part", "base"), ["length", "part"]).select(
        *kept, (F.col("base") + F.col("seen")).alias("rank"))
    fields = ", ".join(f"{n} {t}" for n, t in ranked.dtypes if n != "rank")
    return importable(ranked).mapInArrow(placed, f"{fields}, sequence_id long, offset long")


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, text: str = "text",
         doc_id: str = "doc_id", with_ids: bool = True) -> DataFrame:
    """One row per piece: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``, (``ids``,) ``sequence_id``, ``offset``.

    Repeated rows are packed as often as they occur; NULL ids pass through; other columns are ignored; an empty
    table gives an empty result. ``with_ids=False`` reads only the narrow columns of the staged pieces.
    """
    ready = pieces(docs, tokenizer, capacity, end_id, text, doc_id)
    return place(ready if with_ids else ready.drop("ids"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id``, ``ids``: the packed ids of each sequence, ready for training; a group is one sequence."""
    return packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p")).select(
        "sequence_id", F.expr("aggregate(p, cast('' AS binary), (a, x) -> concat(a, x.ids))").alias("ids"))
