"""Ranked lexical search by dense blocked matrix products.

Every item of a query set is scored against every document by integer term weights and impacts. The items are cut into
tiles with a compact vocabulary of their own, the documents into tiles of a few hundred; a document tile holds one
impact per document and term, and one BLAS product scores a tile pair. Products run in float64 on integers: a tile's weights are
bounded so that no partial sum can reach 2^53, so every order of addition gives the exact integer, and tiles add up in
64-bit integers.

A task keeps the best ``k`` of each item. Documents that tie with the last of them stay in until their ids have been
compared, so ties fall to the smaller id however the documents are dealt to tasks. Texts are read once for a block of
items; what is staged is one narrow row per document (its length and the counts of the block's terms).
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelist.llm.common import importable, staged

TOP = 10
#: (item, term) entries that go to all tasks at once; more items mean more passes, not larger broadcasts.
BLOCK_ENTRIES = 100_000
TILE_ITEMS, TILE_TERMS, TILE_DOCS = 128, 4096, 256
#: No impact is larger, and sums of weight times impact stay below 2^53.
MAX_IMPACT = 1_000_000
MAX_WEIGHTS = (1 << 53) // MAX_IMPACT - 1
SALTS = 64

# Fixed value: ASCII characters that do not belong to a term; all others do, A-Z in lower case.
_TERM_BYTES = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256)).lower()


def terms(raw: bytes | None) -> list[bytes]:
    """The terms of a UTF-8 text in order, repeats included."""
    return (raw or b"").translate(_TERM_BYTES).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


@dataclass
class ItemTile:
    """Items of one tile: rows of ``weights`` (items x terms); ``column`` maps the block's term numbers to columns, or -1.

    ``last`` marks the tile after which the scores of its items are complete."""

    items: np.ndarray
    column: np.ndarray
    weights: np.ndarray
    last: bool


def item_tiles(entries: list[tuple[int, int, int]], n_terms: int, max_items: int = TILE_ITEMS, max_terms: int = TILE_TERMS,
               max_weights: int = MAX_WEIGHTS) -> list[ItemTile]:
    """Tiles of (item, term, weight) entries. An item whose terms or weights are too many for one tile gets several."""
    own: dict[int, list[tuple[int, int]]] = {}
    for item, term, w in entries:
        own.setdefault(item, []).append((term, w))
    groups: list[tuple[list[int], set[int]]] = []
    for item in sorted(own):
        new = {t for t, _ in own[item]}
        if not groups or len(groups[-1][0]) >= max_items or len(groups[-1][1] | new) > max_terms:
            groups.append(([], set()))
        groups[-1][0].append(item)
        groups[-1][1].update(new)
    tiles: list[ItemTile] = []
    for items, vocabulary in groups:
        order = sorted(vocabulary)
        for k in range(0, len(order), max_terms):
            some = order[k : k + max_terms]
            column = np.full(n_terms, -1, np.int64)
            column[some] = np.arange(len(some))
            rest = np.zeros((len(items), len(some)), np.int64)
            for row, item in enumerate(items):
                for term, w in own[item]:
                    if column[term] >= 0:
                        rest[row, column[term]] += w
            while rest.any():
                upto = np.minimum(np.cumsum(rest, axis=1), max_weights)
                part = np.diff(upto, axis=1, prepend=0)
                rest = rest - part
                used = part.any(axis=0)
                narrow = np.full(n_terms, -1, np.int64)
                narrow[np.array(some)[used]] = np.arange(used.sum())
                tiles.append(ItemTile(np.array(items), narrow, part[:, used].astype(np.float64), False))
        if tiles and tiles[-1].items[0] == items[0]:
            tiles[-1].last = True
    return tiles


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()
        rows = [(i, t, n) for i, text in zip(ids, texts) for t, n in Counter(terms(text)).items()]
        i, t, n = zip(*rows) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(i, batch.schema.field(0).type), pa.array(t, pa.binary()), pa.array(n, pa.int64())], names=["item", "term", "times"])


def _counted(vocabulary):
    """Rows ``doc_id``, ``n`` (terms), ``ids`` and ``tf`` (the block's terms and how often); documents without terms are left out."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {t: k for k, t in enumerate(vocabulary.value)}
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            keep, sizes, ids, tfs, ends = [], [], [], [], [0]
            for k in range(len(texts)):
                found = terms(texts[k].as_py())
                if not found:
                    continue
                known = Counter(map(number.get, found))
                known.pop(None, None)
                keep.append(k)
                sizes.append(len(found))
                ids.append(np.fromiter(known.keys(), np.int32, len(known)))
                tfs.append(np.fromiter(known.values(), np.int64, len(known)))
                ends.append(ends[-1] + len(known))
            offsets = pa.array(ends, pa.int32())
            flat = (pa.array(np.concatenate([*x, np.empty(0, kind)]).astype(kind)) for x, kind in ((ids, np.int32), (tfs, np.int64)))
            lists = [pa.ListArray.from_arrays(offsets, x) for x in flat]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(keep, pa.int64())), pa.array(sizes, pa.int64()), *lists], names=["doc_id", "n", "ids", "tf"])

    return counted


def _frequencies(size: int):
    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, np.int64)
        for batch in batches:
            df += np.bincount(batch.column(0).flatten().to_numpy(), minlength=size)
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(df[some])], names=["id", "df"])

    return frequencies


class _Best:
    """The best ``k`` documents of each item so far, as flat arrays sorted by item, score down, id up (NULL last)."""

    def __init__(self, n_items: int, k: int):
        self.k, self.least = k, np.ones(n_items, np.int64)
        self.item = self.score = self.doc = np.empty(0, np.int64)
        self.null = np.empty(0, bool)

    def offer(self, items: np.ndarray, scores: np.ndarray, docs: np.ndarray, null: np.ndarray) -> None:
        row, at = np.nonzero(scores >= self.least[items][:, None])
        if not len(row):
            return
        item = np.concatenate((self.item, items[row]))
        score = np.concatenate((self.score, scores[row, at]))
        doc, none = np.concatenate((self.doc, docs[at])), np.concatenate((self.null, null[at]))
        order = np.lexsort((doc, none, -score, item))
        item = item[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        best = place < self.k
        order = order[best]
        self.item, self.score, self.doc, self.null = item[best], score[order], doc[order], none[order]
        full = place[best] == self.k - 1
        self.least[self.item[full]] = self.score[full]


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def _best_of_part(block, n_items: int, n_docs: int, total: int, k: int):
    def best_of_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries, n_terms = block.value
        tiles, best = item_tiles(entries, n_terms), _Best(n_items, k)
        for batch in batches:
            for at in range(0, batch.num_rows, TILE_DOCS):
                part = batch.slice(at, TILE_DOCS)
                null = part.column(0).is_null().to_numpy(zero_copy_only=False)
                docs = part.column(0).fill_null(0).to_numpy()
                lists = part.column(2)
                sizes = np.diff(lists.offsets.to_numpy())
                ids, tf = lists.flatten().to_numpy(), part.column(3).flatten().to_numpy()
                # Python integers: length times documents can pass 64 bits on a large corpus
                m = np.array([25 + 75 * n * n_docs // total for n in part.column(1).to_pylist()], np.int64)
                row = np.repeat(np.arange(len(docs)), sizes)
                values = impacts(tf, m[row]).astype(np.float64)
                scores = None
                for tile in tiles:
                    column = tile.column[ids]
                    some = column >= 0
                    dense = np.zeros((len(docs), tile.weights.shape[1]))
                    dense[row[some], column[some]] = values[some]
                    exact = (tile.weights @ dense.T).astype(np.int64)
                    scores = exact if scores is None else scores + exact
                    if tile.last:
                        best.offer(tile.items, scores, docs, null)
                        scores = None
        yield pa.RecordBatch.from_arrays(
            [pa.array(best.item), pa.array(best.doc, mask=best.null), pa.array(best.score)], names=["item", "doc_id", "score"])

    return best_of_part


def search(docs: DataFrame, items: DataFrame, k: int = TOP, text: str = "text", doc_id: str = "doc_id", item_id: str = "item_id",
           block_entries: int = BLOCK_ENTRIES) -> DataFrame:
    """``item_id``, ``rank`` (from 1), ``doc_id``, ``score`` of the ``k`` best documents of every item, scores above 0 only.

    Each row of ``docs`` is a document of its own, also with a NULL or repeated id; NULL ids come after all others in a
    tie. NULL, empty and term-free texts are no documents. Rows of ``items`` with one id are one item: repeated
    texts count once, different texts together; a NULL id is an id. Items without terms, or whose terms no document
    holds, have no rows; without items or documents the result is empty. Other columns are not looked at.
    """
    spark = docs.sparkSession
    kind = dict(items.dtypes)[item_id]
    rows = importable(items.select(F.col(item_id).alias("item"), F.col(text).cast("string").alias("text")).distinct())
    entries = staged(rows.mapInArrow(_item_terms, f"item {kind}, term binary, times long").groupBy("item", "term").agg(
        F.sum("times").alias("times")), "search-items")
    blocks = -(-entries.count() // block_entries)
    texts = importable(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")))
    found = None
    for b in range(blocks):
        chosen = F.pmod(F.xxhash64(F.col("item").cast("string")), F.lit(blocks)) == b
        own = entries.filter(chosen).collect()  # about `block_entries` rows
        if not own:
            continue
        names = sorted({r["item"] for r in own if r["item"] is not None}) + [None] * any(r["item"] is None for r in own)
        vocabulary = sorted({bytes(r["term"]) for r in own})
        number, place = {t: i for i, t in enumerate(vocabulary)}, {n: i for i, n in enumerate(names)}
        sent = spark.sparkContext.broadcast(vocabulary)
        counted = staged(texts.mapInArrow(_counted(sent), "doc_id long, n long, ids array<int>, tf array<long>"), "search-counts")
        n_docs, total = counted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not n_docs:
            continue
        df = {r["id"]: r["df"] for r in counted.select("ids").mapInArrow(_frequencies(len(vocabulary)), "id long, df long")
              .groupBy("id").agg(F.sum("df").alias("df")).collect()}  # at most the block's terms
        weights = [(place[r["item"]], number[bytes(r["term"])], r["times"]) for r in own]
        weights = [(i, t, n * weight(n_docs, df[t])) for i, t, n in weights if t in df]
        block = spark.sparkContext.broadcast((weights, len(vocabulary)))
        parts = counted.mapInArrow(_best_of_part(block, len(names), n_docs, total, k), "item long, doc_id long, score long")
        parts = staged(parts.withColumn("salt", F.spark_partition_id() % SALTS), "search-best")
        # two steps, so that the last one reads at most SALTS * k rows of an item
        order = "score DESC, doc_id ASC NULLS LAST"
        some = parts.selectExpr("*", f"row_number() OVER (PARTITION BY item, salt ORDER BY {order}) AS place").filter(F.col("place") <= k)
        ranked = some.selectExpr("item", "doc_id", "score", f"row_number() OVER (PARTITION BY item ORDER BY {order}) AS rank").filter(F.col("rank") <= k)
        named = spark.createDataFrame(list(enumerate(names)), f"item long, item_id {kind}")
        here = ranked.join(F.broadcast(named), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
        found = here if found is None else found.union(here)
    return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long") if found is None else found
