"""N-gram Jaccard join with Bayesian candidate pruning.

Texts are sets of five-word shingles. Equal sets are one vertex, so copies cost one row each. Candidates share
a band of MinHash values; bands link vertices into families (by star edges to the smallest vertex of a
bucket, never all pairs). Within a family the MinHash values of a pair are compared ``STEP`` at a time: with a flat
prior, ``m`` equal values of ``n`` leave the similarity a Beta(m + 1, n - m + 1), and the pair is dropped as
soon as the probability of reaching the threshold is below ``TOLERANCE``. What is left is verified on the sets.

Families are cut into blocks of bounded size, each packed into one row: most families are one. Links are first found inside
blocks, then between any two blocks of a family, which meet in one task, so no task holds a family. Exact numbers of links
of n near copies take n^2 / 2 comparisons, but no row for any of them: a pair of blocks returns one array of numbers for
each side and edges between the parts that the blocks already have, so rows grow with documents, also in a large group.

With 25 bands of five values a pair at 0.8 misses every band with probability 5e-5, at 0.85 with 2e-6.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duelist.llm.common import fresh, importable, plain_words, staged, word_hashes
from duelist.llm.components import components

SHINGLE = 5
THRESHOLD = 0.8
VALUES, BANDS, ROWS, STEP = 128, 25, 5, 16
TOLERANCE = 1e-5
#: Members and words of a packed block; a task holds two blocks.
BLOCK, BLOCK_WORDS = 1024, 1 << 20

_SEEDS = np.random.default_rng(20240229)
_A = _SEEDS.integers(0, 1 << 63, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _SEEDS.integers(0, 1 << 63, VALUES, dtype=np.uint64)
_BAND = _SEEDS.integers(0, 1 << 63, (BANDS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = _SEEDS.integers(0, 1 << 63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(33))


def shingles(hashes: np.ndarray) -> np.ndarray:
    """Sorted different shingle hashes of one text's word hashes; a text of fewer words is one shingle."""
    n = min(SHINGLE, len(hashes))
    if not n:
        return hashes
    total = np.zeros(len(hashes) - n + 1, np.uint64)
    for k in range(n):
        total = _mixed(total + hashes[k : k + len(total)] * _MIX[k])
    return np.unique(total)


def signature(grams: np.ndarray) -> np.ndarray:
    """16 bits of each of the ``VALUES`` smallest hashes."""
    low = np.full(VALUES, np.iinfo(np.uint64).max, np.uint64)
    for s in range(0, len(grams), 4096):
        low = np.minimum(low, (grams[None, s : s + 4096] * _A[:, None] + _B[:, None]).min(axis=1))
    return (_mixed(low) & np.uint64(0xFFFF)).astype(np.uint16)


def least_matches(threshold: float, tolerance: float) -> list[tuple[int, int]]:
    """(values compared, fewest equal ones that keep a pair): P(J >= t | m of n) is P(Binomial(n + 1, t) <= m)."""
    out = []
    for n in range(STEP, VALUES + 1, STEP):
        tail, m = 0.0, -1
        while tail < tolerance:
            m += 1
            tail += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append((n, m))
    return out


def _arrays(column: pa.ListArray) -> Iterator[np.ndarray]:
    flat = column.values.to_numpy(zero_copy_only=False).astype(np.int64, copy=False).view(np.uint64)
    ends = column.offsets.to_numpy()
    return (flat[a:b] for a, b in zip(ends[:-1], ends[1:]))


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets, bands = [], []
        for hashes in _arrays(batch.column("words")):
            grams = shingles(hashes)
            sets.append(hashlib.blake2b(grams.tobytes(), digest_size=16).digest())
            if len(grams):
                values = signature(grams)[: BANDS * ROWS].reshape(BANDS, ROWS).astype(np.uint64)
                keys = _mixed((values * _BAND).sum(axis=1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64))
                bands.append(keys.view(np.int64))
            else:
                bands.append(np.empty(0, np.int64))
        yield pa.RecordBatch.from_arrays(
            [batch.column("row_key"), batch.column("doc_id"), pa.array(sets, pa.binary()), pa.array(bands, pa.list_(pa.int64())),
             pc.list_value_length(batch.column("words")).cast(pa.int64())],
            names=["row_key", "doc_id", "v", "bands", "n_words"])


def row_key(doc_id: str, text: str) -> Column:
    return F.concat_ws(":", F.coalesce(F.col(doc_id).cast("string"), F.lit("-")), F.xxhash64(text))


def _linked(a: np.ndarray, b: np.ndarray, sets: list[np.ndarray], threshold: float) -> np.ndarray:
    """Which of the index pairs reach the threshold, on the sets themselves."""
    sizes = np.array([len(s) for s in sets])
    if len(a) <= 4 * len(sets):
        both = np.fromiter((len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for i, j in zip(a, b)), np.int64, len(a))
    else:
        # shared shingles by matrix products over slices of the vocabulary; shingles of a single text cannot be shared
        names, at, n = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        owner, column = np.repeat(np.arange(len(sets)), sizes), np.where(n > 1, np.cumsum(n > 1) - 1, -1)[at]
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        shared = np.zeros((len(sets), len(sets)), np.float32)
        for c in range(0, int((n > 1).sum()), 4096):
            lo, hi = np.searchsorted(column, [c, c + 4096])
            part = np.zeros((len(sets), 4096), np.float32)
            part[owner[lo:hi], column[lo:hi] - c] = 1
            shared += part @ part.T
        both = shared[a, b].astype(np.int64)
    return both >= threshold * (sizes[a] + sizes[b] - both)


def _pairs(values: list[np.ndarray], least: list[tuple[int, int]], first: np.ndarray, second: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (inside ``first``, or between ``first`` and ``second``) that the incremental comparison keeps."""
    found = []
    others = first if second is None else second
    for k in range(0, len(first), 64):
        some = first[k : k + 64]
        n, fewest = least[0]
        equal = (values[some][:, None, :n] == values[others][None, :, :n]).sum(axis=2)
        keep = equal >= fewest
        if second is None:
            keep &= np.arange(len(first))[None] > np.arange(k, k + len(some))[:, None]
        x, y = np.nonzero(keep)
        equal, a, b, seen = equal[x, y], some[x], others[y], n
        for n, fewest in least[1:]:
            equal = equal + (values[a, seen:n] == values[b, seen:n]).sum(axis=1)
            good = equal >= fewest
            a, b, equal, seen = a[good], b[good], equal[good], n
        found.append((a, b))
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.empty(0, np.int64),) * 2


def _roots(size: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index of the connected part of each index."""
    root = np.arange(size)
    while len(a):
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    return root


def _sets(words: pa.Array) -> tuple[list[np.ndarray], np.ndarray]:
    sets = [shingles(h) for h in _arrays(words)]
    return sets, np.array([signature(s) for s in sets])


_INSIDE = "label binary, block int, roots array<int>, counts array<long>"
_BETWEEN = "label binary, block int, counts array<long>, edges array<struct<a: binary, b: binary>>"


def _inside_blocks(threshold: float, tolerance: float):
    """Links inside each packed block: the part of the block a member belongs to, and its number of links."""
    least = least_matches(threshold, tolerance)

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roots, counts = [], []
            for k in range(batch.num_rows):
                sets, values = _sets(batch.column("words").slice(k, 1).flatten())
                a, b = _pairs(values, least, np.arange(len(sets)), None)
                keep = _linked(a, b, sets, threshold)
                a, b = a[keep], b[keep]
                roots.append(_roots(len(sets), a, b).astype(np.int32))
                counts.append(np.bincount(a, minlength=len(sets)) + np.bincount(b, minlength=len(sets)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), batch.column("block"), pa.array(roots, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64()))],
                names=["label", "block", "roots", "counts"])

    return inside


def _between_blocks(threshold: float, tolerance: float):
    """Links between two packed blocks: what they add to each member's number, and edges between the blocks' parts."""
    least = least_matches(threshold, tolerance)

    def between(group: pa.Table) -> pa.Table:
        table = group.sort_by("block").combine_chunks()
        lists = [table.column(c).chunk(0) for c in ("vs", "words", "roots")]
        size = [len(lists[0].slice(k, 1).flatten()) for k in (0, 1)]
        sets, values = _sets(lists[1].flatten())
        a, b = _pairs(values, least, np.arange(size[0]), np.arange(size[0], sum(size)))
        keep = _linked(a, b, sets, threshold)
        a, b = a[keep], b[keep]
        part = np.concatenate([lists[2].slice(k, 1).flatten().to_numpy() + k * size[0] for k in (0, 1)])
        # one edge per part and part of the other side it reaches, through the smallest of them
        root = _roots(sum(size), part[a], part[b])
        names = lists[0].flatten().to_pylist()
        edges = [{"a": names[k], "b": names[r]} for k, r in enumerate(root) if r != k]
        counts = np.bincount(a, minlength=sum(size)) + np.bincount(b, minlength=sum(size))
        return pa.table({
            "label": table.column("label"), "block": table.column("block"),
            "counts": pa.array([counts[: size[0]], counts[size[0] :]], pa.list_(pa.int64())),
            "edges": pa.array([edges, []], pa.list_(pa.struct([("a", pa.binary()), ("b", pa.binary())]))),
        })

    return between


def families(edges: DataFrame, sets: DataFrame) -> DataFrame:
    """``v``, ``row_key``, ``label`` and ``block`` of every candidate; blocks have about ``BLOCK`` members and
    ``BLOCK_WORDS`` words at most."""
    family = components(edges).join(sets.select("v", "row_key", "n_words"), "v")
    sizes = staged(family.groupBy("label").agg(
        F.expr(f"cast(greatest(ceil(count(*) / {BLOCK}), ceil(sum(n_words) / {BLOCK_WORDS})) AS int) AS blocks")), "jaccard-families")
    return staged(family.join(sizes, "label").selectExpr("v", "row_key", "label", "blocks", "cast(pmod(xxhash64(v), blocks) AS int) AS block"), "jaccard-members")


def links(blocks: DataFrame, threshold: float, tolerance: float) -> tuple[DataFrame, DataFrame]:
    """Edges (``a``, ``b``) that connect what links connect, and ``v``, ``n_links``.

    ``blocks``: packed members of each family, ``label``, ``block``, ``blocks``, ``vs`` and ``words``, one row per block. Pairs
    of blocks meet as two rows, and return one array of counts each and edges between their parts, so nothing has a row per
    member and other block.
    """
    inside = staged(importable(blocks.select("label", "block", "words")).mapInArrow(_inside_blocks(threshold, tolerance), _INSIDE), "jaccard-inside")
    many = blocks.filter("blocks > 1").join(inside.select("label", "block", "roots"), ["label", "block"])
    met = many.selectExpr("*", "explode(filter(sequence(0, blocks - 1), o -> o <> block)) AS other").selectExpr(
        "label", "block", "vs", "words", "roots", "least(block, other) AS i", "greatest(block, other) AS j")
    between = staged(importable(met).groupBy("label", "i", "j").applyInArrow(_between_blocks(threshold, tolerance), _BETWEEN), "jaccard-between")
    own = blocks.select("label", "block", "vs").join(inside, ["label", "block"])
    tops = own.selectExpr("explode(filter(transform(vs, (v, k) -> struct(v AS a, vs[roots[k]] AS b)), e -> e.a <> e.b)) AS e")
    edges = tops.union(between.selectExpr("explode(edges) AS e")).select("e.a", "e.b")
    more = between.groupBy("label", "block").agg(F.collect_list("counts").alias("more"))
    summed = own.join(more, ["label", "block"], "left").selectExpr(
        "vs", "aggregate(coalesce(more, array()), counts, (s, m) -> zip_with(s, m, (x, y) -> x + y)) AS counts")
    return edges, summed.selectExpr("explode(arrays_zip(vs, counts)) AS z").selectExpr("z.vs AS v", "z.counts AS n_links").filter("n_links > 0")


def classes(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", threshold: float = THRESHOLD,
            tolerance: float = TOLERANCE) -> DataFrame:
    """One row per document: ``doc_id``, ``row_key``, ``class_key`` (its connected class), ``class_id`` (smallest doc_id of
    the class), ``n_links`` (different shingle sets at or above the threshold) and ``n_copies`` (documents with the same set,
    itself included).

    Only ``class_key`` tells classes apart: ids may be NULL or shared by unrelated texts, so several classes can have the
    same ``class_id``. It is the smallest set digest of the class, the same in every run.

    Words are lower-case runs of letters and digits. A text of one to four words is one shingle; texts without words
    (NULL, empty) are copies of each other. Repeated rows are copies. NULL ids come into a class but do not name it
    unless it has no other.
    """
    own = docs.select(
        row_key(doc_id, text).alias("row_key"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("_text"))
    words = own.select("row_key", "doc_id", word_hashes(plain_words(F.col("_text"))).alias("words"))
    keys = staged(importable(words).mapInArrow(_keys, "row_key string, doc_id long, v binary, bands array<long>, n_words long"), "jaccard-keys")
    sets = staged(keys.groupBy("v").agg(
        F.min("doc_id").alias("first_id"), F.count("*").alias("n_copies"), F.min("row_key").alias("row_key"), F.first("bands").alias("bands"),
        F.max("n_words").alias("n_words"),
    ), "jaccard-sets")

    # the smallest member of a bucket is its hub
    buckets = sets.select("v", F.explode("bands").alias("band"))
    stars = staged(buckets.groupBy("band").agg(F.min("v").alias("hub"), F.count("*").alias("n")).filter("n > 1").select("band", "hub"), "jaccard-stars")
    # at most one hub a band; all hubs of a member are joined to the smallest of them, so most edges coincide
    hubs = staged(buckets.join(stars, "band").groupBy("v").agg(F.collect_set("hub").alias("hubs")), "jaccard-hubs")
    edges = hubs.selectExpr("explode(concat(array(v), hubs)) AS a", "array_min(hubs) AS b").filter("a <> b").distinct()
    members = families(edges, sets)
    packed = (
        own.join(members.withColumnRenamed("row_key", "_key"), F.col("row_key") == F.col("_key"))
        .select("v", "label", "block", "blocks", word_hashes(plain_words(F.col("_text"))).alias("words"))
        # repeated rows have the same key
        .groupBy("v", "label", "block", "blocks").agg(F.first("words").alias("words"))
        .groupBy("label", "block", "blocks").agg(F.expr("sort_array(collect_list(struct(v, words))) AS m"))
        .selectExpr("label", "block", "blocks", "m.v AS vs", "m.words AS words")
    )
    joined_by, linked = links(staged(packed, "jaccard-blocks"), threshold, tolerance)
    linked = staged(linked, "jaccard-links")
    named = components(joined_by).join(linked, "v").join(sets.select("v", "first_id"), "v")
    named = staged(named, "jaccard-named")
    lowest = named.groupBy("label").agg(F.min("first_id").alias("class_id"))
    joined = named.join(staged(lowest, "jaccard-lowest"), "label").select("v", F.col("label").alias("class_key"), "class_id", "n_links")
    described = staged(sets.select("v", "first_id", "n_copies").join(joined, "v", "left").selectExpr(
        "v", "coalesce(class_key, v) AS class_key", "if(class_key IS NULL, first_id, class_id) AS class_id", "coalesce(n_links, 0L) AS n_links", "n_copies"), "jaccard-classes")
    return keys.select("row_key", "doc_id", "v").join(described, "v").select("doc_id", "row_key", "class_key", "class_id", "n_links", "n_copies")


def keep_one(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """One document of every class stays, the one with the smallest id (NULL last), then row key; columns as they were."""
    key = fresh(docs, "row_key")
    kept = (
        classes(docs, text, doc_id, threshold).groupBy("class_key")
        .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")).alias("first")).select(F.col("first.row_key").alias("_kept"))
    )
    keyed = docs.withColumn(key, row_key(doc_id, text))
    return keyed.join(kept, keyed[key] == kept["_kept"], "left_semi").dropDuplicates([key]).drop(key)
