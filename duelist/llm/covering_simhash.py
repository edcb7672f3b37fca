"""SimHash near duplicates by covering locality-sensitive hashing.

A text becomes a 64-bit fingerprint of its four-word shingles. Two fingerprints link if at most ``RADIUS`` bits
differ; documents that links connect are one component.

Candidates come from covering masks. Every bit position gets a vector of ``RADIUS + 1`` bits, and every non-zero vector
``v`` of that kind a mask: the positions whose vector has odd parity with ``v``. Positions where two fingerprints differ,
at most ``RADIUS`` of them, cannot span the space, so some ``v`` is orthogonal to all of them: its mask leaves them all out,
and the pair is equal under it. So 31 tables find every pair within four bits, always, not with some probability.

Equal fingerprints are one vertex. A bucket (equal bits under one mask, about half of them) is compared inside one task
only while it holds at most ``BUCKET`` fingerprints. A larger one is split by the same construction over the bits that its
mask leaves out; after three levels so few bits are free that no bucket can be larger. So rows grow with the number of
fingerprints, by a constant, and no pair is lost. A bucket returns a star per connected part, never its pairs.

One changed word changes four shingles, so a copy with a few words in a hundred changed is about ten bits away and no component
joins it. ``near_copies`` finds it by a second, longer fingerprint, a sketch: one bit of each of ``MINS`` MinHash values of the
shingles. Sets that share half of their shingles differ in a quarter of its bits, give or take 14 of 1,024, and sketches at most
``APART`` bits apart link. Candidates share a band of ``ROWS`` values; a pair at half is in none of the 40 bands with
probability 0.5 %, at 0.6 with 6e-5. A near group is what components and these links connect.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelist.llm.common import importable, staged
from duelist.llm.components import components

BITS, RADIUS, SHINGLE, SEED = 64, 4, 4, 42
BUCKET = 2048
#: Shingles hashed before their bits are counted, and texts; bounds the memory of a task beside its longest text.
TOGETHER, TEXTS = 1 << 18, 2048
_LANES = np.uint64(0x0101010101010101)
#: Values of a sketch, bits in which near copies may differ, bands of candidates and values of a band.
MINS, APART, BANDS, ROWS = 1024, 256, 40, 3
_SEEDS = np.random.default_rng(20240312)
_A = _SEEDS.integers(0, 1 << 31, MINS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_B = _SEEDS.integers(0, 1 << 32, MINS, dtype=np.uint32)
_BAND = _SEEDS.integers(0, 1 << 63, (BANDS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def covering(free: int, radius: int = RADIUS) -> list[int]:
    """Masks over the set bits of ``free`` of which at least one is clear on any ``radius`` of them.

    The vectors are dealt in an order in which a part of a round is balanced too (upper half first), so each mask takes
    about half of the bits.
    """
    size = 1 << (radius + 1)
    order = [*range(size // 2, size), *range(1, size // 2)]
    at = [b for b in range(BITS) if free >> b & 1]
    vector = {b: order[k % len(order)] for k, b in enumerate(at)}
    return [sum(1 << b for b in at if (vector[b] & v).bit_count() & 1) for v in range(1, size)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def shingle_hashes(raw: bytes | None, size: int = SHINGLE) -> np.ndarray:
    """XXH64 of every run of ``size`` words (fewer words: of all of them; none: no hash), repeats included."""
    words = (raw or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    n = max(1, len(words) - size + 1)
    digest = xxhash.xxh64_intdigest
    if n == 1:
        return np.array([digest(joined, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    begin = np.concatenate(([0], ends[: n - 1])).tolist()
    return np.fromiter((digest(joined[a:b], SEED) for a, b in zip(begin, (ends[size - 1 :] - 1).tolist())), np.uint64, n)


def majorities(hashes: list[np.ndarray]) -> np.ndarray:
    """The fingerprint of each array: bits set in over half of its hashes; zero of an empty one."""
    out = np.zeros(len(hashes), np.uint64)
    some = [k for k, h in enumerate(hashes) if len(h)]
    if not some:
        return out
    sizes = np.array([len(hashes[k]) for k in some])
    flat, first = np.concatenate([hashes[k] for k in some]), np.concatenate(([0], np.cumsum(sizes)[:-1]))
    # eight counters of eight bits in a word, so runs of at most 255 hashes are added up first
    runs = -(-sizes // 255)
    owner = np.repeat(np.arange(len(some)), runs)
    nth = np.arange(len(owner)) - np.repeat(np.concatenate(([0], np.cumsum(runs)[:-1])), runs)
    starts, of = first[owner] + 255 * nth, np.concatenate(([0], np.cumsum(runs)[:-1]))
    value = np.zeros(len(some), np.uint64)
    for shift in range(8):
        lanes = np.add.reduceat((flat >> np.uint64(shift)) & _LANES, starts)
        counts = np.add.reduceat(lanes.astype("<u8").view(np.uint8).reshape(-1, 8).astype(np.int64), of, axis=0)
        for lane in range(8):
            value |= (2 * counts[:, lane] > sizes).astype(np.uint64) << np.uint64(8 * lane + shift)
    out[some] = value
    return out


def sketches(hashes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sketch (``MINS`` bits as bytes) and band keys of each array; zeros of an empty one."""
    bits, keys = np.zeros((len(hashes), MINS // 8), np.uint8), np.zeros((len(hashes), BANDS), np.uint64)
    some = [k for k, h in enumerate(hashes) if len(h)]
    if not some:
        return bits, keys
    flat = (np.concatenate([hashes[k] for k in some]) >> np.uint64(32)).astype(np.uint32)
    first = np.concatenate(([0], np.cumsum([len(hashes[k]) for k in some])[:-1]))
    low = np.array([np.minimum.reduceat(flat * a + b, first) for a, b in zip(_A, _B)]).T
    banded = (low[:, : BANDS * ROWS].reshape(-1, BANDS, ROWS) * _BAND).sum(axis=2, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64)
    keys[some] = (banded ^ (banded >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    # the value's own bits are those of its shingle, so that they are mixed before one is taken
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
        low = (low ^ (low >> np.uint32(shift))) * np.uint32(factor)
    bits[some] = np.packbits((low >> np.uint32(31)).astype(bool), axis=1)
    return bits, keys


def _binary(rows: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(rows.shape[1]), len(rows), [None, pa.py_buffer(rows.tobytes())]).cast(pa.binary())


def _hashed(column: pa.Array) -> Iterator[list[np.ndarray]]:
    held, waiting = [], 0
    for raw in column.cast(pa.binary()):
        held.append(shingle_hashes(raw.as_py()))
        waiting += len(held[-1])
        if waiting >= TOGETHER or len(held) >= TEXTS:
            yield held
            held, waiting = [], 0
    yield held


def _fingerprinted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts = [majorities(held) for held in _hashed(batch.column(1))]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(np.concatenate(parts).view(np.int64))], names=["doc_id", "fp"])


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts = [(majorities(held), *sketches(held)) for held in _hashed(batch.column(1))]
        fp, bits, keys = (np.concatenate(x) for x in zip(*parts))
        ends = np.arange(0, keys.size + 1, BANDS, dtype=np.int32)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(fp.view(np.int64)), _binary(bits), pa.ListArray.from_arrays(ends, keys.ravel().view(np.int64))],
            names=["doc_id", "fp", "sketch", "bands"])


def _narrow(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    return importable(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")))


def fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id``, ``fp`` (the 64 bits as a long) of every row. NULL, empty and blank texts have fingerprint zero."""
    return _narrow(docs, text, doc_id).mapInArrow(_fingerprinted, "doc_id long, fp long")


def _stars(values: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(member, hub) for each connected part of the fingerprints of one bucket."""
    near = np.zeros((len(values), len(values)), bool)
    for k in range(0, len(values), 256):
        near[k : k + 256] = np.bitwise_count(values[k : k + 256, None] ^ values[None]) <= radius
    hub = np.full(len(values), -1)
    for k in range(len(values)):
        if hub[k] < 0:
            new = np.array([k])
            while len(new):
                hub[new] = k
                new = np.flatnonzero(near[new].any(axis=0) & (hub < 0))
    member = np.flatnonzero(hub != np.arange(len(values)))
    return values[member], values[hub[member]]


def _bucket_stars(radius: int):
    def stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            flat, ends = lists.values.to_numpy(zero_copy_only=False).view(np.uint64), lists.offsets.to_numpy()
            sizes = np.diff(ends)
            a, b = flat[ends[:-1][sizes == 2]], flat[ends[:-1][sizes == 2] + 1]  # pairs are most of the buckets
            close = np.bitwise_count(a ^ b) <= radius
            found = [(a[close], b[close])]
            found += [_stars(flat[s:e], radius) for s, e in zip(ends[:-1][sizes > 2], ends[1:][sizes > 2])]
            one, two = (np.concatenate(x) for x in zip(*found))
            yield pa.RecordBatch.from_arrays([pa.array(one.view(np.int64)), pa.array(two.view(np.int64))], names=["a", "b"])

    return stars


def links(vertices: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """Edges ``a``, ``b`` between the distinct values of ``vertices.fp`` that connect whatever pairs within ``radius``
    connect; every edge is such a pair or joins the ends of a path of them."""
    spark = vertices.sparkSession
    # the masks are a fixed table of 31, 31 ** 2 or 31 ** 3 rows, whatever the data
    level = {0: (1 << BITS) - 1}
    inside, found = vertices.select(F.lit(0).alias("path"), "fp"), []
    while True:
        deeper = {}
        rows = []
        for path, free in level.items():
            taken = ((1 << BITS) - 1) ^ free
            for v, mask in enumerate(covering(free, radius)):
                deeper[path * 64 + v + 1] = free & ~mask
                rows.append((path, path * 64 + v + 1, _signed(mask | taken)))
        if len(rows) < 64:
            choices = F.array(*(F.struct(F.lit(r[1]).alias("path"), F.lit(r[2]).cast("long").alias("mask")) for r in rows))
            masked = inside.select("fp", F.explode(choices).alias("m")).selectExpr("m.path", "fp & m.mask AS key", "fp")
        else:
            masks = spark.createDataFrame(rows, "path int, next int, mask long")
            masked = inside.join(F.broadcast(masks), "path").selectExpr("next AS path", "fp & mask AS key", "fp")
        # fingerprints of one bucket only; its members come back by a join, which can be split where a bucket is large
        sizes = staged(masked.groupBy("path", "key").agg(F.count("*").alias("n")).filter("n > 1"), "covering-buckets")
        small = masked.join(sizes.filter(F.col("n") <= bucket).select("path", "key"), ["path", "key"])
        lists = small.groupBy("path", "key").agg(F.collect_list("fp").alias("members")).select("members")
        found.append(importable(lists).mapInArrow(_bucket_stars(radius), "a long, b long"))
        large = sizes.filter(F.col("n") > bucket).select("path", "key")
        if large.isEmpty():
            break
        inside = staged(masked.join(large, ["path", "key"]).select("path", "fp"), "covering-large")
        paths = {r["path"] for r in large.select("path").distinct().collect()}  # at most the rows of the mask table
        level = {p: deeper[p] for p in paths}
    edges = found[0]
    for more in found[1:]:
        edges = edges.union(more)
    return edges


def _near_parts(values: np.ndarray, apart: int) -> np.ndarray:
    """First index of the connected part of each sketch. What a part has already reached is not compared again."""
    hub, left = np.full(len(values), -1), np.arange(len(values))
    while len(left):
        start, left = left[0], left[1:]
        hub[start], reached = start, np.array([start])
        while len(reached) and len(left):
            some, reached = reached[:16], reached[16:]
            close = np.zeros(len(left), bool)
            for k in some:
                close |= np.bitwise_count(values[left] ^ values[k]).sum(axis=1, dtype=np.int64) <= apart
            hub[left[close]], reached, left = start, np.concatenate((reached, left[close])), left[~close]
    return hub


def _near_stars(apart: int):
    def stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, fixed = batch.column(0), batch.column(1).values.cast(pa.binary(MINS // 8))
            fps, ends = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            values = np.frombuffer(fixed.buffers()[1], np.uint64).reshape(-1, MINS // 64)[fixed.offset :]
            sizes, at = np.diff(ends), ends[:-1]
            # by fingerprint, so that the first of a part is its smallest and bands share their hubs
            order = np.lexsort((fps, np.repeat(np.arange(len(sizes)), sizes)))
            fps, values, hub = fps[order], values[order], np.arange(len(fps))
            two = at[sizes == 2]
            close = np.bitwise_count(values[two] ^ values[two + 1]).sum(axis=1, dtype=np.int64) <= apart
            hub[two[close] + 1] = two[close]
            for s, e in zip(at[sizes > 2], ends[1:][sizes > 2]):
                hub[s:e] = s + _near_parts(values[s:e], apart)
            member = np.flatnonzero(fps != fps[hub])
            yield pa.RecordBatch.from_arrays([pa.array(fps[member]), pa.array(fps[hub[member]])], names=["a", "b"])

    return stars


def near_links(own: DataFrame, apart: int = APART, bucket: int = BUCKET) -> DataFrame:
    """Edges ``a``, ``b`` between fingerprints that connect what equal sketches and sketches at most ``apart`` bits apart
    connect. ``own``: ``fp``, ``sketch`` and ``bands``, written; sketches of no shingle are all zero and have no candidates.

    A band of at most ``bucket`` sketches is compared inside one task. A larger one is cut into blocks of about that size,
    each one row; any two blocks meet in a task, so no task holds a large band and rows grow with the sketches.
    """
    sets = own.groupBy("sketch").agg(F.min("fp").alias("fp"), F.max("fp").alias("last"), F.min("bands").alias("bands"))
    sets = staged(sets.select(F.monotonically_increasing_id().alias("n"), "*"), "near-sets")
    several = sets.filter("fp <> last").select("sketch", F.col("fp").alias("hub"))
    equal = own.select("sketch", "fp").distinct().join(several, "sketch").filter("fp <> hub").selectExpr("fp AS a", "hub AS b")
    keyed = sets.filter(F.col("sketch") != F.lit(bytes(MINS // 8))).select("n", F.explode("bands").alias("key"))
    sizes = staged(keyed.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1"), "near-buckets")

    def members(some: str, *by: str) -> DataFrame:
        blocks = sizes.filter(some).selectExpr("key", f"cast(ceil(size / {bucket}) AS int) AS blocks")
        dealt = keyed.join(blocks, "key").withColumn("block", F.expr("cast(pmod(xxhash64(n, key), blocks) AS int)"))
        return dealt.join(sets.select("n", "fp", "sketch"), "n").groupBy(*by).agg(F.collect_list(F.struct("fp", "sketch")).alias("m"))

    lists = members(f"size <= {bucket}", "key").select("m")
    blocks = staged(members(f"size > {bucket}", "key", "block", "blocks"), "near-blocks")
    met = blocks.selectExpr("key", "block", "m", "explode(sequence(0, blocks - 1)) AS other").selectExpr(
        "key", "least(block, other) AS i", "greatest(block, other) AS j", "m")
    lists = lists.union(met.groupBy("key", "i", "j").agg(F.flatten(F.collect_list("m")).alias("m")).select("m"))
    found = importable(lists.select("m.fp", "m.sketch")).mapInArrow(_near_stars(apart), "a long, b long")
    # a member has a hub in every band at most; joined to the smallest of them, most edges coincide
    hubs = found.groupBy("a").agg(F.collect_set("b").alias("hubs"))
    return equal.union(hubs.selectExpr("explode(concat(array(a), hubs)) AS a", "array_min(hubs) AS b").filter("a <> b").distinct())


def _classes(own: DataFrame, radius: int, bucket: int) -> tuple[DataFrame, DataFrame]:
    """``fp``, ``component``, ``component_id`` of every fingerprint, and ``fp``, ``first_id``."""
    vertices = staged(own.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-vertices")
    return _named(vertices, links(vertices.select("fp"), radius, bucket), "component"), vertices


def _named(vertices: DataFrame, edges: DataFrame, name: str) -> DataFrame:
    parts = components(edges)
    lowest = parts.join(vertices, parts["v"] == vertices["fp"]).groupBy("label").agg(F.min("first_id").alias("lowest"))
    named = staged(parts.join(staged(lowest, "simhash-lowest"), "label").select(F.col("v").alias("fp"), "label", "lowest"), "simhash-components")
    return staged(vertices.join(named, "fp", "left").selectExpr(
        "fp", f"coalesce(label, fp) AS {name}", f"if(label IS NULL, first_id, lowest) AS {name}_id"), "simhash-classes")


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``fp``, ``component`` (its key, smallest signed fingerprint of the component) and
    ``component_id`` (smallest doc_id of the component).

    Texts without words (NULL, empty, blank) have fingerprint zero and link like any other. A text of one to three words is
    one shingle. Repeated rows are copies and keep their rows. NULL ids belong to a component but do not name it unless
    it has no other; rows that share an id are not linked by it. Other columns of ``docs`` are not looked at; an empty
    table gives an empty result. Texts of any length are hashed whole.
    """
    if bucket < 256:
        # three levels leave at most eight free bits, so no bucket can be larger than this after them
        raise ValueError("bucket must be at least 256")
    own = staged(fingerprints(docs, text, doc_id), "simhash")
    every, _ = _classes(own, radius, bucket)
    return own.join(every, "fp").select("doc_id", "fp", "component", "component_id")


def near_copies(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``near_duplicates`` with ``near`` (the key of the near group, its smallest signed fingerprint) and ``near_id``
    (smallest doc_id of the near group).

    Near groups are unions of components, so whatever has a component in common has a near group in common too.
    """
    own = staged(_narrow(docs, text, doc_id).mapInArrow(_sketched, "doc_id long, fp long, sketch binary, bands array<long>"), "sketches")
    every, vertices = _classes(own, RADIUS, BUCKET)
    edges = every.filter("component <> fp").selectExpr("fp AS a", "component AS b").union(near_links(own))
    near = _named(vertices, edges, "near")
    return own.join(every.join(near, "fp"), "fp").select("doc_id", "fp", "component", "component_id", "near", "near_id")
