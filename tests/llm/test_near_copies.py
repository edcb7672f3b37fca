"""Near groups of op 12: copies with a few words in a hundred changed, against brute force over all pairs of sketches."""

from __future__ import annotations

import random
from itertools import combinations

import numpy as np
from pyspark.sql import functions as F

from duelist.llm import covering_simhash as cs
from duelist.llm.common import staged
from duelist.llm.components import components
from duelist.llm.queries import QUERIES

SKETCHED = "doc_id long, fp long, sketch binary, bands array<long>"


def prose(rng: random.Random, n: int) -> list[str]:
    return [f"w{rng.randrange(4000)}" for _ in range(n)]


def changed(rng: random.Random, words: list[str], share: float) -> list[str]:
    return [f"x{rng.randrange(4000)}" if rng.random() < share else w for w in words]


def sketch(text: str) -> np.ndarray:
    return np.unpackbits(cs.sketches([cs.shingle_hashes(text.encode())])[0][0])


def brute(texts: dict[int, str]) -> dict[int, int]:
    """Smallest id of the near group: equal fingerprints, fingerprints within four bits, sketches within ``APART``."""
    root = {k: k for k in texts}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    bits = {k: sketch(t) for k, t in texts.items()}
    fps = {k: int(cs.majorities([cs.shingle_hashes(t.encode())])[0]) for k, t in texts.items()}
    for a, b in combinations(sorted(texts), 2):
        if (fps[a] ^ fps[b]).bit_count() <= cs.RADIUS or (bits[a].any() and bits[b].any() and (bits[a] != bits[b]).sum() <= cs.APART):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {k: find(k) for k in texts}


def test_near_copies_of_a_larger_group_are_found(spark, folder):
    """Forty copies with four words in a hundred changed, none within four bits of all others, between unrelated texts."""
    rng = random.Random(5)
    first = prose(rng, 300)
    texts = {k: " ".join(changed(rng, first, 0.04)) for k in range(40)}
    texts |= {k: " ".join(prose(rng, rng.randint(5, 400))) for k in range(40, 100)}
    spark.createDataFrame([*texts.items()], "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    got = {r["doc_id"]: r["near_id"] for r in QUERIES["op12_covering_simhash"](spark, folder).collect()}
    assert got == {k: 0 if k < 40 else k for k in texts}


def test_near_groups_against_brute_force(spark):
    rng = random.Random(11)
    texts: dict[int, str] = {}
    for size in (3, 6, 12, 25, 60, 150, 400, 1500):
        first = prose(rng, size)
        for share in (0, 0, 0.02, 0.05, 0.08, 0.12, 0.2, 0.4):
            texts[len(texts)] = " ".join(changed(rng, first, share))
    texts |= {len(texts) + k: t for k, t in enumerate(["", " \n", "lone", "LONE", "x " * 5000, "X " * 9])}
    rows = [*texts.items(), (None, texts[0]), (None, None), (7, texts[7])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "1 AS fp", "2 AS sketch", "3 AS near", "4 AS near_id", "5 AS n", "6 AS key", "7 AS hub", "8 AS lowest").repartition(5)
    got = cs.near_copies(docs).collect()
    assert len(got) == len(rows)
    want = brute(texts)
    blank = next(k for k, t in texts.items() if t == "")
    assert {r["doc_id"]: r["near_id"] for r in got if r["doc_id"] is not None} == want
    assert sorted(r["near_id"] for r in got if r["doc_id"] is None) == sorted([want[0], want[blank]])
    group = {}
    for r in got:
        group.setdefault(r["near"], set()).add(r["near_id"])
    assert all(len(x) == 1 for x in group.values()) and len(group) == len(set(want.values()))
    # the other columns are those of near_duplicates
    columns = ["doc_id", "fp", "component", "component_id"]
    plain = cs.near_duplicates(docs)
    assert sorted(map(str, plain.collect())) == sorted(map(str, cs.near_copies(docs).select(columns).collect()))
    empty = cs.near_copies(docs.limit(0))
    assert empty.columns == [*columns, "near", "near_id"] and empty.count() == 0


def test_equal_sets_with_other_repeats_are_near(spark):
    """The same shingles in other numbers: one sketch, fingerprints far apart."""
    rng = random.Random(2)
    p, q = prose(rng, 40), prose(rng, 40)
    a, b = (" ".join(p + p + q + q + p + tail) for tail in (q * 7, p * 7))
    rows = cs.near_copies(spark.createDataFrame([(1, a), (2, b)], "doc_id long, text string")).collect()
    assert len({r["component_id"] for r in rows}) == 2 and {r["near_id"] for r in rows} == {1}


def test_bits_differ_by_half_of_what_sets_do_not_share():
    rng = np.random.default_rng(3)
    for shared, own in ((900, 50), (600, 200), (500, 250), (100, 450), (0, 500), (1, 0), (4, 2), (0, 1)):
        apart = []
        for _ in range(20):
            both = rng.integers(0, 1 << 63, shared, dtype=np.uint64)
            pair = [np.concatenate((both, rng.integers(0, 1 << 63, own, dtype=np.uint64))) for _ in "ab"]
            bits = np.unpackbits(cs.sketches(pair)[0], axis=1)
            apart.append((bits[0] != bits[1]).mean())
        assert abs(np.mean(apart) - own / (shared + 2 * own)) < 0.02


def test_large_bands_are_cut_without_loss(spark):
    """Bands of a few hundred sketches, cut into blocks of 16, connect what they connect in one piece; edges stay in proportion."""
    rng = random.Random(8)
    texts, per_row = [], []
    for n in (100, 200, 400):
        texts = [" ".join(changed(rng, first, 0.03)) for first in (prose(rng, 200), prose(rng, 90)) for _ in range(n)]
        docs = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
        own = staged(cs._narrow(docs, "text", "doc_id").mapInArrow(cs._sketched, SKETCHED), "test-sketches")
        whole, cut = cs.near_links(own), cs.near_links(own, bucket=16)
        label = [{r["v"]: r["label"] for r in components(e).collect()} for e in (whole, cut)]
        assert label[0] == label[1] and len(set(label[0].values())) == 2
        per_row.append(whole.count() / own.select("fp").distinct().count())
    assert per_row[2] < 1.6 * per_row[0]


def test_sketches_do_not_depend_on_how_rows_are_batched(spark):
    rng = random.Random(4)
    texts = ["", None, *(" ".join(prose(rng, rng.randint(1, 500))) for _ in range(60)), " ".join(prose(rng, 300_000))]
    hashes = [cs.shingle_hashes((t or "").encode()) for t in texts]
    bits, keys = cs.sketches(hashes)
    for k, h in enumerate(hashes):
        one = cs.sketches([h])
        assert (one[0][0] == bits[k]).all() and (one[1][0] == keys[k]).all()
    got = cs._narrow(spark.createDataFrame([*enumerate(texts)], "doc_id long, text string"), "text", "doc_id").mapInArrow(cs._sketched, SKETCHED)
    for r in got.select("doc_id", "sketch", F.col("bands")).collect():
        assert bytes(r["sketch"]) == bits[r["doc_id"]].tobytes() and r["bands"] == keys[r["doc_id"]].view(np.int64).tolist()
