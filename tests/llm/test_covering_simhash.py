"""Covering SimHash: masks, fingerprints and components against brute force."""

from __future__ import annotations

import random
import re
from itertools import combinations

import pytest
import xxhash
from pyspark.sql import functions as F

from duelist.llm import covering_simhash as cs
from duelist.llm.components import components
from duelist.llm.queries import QUERIES

ALL = (1 << 64) - 1


def fingerprint(text: str | None) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows: list[tuple[int | None, int]], radius: int = 4) -> dict[int, int | None]:
    """Smallest id of the component of every fingerprint, by comparing all of them."""
    values = sorted({f for _, f in rows})
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in combinations(values, 2):
        if (a ^ b).bit_count() <= radius:
            root[find(a)] = find(b)
    low: dict[int, int] = {}
    for key, f in rows:
        if key is not None:
            low[find(f)] = min(low.get(find(f), key), key)
    return {v: low.get(find(v)) for v in values}


def test_masks_cover_every_change_of_four_bits():
    for free in (ALL, 0x0F0F0F0FFF00FF00, 0xFFFF, 0x3F):
        bits = [b for b in range(64) if free >> b & 1]
        masks = cs.covering(free)
        assert all(m & ~free == 0 for m in masks)
        some = list(combinations(bits, 4)) if len(bits) < 40 else random.Random(1).sample(list(combinations(bits, 4)), 60_000)
        assert all(any(m & x == 0 for m in masks) for x in (sum(1 << b for b in c) for c in some))


def test_three_levels_leave_few_bits_free():
    two = {f & ~m for f in {ALL & ~m for m in cs.covering(ALL)} for m in cs.covering(f)}
    assert max((f & ~m).bit_count() for f in two for m in cs.covering(f)) <= 8


def test_hashes_are_those_of_the_sql_function(spark):
    row = spark.sql("SELECT xxhash64('żółw x y z') AS h").first()
    assert int(cs.shingle_hashes("ŻółW  x\ty\nz".encode().replace("Ż".encode(), "ż".encode()))[0]) == row["h"] % (1 << 64)


def test_query_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    want_fp = {r["doc_id"]: fingerprint(r["text"]) for r in docs}
    want = brute([(k, f) for k, f in want_fp.items()])
    got = QUERIES["op12_covering_simhash"](spark, sf_dir).collect()
    assert len(got) == len(docs)
    for r in got:
        assert r["fingerprint"] == f"{want_fp[r['doc_id']]:016x}" and r["component_id"] == want[want_fp[r["doc_id"]]]
    assert len(set(want.values())) < len(docs)


def test_nulls_ties_repeats_and_foreign_columns(spark):
    base = "one two three four five six seven eight nine ten"
    rows = [(5, base), (3, base.upper()), (None, base), (3, base), (8, None), (7, ""), (9, " \t\n"), (4, "lone"), (None, "other words"),
            (6, "x " * 30_000), (2, "X " * 30_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "1 AS fp", "2 AS component", "3 AS component_id", "4 AS path", "5 AS label", "6 AS v")
    got = cs.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    by_fp: dict[int, set] = {}
    for r in got:
        by_fp.setdefault(r["fp"], set()).add(r["component_id"])
    want = {f if f < 1 << 63 else f - (1 << 64): {c} for f, c in brute([(k, fingerprint(t)) for k, t in rows]).items()}
    assert by_fp == want
    assert {r["component_id"] for r in got if r["doc_id"] in (7, 8, 9)} == {7}
    empty = cs.near_duplicates(docs.limit(0))
    assert empty.columns == ["doc_id", "fp", "component", "component_id"] and empty.count() == 0
    with pytest.raises(ValueError):
        cs.near_duplicates(docs, bucket=255)


@pytest.mark.parametrize("bucket", [256, 2048])
def test_large_buckets_are_split_without_loss(spark, bucket):
    """Fingerprints that differ in a few bits of one centre, so that masks leave thousands of them together."""
    rng = random.Random(7)
    values = {rng.getrandbits(64) for _ in range(300)}
    for centre in list(values)[:3]:
        values |= {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(3, 9))) for _ in range(900)}
    signed = [(v if v < 1 << 63 else v - (1 << 64),) for v in values]
    vertices = spark.createDataFrame(signed, "fp long")
    edges = cs.links(vertices, bucket=bucket).distinct()
    label = {r["v"]: r["label"] for r in components(edges).collect()}
    want = brute([(k, v % (1 << 64)) for k, (v,) in enumerate(signed)])
    groups: dict[int, set] = {}
    for v, c in want.items():
        groups.setdefault(c, set()).add(v)
    for members in groups.values():
        inside = {label.get(v if v < 1 << 63 else v - (1 << 64), v) for v in members}
        assert len(inside) == 1
    assert len({label.get(v[0], ("alone", v[0])) for v in signed}) == len(groups)


def test_edges_grow_with_the_fingerprints(spark):
    """A ball of near copies: twice the members give about twice the edges, not four times."""
    counts = []
    for n in (500, 1000, 2000):
        rng = random.Random(3)
        near = {sum(1 << b for b in rng.sample(range(63), 3)) for _ in range(n)}
        counts.append(cs.links(spark.createDataFrame([(v,) for v in near], "fp long"), bucket=256).count() / len(near))
    assert counts[2] < 1.6 * counts[0]
