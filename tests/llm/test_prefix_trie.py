"""Prefix trees of conversations against a dictionary of all prefixes."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from duelist.llm import prefix_trie as pt

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    own: dict[int, list] = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    seqs = {}
    for c, turns in own.items():
        h, base = zlib.crc32(str(c).encode()) % 6, own.get(c - int(c % 100 if c >= 0 else -(-c % 100)), [])
        seqs[c] = tuple(x[2:] for x in [*sorted(base)[:h], *sorted(turns)[h:]])
    members: dict[tuple, list[int]] = {}
    for c in sorted(seqs):
        for d in range(len(seqs[c]) + 1):
            members.setdefault(seqs[c][:d], []).append(c)
    kids = dict.fromkeys(members, 0)
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for path in members:
        if path:
            kids[path[:-1]] += 1
    for path, convs in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += not kids[path]
            saved[path[:d]] += (len(convs) - 1) * len(path[-1][1]) if path else 0
    return sorted(
        (c[0], len(p), members[p[:-1]][0] if p else None, len(c), kids[p], leaves[p], saved[p],
         hashlib.sha256(",".join(str(x) for x in c if len(seqs[x]) == len(p)).encode()).hexdigest()) for p, c in members.items())


def result(found):
    return sorted(tuple(r[c] for c in COLUMNS) for r in found.collect())


def table(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr(
        "*", "1 AS pos", "2 AS part", "3 AS t1", "4 AS first", "5 AS n", "6 AS shard", "7 AS base", "8 AS h")


def conversations(rng, n, longest):
    """Few words and roles, so conversations share beginnings of many lengths; some are copies of others."""
    rows, made = [], []
    for c in rng.sample(range(4 * n), n):
        turns = list(rng.choice(made)) if made and rng.random() < 0.4 else []
        turns = turns[: rng.randint(0, len(turns))] if rng.random() < 0.5 else turns
        turns += [(rng.choice("ua"), rng.choice(["x", "yy", "", "zzz"])) for _ in range(rng.randint(0 if turns else 1, longest))]
        made.append(turns)
        rows += [(c, k, *t) for k, t in enumerate(turns)]
    return rows


@pytest.mark.parametrize("options", [{}, {"band": 4, "group_turns": 8, "shard_turns": 40}, {"band": 3, "group_turns": 3, "shard_turns": 10}])
def test_against_all_prefixes(spark, options):
    rows = conversations(random.Random(3), 150, 9)
    assert result(pt.trie(table(spark, rows).repartition(6), **options)) == brute(rows)


def test_one_conversation_of_most_rows_and_one_very_common(spark):
    rng = random.Random(4)
    rows = [(700, k, "u", f"turn {k % 50}") for k in range(400)]
    rows += [(c, k, "u", f"again {k}") for c in range(10_000, 10_150) for k in range(3)]
    rows += [(c, k, "u", f"turn {k % 50}") for c in (701, 702) for k in range(rng.randint(30, 300))]
    assert result(pt.trie(table(spark, rows), band=16, group_turns=64, shard_turns=100)) == brute(rows)


def test_nulls_ties_repeats_long_texts_and_empty_tables(spark):
    rows = [(None, 0, "u", "lost"), (100, None, "u", "first"), (100, 2, None, None), (100, 2, None, None), (100, 2, "a", "tie"), (101, 0, "u", "own"),
            (101, 1, "u", "x" * 300_000), (102, 5, "u", ""), (203, 0, "u", "no base"), (-250, 0, "u", "below zero"), (-200, 0, "u", "its base"),
            (0, 1, "ab", "c"), (1, 1, "a", "bc"), (2, 7, "u", "é𝄞")]
    rows += [(c, 0, "u", "one turn") for c in range(300, 340)]  # of these, some have no turn of their own left
    assert result(pt.trie(table(spark, rows))) == brute(rows)
    empty = pt.trie(table(spark, rows).limit(0))
    assert set(COLUMNS) <= set(empty.columns) and empty.count() == 0
    turnless = [(c, 0, "u", "gone") for c in range(301, 330) if zlib.crc32(str(c).encode()) % 6]
    assert result(pt.trie(table(spark, turnless))) == brute(turnless) and len(brute(turnless)) == 1
    with pytest.raises(ValueError):
        pt.trie(table(spark, rows), band=64, group_turns=10)


def test_double_array_holds_every_edge_once():
    rng, trie, edges = random.Random(1), pt.DoubleArray(), {}
    states = [0]
    for _ in range(400):
        state = states.pop(rng.randrange(len(states)))
        codes = sorted(rng.sample(range(60), rng.choice([1, 1, 1, 2, 5, 30])))
        base = trie.add_children(state, codes)
        edges.update({(state, c): base + c for c in codes})
        states += [base + c for c in codes]
    assert len(set(edges.values())) == len(edges)
    for (state, c), child in edges.items():
        assert trie.base[state] + c == child and trie.check[child] == state


def test_chunked_hashes():
    import pyarrow as pa

    old, pt.CHUNK = pt.CHUNK, 40
    try:
        rows = [(1, 1, c) for c in range(30)] + [(1, 2, 5)] + [(2, 0, c) for c in range(7)]
        batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[k : k + 4])], names=["p1", "p2", "c"]) for k in range(0, len(rows), 4)]
        got = [r for b in pt._hashed(pt._chunks(iter(batches))) for r in b.to_pylist()]
    finally:
        pt.CHUNK = old
    want = {(1, 1): range(30), (1, 2): [5], (2, 0): range(7)}
    assert {(r["p1"], r["p2"]): r["ends_sha256"] for r in got} == {
        k: hashlib.sha256(",".join(map(str, v)).encode()).hexdigest() for k, v in want.items()}
