"""Prefix tree of conversations from double-array tries per prefix shard.

Conversations are sequences of turns (role, text); each different beginning is a node. Sequences are cut into *units* of
at most ``BAND`` turns; a unit is known by the digest of everything before it (its entry) and of everything up to
its end, and equal units of many conversations are one row with a count. Units that begin alike go to one shard, so their
nodes are made there and nowhere else. Where too many turns share a beginning, one, two, four, ... more turns are
looked at, until a group of units is small enough for a task: the nodes up to that depth are *shared* by several shards.

A task packs its units into a double array over the shard's dense turn ids (``BASE[s] + id`` is the child, ``CHECK``
names its parent), walks all units through it level by level, and sums up what hangs below each node. Partial records of
shared nodes, and of the last nodes of full units, where another shard goes on, are merged globally; their
subtree sums run over this small upper tree by pointer doubling. Where conversations are longer than a unit, a second
walk adds what the merged nodes say about the turns below.

So no task holds a conversation, a beginning or the list of a node's conversations; the latter is hashed as a stream
of text chunks in order of conv_id.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelist.llm.common import importable, staged

BAND = 512
#: Turns that may share a beginning within one task, and turns of a shard.
GROUP_TURNS, SHARD_TURNS = 50_000, 200_000
CHUNK = 1 << 16
# Conversations begin with up to five turns of the first one of their hundred.
HEAD_OF, HEADS = 100, 6


class DoubleArray:
    """A trie in two arrays. Children of a state are at ``base[state] + code``; ``check`` holds the parent, -1 if free."""

    def __init__(self):
        self.base, self.check, self.next = array("q", [0]), array("q", [-2]), array("q", [1])  # state 0 is the root

    def _grow(self, place: int) -> None:
        have = len(self.check)
        if place >= have:
            self.base.extend(repeat(0, place + 1 - have))
            self.check.extend(repeat(-1, place + 1 - have))
            self.next.extend(range(have, place + 1))

    def _free(self, place: int) -> int:
        """First free place at or behind ``place``. A taken place points onward; the way is shortened."""
        at = place
        self._grow(at)
        while self.next[at] != at:
            at = self.next[at]
            self._grow(at)
        while self.next[place] != at:
            self.next[place], place = at, self.next[place]
        return at

    def add_children(self, state: int, codes: list[int]) -> int:
        """Finds the lowest base where all (sorted) codes are free, and takes them."""
        place = self._free(codes[0] + 1)
        while True:
            base = place - codes[0]
            if all(self._free(base + c) == base + c for c in codes[1:]):
                break
            place = self._free(place + 1)
        self.base[state] = base
        for c in codes:
            self.check[base + c] = state
            self.next[base + c] = base + c + 1
        return base


def _dense(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Numbers from 0 for the different pairs."""
    pairs = np.ascontiguousarray(np.stack([a, b], axis=1)).view([("a", np.int64), ("b", np.int64)]).ravel()
    return np.unique(pairs, return_inverse=True)[1].ravel()


def shard_nodes(units: pa.Table, band: int) -> dict[str, np.ndarray]:
    """Records of all nodes of the units of one shard; see ``_NODE``."""
    def column(name):
        return units.column(name).to_numpy()

    lists = units.column("turns").combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    ends = lists.offsets.to_numpy()
    first, size = ends[:-1], np.diff(ends)
    t1, t2, cp, f1, f2 = (lists.values.field(k).to_numpy(zero_copy_only=False) for k in ("t1", "t2", "cp", "f1", "f2"))
    code = _dense(t1, t2)
    entry = _dense(column("e1"), column("e2")) + (code.max() + 1)
    weight, conv, split, start = column("n"), column("first"), column("s"), column("start")
    trie = DoubleArray()
    levels: list[np.ndarray] = []
    state = np.zeros(len(units), np.int64)
    held: dict[str, list[np.ndarray]] = {k: [] for k in ("state", "parent", "p1", "p2", "depth", "n", "first", "cp", "unit_depth", "shared", "below_leaves", "below_saved")}
    prefix1, prefix2 = column("e1").copy(), column("e2").copy()
    for d in range(-1, int(size.max())):
        here = np.flatnonzero(size > d)
        at = first[here] + d
        codes = entry[here] if d < 0 else code[at]
        order = np.lexsort((codes, state[here]))
        s, c = state[here][order], codes[order]
        fresh = np.concatenate(([True], (s[1:] != s[:-1]) | (c[1:] != c[:-1])))
        parents, children = s[fresh], c[fresh].tolist()
        cut = np.flatnonzero(np.concatenate(([True], parents[1:] != parents[:-1], [True]))).tolist()
        for a, b in zip(cut[:-1], cut[1:]):
            trie.add_children(int(parents[a]), children[a:b])
        # walk: every unit takes the transition of its turn
        base, check = np.array(trie.base, np.int64), np.array(trie.check, np.int64)
        below = base[state[here]] + codes
        if (check[below] != state[here]).any():
            raise AssertionError("a unit left its trie")
        came, state[here] = state[here].copy(), below
        if d >= 0:
            prefix1[here] ^= f1[at]
            prefix2[here] ^= f2[at]
        names, one, member = np.unique(below, return_index=True, return_inverse=True)
        member = member.ravel()
        n, low = np.zeros(len(names), np.int64), np.full(len(names), np.iinfo(np.int64).max)
        np.add.at(n, member, weight[here])
        np.minimum.at(low, member, conv[here])
        rep = here[one]
        levels.append(names)
        held["state"].append(names)
        held["parent"].append(came[one])
        held["p1"].append(prefix1[rep])
        held["p2"].append(prefix2[rep])
        held["depth"].append(start[rep] + d + 1)
        held["n"].append(n if d >= 0 else np.zeros(len(names), np.int64))
        held["first"].append(low)
        held["cp"].append(np.zeros(len(names), np.int64) if d < 0 else cp[at[one]])
        held["unit_depth"].append(np.full(len(names), d + 1))
        held["shared"].append(d + 1 <= split[rep])
        for k in ("below_leaves", "below_saved"):
            held[k].append(column(k)[rep] if d + 1 == band else np.zeros(len(names), np.int64))
    node = {k: np.concatenate(v) for k, v in held.items()}
    index = np.full(int(node["state"].max()) + 1, -1)
    index[node["state"]] = np.arange(len(node["state"]))
    up = np.where(node["unit_depth"] > 0, index[node["parent"]], -1)
    edge = node["unit_depth"] == band
    own = ~node["shared"] & ~edge
    skeleton = ~own
    kids = np.zeros(len(up), np.int64)
    inner = (up >= 0) & ~node["shared"]
    np.add.at(kids, up[inner], 1)
    leaves = np.where(own, (kids == 0).astype(np.int64), np.where(edge, node["below_leaves"], 0))
    saved = np.where(own, (node["n"] - 1) * node["cp"], np.where(edge, node["below_saved"], 0))
    anc = np.full(len(up), -1)
    at_depth = np.concatenate(([0], np.cumsum([len(x) for x in levels])))
    for a, b in zip(at_depth[:-1], at_depth[1:]):
        some = np.arange(a, b)[up[a:b] >= 0]
        anc[some] = np.where(skeleton[up[some]], up[some], anc[up[some]])
    for a, b in reversed(list(zip(at_depth[:-1], at_depth[1:]))):
        some = np.arange(a, b)[inner[a:b]]
        np.add.at(leaves, up[some], leaves[some])
        np.add.at(saved, up[some], saved[some])
    # the sums of last nodes of full units came from below and are known there
    leaves[edge] = 0
    saved[edge] = 0
    pick = lambda values, where: np.where(where >= 0, values[where], 0)
    return {
        "p1": node["p1"], "p2": node["p2"], "depth": node["depth"], "q1": pick(node["p1"], up), "q2": pick(node["p2"], up),
        "a1": pick(node["p1"], anc), "a2": pick(node["p2"], anc), "has_parent": up >= 0, "n": node["n"],
        "first": np.where(node["unit_depth"] > 0, node["first"], np.iinfo(np.int64).max), "cp": node["cp"], "kids": kids, "leaves": leaves,
        "saved": saved, "up": node["shared"] & (up >= 0), "own": own,
        "parent_first": np.where(up >= 0, np.where(own[up], node["first"][up], np.iinfo(np.int64).max), np.iinfo(np.int64).max),
    }


_NODE = ("p1 long, p2 long, depth long, q1 long, q2 long, a1 long, a2 long, has_parent boolean, n long, first long, cp long, kids long, "
         "leaves long, saved long, up boolean, own boolean, parent_first long")


def _nodes(units: DataFrame, band: int) -> DataFrame:
    def nodes(group: pa.Table) -> pa.Table:
        found = shard_nodes(group, band)
        return pa.table({name.split()[0]: pa.array(found[name.split()[0]]) for name in _NODE.split(", ")})

    return importable(units).groupBy("shard").applyInArrow(nodes, _NODE)


def _positions(turns: DataFrame, conv_id: str, turn: str, role: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Turns as digests with their place in the conversation, and the length of each conversation. A sorted table gives
    the places, so a conversation may span any number of tasks."""
    clean = turns.filter(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    rows = staged(clean.repartitionByRange(*order).sortWithinPartitions(*order).selectExpr(
        "conv_id", "spark_partition_id() AS part", "monotonically_increasing_id() AS at",
        "xxhash64(role, text) AS t1", "xxhash64('second', text, role) AS t2", "cast(length(text) AS bigint) AS cp"), "trie-turns")
    parts = staged(rows.groupBy("conv_id", "part").agg(F.count("*").alias("n"), F.min("at").alias("low")).selectExpr(
        "conv_id", "part", "n", "low",
        "coalesce(sum(n) OVER (PARTITION BY conv_id ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) - low AS shift"), "trie-parts")
    placed = rows.join(parts.select("conv_id", "part", "shift"), ["conv_id", "part"]).selectExpr("conv_id", "at + shift AS pos", "t1", "t2", "cp")
    return placed, parts.groupBy("conv_id").agg(F.sum("n").alias("n_turns"))


def rebuilt(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Every conversation with the beginning of the first one of its hundred: its turns (``conv_id``, ``pos``, ``t1``, ``t2``, ``cp``)
    and the list of conversations (``conv_id``)."""
    placed, lengths = _positions(turns, conv_id, turn, role, text)
    heads = placed.filter(f"pos < {HEADS - 1} AND conv_id % {HEAD_OF} = 0").groupBy("conv_id").agg(
        F.expr("sort_array(collect_list(struct(pos, t1, t2, cp)))").alias("head")).withColumnRenamed("conv_id", "base")
    convs = lengths.selectExpr("conv_id", f"conv_id - conv_id % {HEAD_OF} AS base", f"cast(crc32(cast(conv_id AS string)) % {HEADS} AS int) AS h")
    plans = staged(convs.join(heads, "base", "left").selectExpr(
        "conv_id", "h", "slice(head, 1, h) AS head", "if(head IS NULL, 0, least(h, size(head))) AS taken"), "trie-plans")
    taken = plans.filter("taken > 0").selectExpr("conv_id", "explode(head) AS x").selectExpr("conv_id", "x.pos", "x.t1", "x.t2", "x.cp")
    rest = placed.join(plans.select("conv_id", "h", "taken"), "conv_id").filter("pos >= h").selectExpr("conv_id", "pos - h + taken AS pos", "t1", "t2", "cp")
    return taken.union(rest), plans.select("conv_id")


def _sharded(units: DataFrame, band: int, group_turns: int, shard_turns: int) -> DataFrame:
    """Adds ``s``, the depth in the unit down to which nodes are shared, and ``shard``."""
    depths = [0, *(1 << k for k in range(band.bit_length()) if 1 << k < band), band]
    marks = units.selectExpr(
        "x1", "x2", "size(turns) AS n",
        f"explode(transform(array({', '.join(map(str, depths))}), s -> struct(s, aggregate(slice(turns, 1, s), e1, (a, x) -> a ^ x.f1) AS m1, "
        "aggregate(slice(turns, 1, s), e2, (a, x) -> a ^ x.f2) AS m2))) AS m").selectExpr("x1", "x2", "n", "m.s", "m.m1", "m.m2")
    marks = staged(marks, "trie-marks")
    small = marks.groupBy("s", "m1", "m2").agg(F.sum("n").alias("n")).filter(F.col("n") <= group_turns).drop("n")
    chosen = marks.join(small, ["s", "m1", "m2"]).groupBy("x1", "x2").agg(F.expr("min(struct(s, m1, m2)) AS m"))
    total = units.agg(F.sum(F.size("turns"))).first()[0] or 0
    shards = -(-total // shard_turns) or 1
    return units.join(chosen, ["x1", "x2"]).selectExpr("*", "cast(m.s AS long) AS s", f"pmod(xxhash64(m.s, m.m1, m.m2), {shards}) AS shard").drop("m")


def _subtree_sums(upper: DataFrame) -> DataFrame:
    """``p1``, ``p2`` and the sums of ``leaves`` and ``saved`` over each node's part of the merged tree. Every round reaches
    twice as far down; the rounds are the logarithm of its depth."""
    now = staged(upper.select("p1", "p2", "a1", "a2", "leaves", "saved"), "trie-sums")
    while not now.filter("a1 IS NOT NULL").isEmpty():
        add = now.filter("a1 IS NOT NULL").groupBy("a1", "a2").agg(F.sum("leaves").alias("l"), F.sum("saved").alias("v")).withColumnsRenamed({"a1": "p1", "a2": "p2"})
        jump = now.selectExpr("p1 AS a1", "p2 AS a2", "a1 AS b1", "a2 AS b2")
        now = staged(now.join(add, ["p1", "p2"], "left").join(jump, ["a1", "a2"], "left").selectExpr(
            "p1", "p2", "b1 AS a1", "b2 AS a2", "leaves + coalesce(l, 0) AS leaves", "saved + coalesce(v, 0) AS saved"), "trie-sums")
    return now.select("p1", "p2", "leaves", "saved")


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (p1, p2, conv_id) to pieces of the text that lists them."""
    def out(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.string()))],
                                          names=["p1", "p2", "first", "ids"])

    key, ids, size, rows, waiting = None, [], 0, [], 0
    for batch in batches:
        for p1, p2, conv in zip(*(c.to_pylist() for c in batch.columns)):
            if (p1, p2) != key or size > CHUNK:
                if ids:
                    rows.append((*key, ids[0], ",".join(map(str, ids))))
                    waiting += size
                key, ids, size = (p1, p2), [], 0
                if waiting > 64 * CHUNK or len(rows) > 10_000:
                    yield out(rows)
                    rows, waiting = [], 0
            ids.append(conv)
            size += 12
    if ids:
        rows.append((*key, ids[0], ",".join(map(str, ids))))
    if rows:
        yield out(rows)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted chunks to one digest per node; only the state of one hash is held."""
    key, state = None, None
    for batch in batches:
        rows = []
        for p1, p2, ids in zip(*(batch.column(c).to_pylist() for c in ("p1", "p2", "ids"))):
            if (p1, p2) == key:
                state.update(b",")
            else:
                if state:
                    rows.append((*key, state.hexdigest()))
                key, state = (p1, p2), hashlib.sha256()
            state.update(ids.encode())
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["p1", "p2", "ends_sha256"])
    if state:
        yield pa.RecordBatch.from_arrays([pa.array([key[0]]), pa.array([key[1]]), pa.array([state.hexdigest()])], names=["p1", "p2", "ends_sha256"])


def trie(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", band: int = BAND,
         group_turns: int = GROUP_TURNS, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per node: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens``, ``ends_sha256``, and ``node``, its digest.

    Turns are in order of ``turn`` (NULL first), those with an equal one in order of role and text; repeated rows are
    turns of their own. NULL roles and texts are empty. Rows without a conv_id belong to no conversation and are left out.
    The base of a conversation is ``conv_id - conv_id % 100`` with the sign of the dividend, as SQL has it. An empty table
    has no nodes, not even a root. Texts may be of any length: only their digest and size are kept. Other columns are not looked at.
    """
    if group_turns < band:
        raise ValueError("a group must hold a unit")
    sequences, convs = rebuilt(turns, conv_id, turn, role, text)
    hashed = sequences.selectExpr("conv_id", "pos", "t1", "t2", "cp", "xxhash64(pos, t1, t2) AS f1", "xxhash64('second', t2, t1, pos) AS f2")
    own = hashed.groupBy("conv_id", F.expr(f"pos div {band} AS band")).agg(
        F.expr("sort_array(collect_list(struct(pos, t1, t2, cp, f1, f2))) AS turns"), F.expr("bit_xor(f1) AS g1"), F.expr("bit_xor(f2) AS g2"))
    before = "OVER (PARTITION BY conv_id ORDER BY band ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    own = staged(own.selectExpr("*", f"coalesce(bit_xor(g1) {before}, 0L) AS e1", f"coalesce(bit_xor(g2) {before}, 0L) AS e2").selectExpr(
        "conv_id", "band", "turns", "e1", "e2", "e1 ^ g1 AS x1", "e2 ^ g2 AS x2", "g1", "g2"), "trie-own-units")
    units = staged(own.groupBy("e1", "e2", "x1", "x2").agg(
        F.count("*").alias("n"), F.min("conv_id").alias("first"), F.first("turns").alias("turns"), F.min(F.expr(f"band * {band}")).alias("start")), "trie-units")
    units = staged(_sharded(units, band, group_turns, shard_turns), "trie-shards")
    records = staged(_nodes(units.selectExpr("*", "0L AS below_leaves", "0L AS below_saved"), band), "trie-nodes")

    # shared nodes and last nodes of full units, from all shards; the root holds every conversation
    top = convs.agg(F.count("*").alias("n"), F.min("conv_id").alias("first")).selectExpr(
        "0L AS p1", "0L AS p2", "0L AS depth", "0L AS q1", "0L AS q2", "0L AS a1", "0L AS a2", "false AS has_parent", "n", "first", "0L AS cp",
        "0L AS kids", "0L AS leaves", "0L AS saved", "false AS up", "false AS own", "cast(NULL AS bigint) AS parent_first")
    merged = records.filter("NOT own").union(top).groupBy("p1", "p2").agg(
        F.max("depth").alias("depth"), *(F.expr(f"max({c}) FILTER (WHERE has_parent) AS {c}") for c in ("q1", "q2", "a1", "a2")),
        *(F.sum(c).alias(c) for c in ("n", "kids", "leaves", "saved")), F.min("first").alias("first"), F.max("cp").alias("cp"), F.max("up").alias("up"),
        F.expr(f"nullif(min(parent_first), {2**63 - 1}L) AS parent_first"))
    merged = staged(merged.filter("n > 0"), "trie-merged")
    children = merged.filter("up").groupBy("q1", "q2").agg(F.count("*").alias("more")).withColumnsRenamed({"q1": "p1", "q2": "p2"})
    merged = staged(merged.join(children, ["p1", "p2"], "left").selectExpr(
        "p1", "p2", "depth", "q1", "q2", "a1", "a2", "n", "first", "parent_first", "kids + coalesce(more, 0L) AS kids",
        "leaves + if(kids + coalesce(more, 0L) = 0, 1L, 0L) AS leaves", "saved + (n - 1) * cp AS saved"), "trie-upper")
    sums = _subtree_sums(merged)

    inner = records.filter("own")
    goes_on = units.filter(f"size(turns) = {band}")
    if not goes_on.isEmpty():
        known = sums.selectExpr("p1 AS x1", "p2 AS x2", "leaves AS below_leaves", "saved AS below_saved")
        # a unit that is not full has no last node whose sums are needed
        full = units.join(known, ["x1", "x2"], "left").selectExpr(
            *units.columns, *(f"if(size(turns) = {band}, {c}, 0L) AS {c}" for c in ("below_leaves", "below_saved")))
        inner = staged(_nodes(full, band), "trie-nodes-with-below").filter("own")

    firsts = merged.selectExpr("p1 AS q1", "p2 AS q2", "first AS upper_first")
    below = inner.join(firsts, ["q1", "q2"], "left").selectExpr(
        "p1", "p2", "first", "depth", "coalesce(upper_first, parent_first) AS parent_conv_id", "n", "kids", "leaves", "saved")
    upper = merged.drop("leaves", "saved").join(sums, ["p1", "p2"]).join(firsts, ["q1", "q2"], "left").selectExpr(
        "p1", "p2", "first", "depth", "coalesce(upper_first, parent_first) AS parent_conv_id", "n", "kids", "leaves", "saved")

    final = convs.join(own.groupBy("conv_id").agg(F.expr("bit_xor(g1) AS p1"), F.expr("bit_xor(g2) AS p2")), "conv_id", "left").selectExpr(
        "coalesce(p1, 0L) AS p1", "coalesce(p2, 0L) AS p2", "conv_id")
    chunks = importable(final.repartitionByRange("p1", "p2", "conv_id").sortWithinPartitions("p1", "p2", "conv_id")).mapInArrow(
        _chunks, "p1 long, p2 long, first long, ids string")
    ends = chunks.repartition("p1", "p2").sortWithinPartitions("p1", "p2", "first").mapInArrow(_hashed, "p1 long, p2 long, ends_sha256 string")
    return below.union(upper).join(ends, ["p1", "p2"], "left").selectExpr(
        "first AS conv_id", "depth", "parent_conv_id", "n AS n_convs", "kids AS n_children", "leaves AS n_leaves", "saved AS saved_tokens",
        f"coalesce(ends_sha256, '{hashlib.sha256().hexdigest()}') AS ends_sha256",
        "concat(lpad(hex(p1), 16, '0'), lpad(hex(p2), 16, '0')) AS node")
