"""Chat formatting by quotation linking.

Messages are split into own text and quoted passages with their nesting level (``>`` marks, an attribution line like
"... wrote:" before them). Passages, and the paragraphs, lines and sentences in them, are hashed in normalised form and
joined to the message that first said the same: in the same conversation, else anywhere before. Under ``MIN_WORDS`` words
many people say the same by chance, so such short quotations link within their conversation only. The message whose words are
quoted most at the outermost linked level is the one replied to. Following these links to their end gives the
conversation a message belongs to and its depth; quotes are cut out of the texts.

Originals are reduced to the first message per hash before the join, so a greeting that half of all messages share
is one row, and every quoted passage meets at most two. Links are followed by pointer doubling over written
tables; only messages with a link take part.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelist.llm.common import importable, staged

MIN_WORDS = 3

_MARKS = re.compile(r"[ \t]*((?:>[ \t]*)+)")
_WORD = re.compile(r"[^\W_]+")
_SENTENCE_END = re.compile(r"(?<=[.!?…])\s+")
# How mail programs introduce a quotation, in four languages.
_ATTRIBUTION = re.compile(r"(?:wrote|schrieb[^:\n]*|a écrit|escribió)\s*:\s*$", re.IGNORECASE)


def parse(text: str | None) -> tuple[str, list[tuple[int, str]]]:
    """Own text, and quoted passages with their level (1 is outermost), in order."""
    own: list[str] = []
    quoted: list[tuple[int, list[str]]] = []
    inside = False
    for line in (text or "").split("\n"):
        marks = _MARKS.match(line)
        level = marks[1].count(">") if marks else 0
        if not level:
            own.append(line)
            inside = False
            continue
        if not inside and own and _ATTRIBUTION.search(own[-1]):
            own.pop()
        if inside and quoted[-1][0] == level:
            quoted[-1][1].append(line[marks.end() :])
        else:
            quoted.append((level, [line[marks.end() :]]))
        inside = True
    return ("\n".join(own).strip("\n") if quoted else text or ""), [(n, "\n".join(p)) for n, p in quoted]


def _units(passage: str) -> dict[int, int]:
    """Hash and number of words of a passage and of each of its paragraphs, lines and sentences, in normalised form."""
    out = {}
    for part in [passage, *re.split(r"\n\s*\n", passage), *passage.split("\n"), *_SENTENCE_END.split(passage)]:
        words = [w.lower() for w in _WORD.findall(part)]
        if words:
            out[xxhash.xxh64_intdigest(" ".join(words)) - (1 << 63)] = len(words)
    return out


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    quote = pa.list_(pa.struct([("hash", pa.int64()), ("level", pa.int32()), ("words", pa.int32())]))
    for batch in batches:
        texts, said, quoted, n = [], [], [], []
        for text in batch.column("text").to_pylist():
            own, passages = parse(text)
            texts.append(None if text is None else own)
            said.append(list(_units(own)))
            quoted.append([{"hash": h, "level": level, "words": w} for level, p in passages for h, w in _units(p).items()])
            n.append(len(passages))
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("key", "conv_id", "turn", "role")), pa.array(texts, pa.string()),
             pa.array(said, pa.list_(pa.int64())), pa.array(quoted, quote), pa.array(n, pa.int32())],
            names=["key", "conv_id", "turn", "role", "text", "said", "quoted", "n_quotes"])


def link(messages: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``role``, ``text`` (without quotes), ``n_quotes`` (passages), ``reply_conv`` and ``reply_turn`` (NULL
    without a linked quotation), ``thread_id`` (conversation of the message at the end of the links), ``depth``.

    Ordered by thread_id, depth, conv_id, turn, every message follows the one it answers. A quotation nobody
    said before has no link. NULL texts stay NULL; messages with a NULL conversation or turn are never linked;
    equal rows all stay and are linked alike; other columns are ignored; an empty table gives an empty result.
    """
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit("-")), F.coalesce(F.col("turn").cast("string"), F.lit("-")),
                      F.xxhash64("text"))
    rows = importable(messages).select(key.alias("key"), F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                       F.col("role").cast("string").alias("role"), "text")
    parsed = staged(rows.mapInArrow(
        _parsed, "key string, conv_id long, turn long, role string, text string, said array<long>, "
        "quoted array<struct<hash: long, level: int, words: int>>, n_quotes int"), "messages")
    placed = parsed.filter("conv_id IS NOT NULL AND turn IS NOT NULL")
    quoted = staged(placed.filter("size(quoted) > 0").dropDuplicates(["key"]).select("key", "conv_id", "turn", F.explode("quoted").alias("q"))
                    .select("key", "conv_id", "turn", "q.*"), "quotations")
    said = placed.select("conv_id", "turn", "key", F.explode("said").alias("hash"))
    # written, so that AQE can split the messages that share one sentence
    said = said.join(staged(quoted.select("hash").distinct(), "quoted-hashes"), "hash", "left_semi")
    place = F.struct("conv_id", "turn", "key").alias("at")
    here = staged(said.groupBy("hash", "conv_id").agg(F.min(place).alias("here")), "originals")
    anywhere = staged(here.groupBy("hash").agg(F.min("here").alias("anywhere")), "originals")
    own = F.struct("conv_id", "turn", "key")
    met = (
        quoted.join(here, ["hash", "conv_id"], "left").join(anywhere, "hash", "left")
        .withColumn("to", F.when(F.col("here") < own, F.col("here")).when(
            (F.col("anywhere") < own) & (F.col("words") >= MIN_WORDS), F.col("anywhere")))
        .filter("to IS NOT NULL")
        .groupBy("key", "level", "to").agg(F.sum("words").alias("words"))
        # the outermost level first, then most words, then the earliest message
        .groupBy("key").agg(F.max_by("to", F.struct(-F.col("level"), "words", -F.col("to.conv_id"), -F.col("to.turn"))).alias("to"))
    )
    links = staged(met.selectExpr("key", "to.key AS up", "to.conv_id AS reply_conv", "to.turn AS reply_turn"), "links")
    ends = staged(links.selectExpr("key", "up", "reply_conv AS thread_id", "1 AS depth"), "links")
    while True:
        above = ends.selectExpr("key AS up", "up AS up2", "thread_id AS thread2", "depth AS depth2")
        stepped = staged(ends.join(above, "up", "left").selectExpr(
            "key", "coalesce(up2, up) AS up", "coalesce(thread2, thread_id) AS thread_id", "depth + coalesce(depth2, 0) AS depth",
            "up2 IS NOT NULL AS moved"), "links")
        ends = stepped.drop("moved")
        if stepped.filter("moved").isEmpty():
            break
    described = staged(links.drop("up").join(ends.drop("up"), "key"), "links")
    return parsed.join(described, "key", "left").selectExpr(
        "conv_id", "turn", "role", "text", "n_quotes", "reply_conv", "reply_turn", "coalesce(thread_id, conv_id) AS thread_id", "coalesce(depth, 0) AS depth")
