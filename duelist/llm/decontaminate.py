"""Benchmark decontamination by spaced seeds.

A mask picks some word positions of a window and ignores the others, so two passages that differ in an
ignored word still share the hash of that mask. All mask hashes of the training texts are joined with those
of the benchmark. Around every hit the two texts are compared word by word along the diagonal of the hit
(equal distance between the two positions): the best-scoring stretch, +1 for an equal and ``-MISMATCH`` for
another word, is the overlap. It counts as a leak from ``MIN_MATCHES`` equal words on, or from
``SHORT_SHARE`` of an item's words if that is less.

DataFrame and SQL functions only. Texts are read twice, first for seeds, then only for documents with hits;
just hits are shuffled. The seeds of the benchmark are broadcast while they are fewer than
``BROADCAST_SEEDS`` (a counted size, about 40 bytes each); beyond that the same join runs shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duelist.llm.common import fresh, plain_words, staged, word_hashes

# Positions that each mask looks at. Six of eight to twelve words; no two masks
# ignore the same places, so one or two changed words in a window leave some mask untouched.
# The first three look at all residues modulo 5 and miss passages with every fifth word changed; the last leaves
# out residue 4. Together they meet every stretch that is accepted of an item of up to 15 words, whatever
# words are changed, and of longer ones with every 4th to 12th word changed.
MASKS = [
    (0, 1, 2, 4, 7, 8),
    (0, 1, 3, 4, 7, 9),
    (0, 2, 3, 5, 9, 11),
    (0, 2, 3, 5, 6, 7),
]
MIN_MATCHES = 13
SHORT_SHARE = 0.8
MISMATCH = 2
MIN_ITEM_WORDS = 9
BROADCAST_SEEDS = 1_000_000


def _seeds(hashes: str) -> Column:
    """Mask hashes of an array of word hashes, window by window; NULL where a mask runs over the end."""
    each = ", ".join(
        f"if(i + {mask[-1]} < size(a), xxhash64({k}, {', '.join(f'get(a, i + {p})' for p in mask)}), NULL)"
        for k, mask in enumerate(MASKS)
    )
    last = min(mask[-1] for mask in MASKS)
    return F.expr(
        f"if(size({hashes}) <= {last}, cast(array() AS array<bigint>), flatten(transform(array({hashes}), a -> "
        f"transform(sequence(0, size(a) - {last + 1}), i -> array({each})))[0]))"
    )


def _exploded(df: DataFrame, hashes: str, *keep: str) -> DataFrame:
    return (
        df.select(*keep, F.posexplode(_seeds(hashes)).alias("_slot", "seed"))
        .filter("seed IS NOT NULL")
        .selectExpr(*keep, f"_slot div {len(MASKS)} AS pos", "seed")
    )


def items_of(benchmark: DataFrame, text: str = "text", item_id: str = "item_id") -> DataFrame:
    """One row per different benchmark text: ``item_ids`` that have it and its word hashes ``b``."""
    return (
        benchmark.select(F.col(item_id).alias("_id"), word_hashes(plain_words(F.col(text))).alias("b"))
        .filter(F.size("b") >= MIN_ITEM_WORDS)
        .groupBy("b").agg(F.sort_array(F.collect_set("_id")).alias("item_ids"))
        .select(F.expr("xxhash64(b)").alias("item"), "item_ids", "b")
    )


def overlaps(docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Verified overlaps: ``doc_id``, ``text_hash``, ``item_ids``, ``doc_from`` and ``item_from`` (first equal word,
    from 0), ``n_words`` (length of the stretch), ``n_matches``.

    Words are lower-case runs of letters and digits. Items of fewer than ``MIN_ITEM_WORDS`` words are too
    short to tell and are left out; so are NULL texts on either side. Equal benchmark texts are one item with
    several ids; equal rows of documents give one row. A NULL doc_id is a value like others.
    """
    items = staged(items_of(benchmark), "benchmark-items")
    own = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("_text"))
    hashed = own.select("doc_id", "text_hash", word_hashes(plain_words(F.col("_text"))).alias("a"))
    theirs = _exploded(items, "b", "item").select("item", F.col("pos").alias("item_pos"), "seed")
    if theirs.count() <= BROADCAST_SEEDS:
        theirs = F.broadcast(theirs)
    hits = (
        _exploded(hashed, "a", "doc_id", "text_hash").join(theirs, "seed")
        .select("doc_id", "text_hash", "item", (F.col("pos") - F.col("item_pos")).alias("shift")).distinct()
    )
    # one row per document with hits, so that its text is joined once
    hits = staged(hits.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("item", "shift")).alias("hits")), "seed-hits")
    texts = (
        own.join(hits, own.doc_id.eqNullSafe(hits.doc_id) & (own.text_hash == hits.text_hash), "left_semi")
        .select("doc_id", "text_hash", word_hashes(plain_words(F.col("_text"))).alias("a"))
        .dropDuplicates(["doc_id", "text_hash"])
    )
    pairs = (
        texts.join(hits.withColumnsRenamed({"doc_id": "_d", "text_hash": "_t"}),
                   F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_hash") == F.col("_t")))
        .select("doc_id", "text_hash", "a", F.explode("hits").alias("hit"))
        .selectExpr("doc_id", "text_hash", "hit.item", "hit.shift", "greatest(hit.shift, 0) AS doc_at", "a")
    )
    faced = pairs.join(items, "item").selectExpr(
        "doc_id", "text_hash", "item_ids", "shift", "doc_at", "size(b) AS item_words",
        "zip_with(slice(a, doc_at + 1, cast(greatest(0, shift + size(b) - doc_at) AS int)), "
        "slice(b, cast(doc_at - shift + 1 AS int), size(b)), (x, y) -> coalesce(x = y, false)) AS same",
    )
    # best-scoring stretch in one walk; a fresh stretch starts where the running score is not positive
    walk = (
        f"aggregate(same, named_struct('i', 0, 'score', 0, 'from', 0, 'hit', 0, 'best', 0, 'bfrom', 0, 'bto', 0, 'bhit', 0), "
        f"(s, m) -> transform(array(named_struct('score', if(s.score > 0, s.score, 0) + if(m, 1, -{MISMATCH}), "
        f"'from', if(s.score > 0, s.from, s.i), 'hit', if(s.score > 0, s.hit, 0) + if(m, 1, 0))), n -> named_struct("
        f"'i', s.i + 1, 'score', n.score, 'from', n.from, 'hit', n.hit, "
        f"'best', greatest(s.best, n.score), 'bfrom', if(n.score > s.best, n.from, s.bfrom), "
        f"'bto', if(n.score > s.best, s.i + 1, s.bto), 'bhit', if(n.score > s.best, n.hit, s.bhit)))[0])"
    )
    return (
        faced.withColumn("w", F.expr(walk))
        .filter(f"w.bhit >= least({MIN_MATCHES}, ceil({SHORT_SHARE} * item_words))")
        .selectExpr("doc_id", "text_hash", "item_ids", "doc_at + w.bfrom AS doc_from", "doc_at - shift + w.bfrom AS item_from",
                    "w.bto - w.bfrom AS n_words", "w.bhit AS n_matches")
    )


def leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document that holds benchmark text: ``doc_id``, ``text_hash``, ``item_ids`` (sorted),
    ``n_overlaps``, ``max_matches``."""
    return overlaps(docs, benchmark, text, doc_id).groupBy("doc_id", "text_hash").agg(
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("item_ids")))).alias("item_ids"),
        F.count("*").alias("n_overlaps"), F.max("n_matches").alias("max_matches"),
    )


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Documents without a leak, columns as they were. Documents without words stay."""
    key = fresh(docs, "text_hash")
    found = leaks(docs, benchmark, text, doc_id).select(F.col("doc_id").alias("_leak"), F.col("text_hash").alias("_leak_text"))
    keyed = docs.withColumn(key, F.xxhash64(text))
    return keyed.join(found, keyed[doc_id].eqNullSafe(found["_leak"]) & (keyed[key] == found["_leak_text"]), "left_anti").drop(key)
