from __future__ import annotations

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from duelist.llm import quality_em

NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    at = {}
    for i in range(len(words) - 7):
        at.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {i + k for places in at.values() if len(places) > 1 for i in places for k in range(8)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def counted(spark, texts):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    return {r["doc_id"]: tuple(r[n] for n in NAMES) for r in quality_em.counts(df).collect()}


def test_counts_equal_brute_force(spark, sf_dir):
    texts = [r[0] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    texts += [None, "", " \n\t", "a b c d e f g h " * 3, "x " * 9, "\n\n a \n a \n", "é   日本", "w" * 50_000, "a b " * 5_000]
    assert counted(spark, texts) == {k: brute(t) for k, t in enumerate(texts)}


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="ab \n\t#|\x0b\x85é", max_size=60), min_size=20, max_size=40))
def test_counts_equal_brute_force_on_odd_texts(spark, texts):
    assert counted(spark, texts) == {k: brute(t) for k, t in enumerate(texts)}


def test_verdicts_agree_with_held_labels(spark, sf_dir):
    scored = quality_em.score(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    judged = scored.filter("NOT quality.base_failed").select("doc_id", F.col("quality.kept").alias("kept"))
    known = spark.read.parquet(f"{sf_dir}/labels.parquet").withColumnRenamed("quality", "label")
    rows = judged.join(known, "doc_id").select("kept", "label").collect()
    assert len(rows) > 20
    assert sum(r["kept"] == (r["label"] == 1) for r in rows) / len(rows) > 0.97


def test_edge_cases(spark):
    rows = [(1, None, "a"), (2, "", "b"), (3, "the cat sat on the mat and it was a nice day for all of us in the big old house here", "c")]
    df = spark.createDataFrame(rows + rows[2:], "doc_id long, text string, quality string")
    out = quality_em.score(df)
    assert out.columns == ["doc_id", "text", "quality", "_quality"]  # a clashing name stays
    got = {(r["doc_id"], r["_quality"]["kept"]) for r in out.collect()}
    assert got == {(1, False), (2, False), (3, True)}
    assert quality_em.score(df.limit(0)).count() == 0
    assert quality_em.keep_good(df).columns == df.columns


def test_model_moves_with_the_votes(spark):
    n = len(quality_em.RULES)
    patterns = spark.createDataFrame([("+" * n, 900), ("--" + "+" * (n - 2), 100)], "votes string, n long")
    model = quality_em.fit(patterns)
    assert 0.85 < model["prior"] < 0.95 and model["0-bad"] > 0.9 and model["0-good"] < 0.01
    p = {r["votes"]: r["p"] for r in patterns.select("votes", quality_em.posterior(model).alias("p")).collect()}
    assert p["+" * n] > 0.99 and p["--" + "+" * (n - 2)] < 0.01
