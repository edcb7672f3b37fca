"""Quality by weak supervision: rules vote or abstain, EM weighs them, a posterior decides.

Every rule looks at counts of one document and says *good*, *bad* or nothing. A document is good or
bad (hidden); each rule has its own probabilities of the three votes for either class. Expectation
maximisation estimates them and the share of good documents from how the rules agree over the whole
corpus, without labels. It works on vote patterns and their counts (at most 3^rules rows, few in
practice), so one iteration costs the same at any corpus size. The posterior probability of *good*
replaces a filter that all rules must pass.

DataFrame and SQL functions only; the texts are read once and nothing but counts is shuffled.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duelist.llm.common import fresh, staged, window_hashes, word_hashes, words

REPEAT_WORDS = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
ITERATIONS, TOLERANCE = 30, 1e-5

# Very frequent words of English, German, French and Spanish.
STOP_WORDS = [
    "the", "of", "and", "to", "in", "a", "is", "that", "der", "die", "das", "und", "von", "den", "mit",
    "le", "la", "les", "de", "des", "et", "en", "un", "une", "el", "los", "que", "y", "las", "por",
]

# Name, condition of a bad vote, condition of a good vote; SQL over the counts of ``counts()``.
RULES = [
    ("length", "n_words < 5", "n_words >= 20"),
    ("symbols", "n_symbols > 0.1 * n_words", "n_symbols <= 0.02 * n_words"),
    ("letters", "n_letters < 0.85 * word_chars", "n_letters > 0.92 * word_chars"),
    ("shouting", "n_upper > 0.4 * n_letters", "n_upper < 0.15 * n_letters"),
    ("exclamations", "n_exclaims > 0.1 * n_words", "n_exclaims <= 0.02 * n_words"),
    ("echoes", "n_echoes > 0.1 * n_words", "n_echoes <= 0.02 * n_words"),
    ("repeats", "n_repeat_words > 0.3 * n_words", "n_repeat_words <= 0.1 * n_words"),
    ("variety", "n_distinct < 0.2 * n_words", "n_distinct > 0.35 * n_words"),
    ("lines", "n_dup_lines > 0.5 * n_lines", "n_dup_lines <= 0.2 * n_lines"),
    ("stop_words", "n_stop = 0 AND n_words >= 50", "n_stop >= 3"),
]


def repeat_words(windows: str) -> Column:
    """Words covered by windows (hashes, in text order) that occur at least twice in the array.

    The hashes are sorted with their positions, so equal ones become neighbours: n log n, whatever
    repeats. Nothing is sorted unless some window repeats.
    """
    seen = f"sort_array(transform({windows}, (h, i) -> struct(h AS h, i AS i)))"
    # a let-binding: SQL lambdas name the sorted array once
    positions = (
        f"flatten(transform(array({seen}), s -> sort_array(transform(filter(s, (x, k) -> "
        f"(k > 0 AND get(s, k - 1).h = x.h) OR (k < size(s) - 1 AND get(s, k + 1).h = x.h)), x -> x.i))))"
    )
    covered = (
        f"aggregate({positions}, named_struct('n', 0L, 'next', 0), (a, p) -> named_struct("
        f"'n', a.n + {REPEAT_WORDS} - greatest(0, a.next - p), 'next', p + {REPEAT_WORDS}), a -> a.n)"
    )
    return F.expr(f"if(size(array_distinct({windows})) = size({windows}), 0L, {covered})")


def counts(docs: DataFrame, text: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` with one column per count; NULL texts count as empty."""
    t = F.coalesce(F.col(text), F.lit(""))
    size = lambda c: F.size(c).cast("long")
    kept = [F.col(f"`{c}`") for c in docs.columns]
    df = docs.select(*kept, words(F.col(text)).alias("_w"))
    names = kept + [F.col("_w")]
    df = df.select(*names, word_hashes(F.col("_w")).alias("_h"))
    df = df.select(*names, F.col("_h"), window_hashes("_h", REPEAT_WORDS).alias("_g"),
                   F.filter(F.split(t, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"),
                   F.regexp_replace(t, r"[^\p{Lu}]++", "").alias("_upper"),
                   (F.length(t) - F.length(F.regexp_replace(t, r"[^\x20\x09-\x0D]++", ""))).cast("long").alias("_chars"),
                   F.length(F.regexp_replace(t, r"[\p{L}\p{N}\x20\x09-\x0D]++", "")).cast("long").alias("_marks"))
    return df.select(
        *kept,
        size("_w").alias(prefix + "n_words"),
        F.col("_chars").alias(prefix + "word_chars"),
        F.length(F.regexp_replace(t, r"[^#*$%&|<>]++", "")).cast("long").alias(prefix + "n_symbols"),
        (size("_lines") - size(F.array_distinct("_lines"))).alias(prefix + "n_dup_lines"),
        repeat_words("_g").alias(prefix + "n_repeat_words"),
        size("_lines").alias(prefix + "n_lines"),
        (F.col("_chars") - F.col("_marks")).alias(prefix + "n_letters"),
        F.length("_upper").cast("long").alias(prefix + "n_upper"),
        F.length(F.regexp_replace(t, "[^!]++", "")).cast("long").alias(prefix + "n_exclaims"),
        F.expr("cast(size(transform(array(_h), a -> filter(a, (x, i) -> x = get(a, i - 1)))[0]) AS bigint)").alias(prefix + "n_echoes"),
        size(F.array_distinct("_h")).alias(prefix + "n_distinct"),
        size(F.array_intersect("_h", F.array(*(F.xxhash64(F.lit(w)) for w in STOP_WORDS)))).alias(prefix + "n_stop"),
    )


def votes() -> Column:
    """One character per rule: ``-`` bad, ``+`` good, ``0`` abstains."""
    return F.concat(*(F.expr(f"CASE WHEN {bad} THEN '-' WHEN {good} THEN '+' ELSE '0' END") for _, bad, good in RULES))


def base_failed() -> Column:
    return F.expr(f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words")


def posterior(model: dict[str, float], votes_column: str = "votes") -> Column:
    """Probability of *good* from log odds; ``model`` has ``prior`` and, per rule, vote and class, a probability."""
    log_odds = F.lit(log(model["prior"]) - log(1 - model["prior"]))
    for r in range(len(RULES)):
        vote = F.substring(votes_column, r + 1, 1)
        by_vote = {v: log(model[f"{r}{v}good"]) - log(model[f"{r}{v}bad"]) for v in "-0+"}
        log_odds = log_odds + F.when(vote == "-", by_vote["-"]).when(vote == "+", by_vote["+"]).otherwise(by_vote["0"])
    return 1 / (1 + F.exp(-log_odds))


def initial_model() -> dict[str, float]:
    """Before anything is seen: good documents rarely get bad votes, bad ones get some."""
    model = {"prior": 0.9}
    for r in range(len(RULES)):
        model |= {f"{r}-good": 0.01, f"{r}0good": 0.09, f"{r}+good": 0.90}
        model |= {f"{r}-bad": 0.30, f"{r}0bad": 0.10, f"{r}+bad": 0.60}
    return model


def fit(patterns: DataFrame, iterations: int = ITERATIONS, tolerance: float = TOLERANCE) -> dict[str, float]:
    """EM over ``(votes, n)``, until no parameter moves by more than ``tolerance``, or ``iterations`` times. Only the row of
    new parameters reaches the driver. Add-one smoothing; with no rows the initial model is returned. Every iteration reads
    ``patterns`` again, so give a written table, at most one row per pattern of votes."""
    model = initial_model()
    for _ in range(iterations):
        weighed = patterns.select("votes", "n", posterior(model).alias("p"))
        sums = [F.sum("n").alias("all"), F.sum(F.expr("n * p")).alias("good")]
        for r in range(len(RULES)):
            for v in "-0+":
                mine = F.substring("votes", r + 1, 1) == v
                sums += [F.sum(F.when(mine, F.expr("n * p")).otherwise(0.0)).alias(f"{r}{v}good"),
                         F.sum(F.when(mine, F.expr("n * (1 - p)")).otherwise(0.0)).alias(f"{r}{v}bad")]
        row = weighed.agg(*sums).first()
        if not row["all"]:
            return model
        total, before = {"good": row["good"], "bad": row["all"] - row["good"]}, model
        model = {"prior": (total["good"] + 1) / (row["all"] + 2)}
        for r in range(len(RULES)):
            for v in "-0+":
                for y in total:
                    model[f"{r}{v}{y}"] = (row[f"{r}{v}{y}"] + 1) / (total[y] + 3)
        if max(abs(model[k] - before[k]) for k in model) <= tolerance:
            break
    return model


def score(docs: DataFrame, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """``docs`` with ``quality``: a struct of the counts, ``votes``, ``p_good``, ``base_failed`` and ``kept``.

    Defined results: NULL and empty texts have no words and fail the base test. Repeated rows are scored
    alike and count as often as they occur. Other columns, whatever their names, pass through. An empty table
    gives an empty result.
    """
    out = fresh(docs, "quality")
    counted = counts(docs.select(F.col(f"`{text}`").alias("_text"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row")),
                     "_text").drop("_text")
    # the texts are counted once; both the fit and the verdicts read this table
    rows = staged(counted.withColumn("votes", votes()).withColumn("base_failed", base_failed()), "quality")
    model = fit(staged(rows.groupBy("votes").agg(F.count("*").alias("n")), "quality-votes"))
    judged = rows.withColumn("p_good", posterior(model))
    judged = judged.withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= threshold))
    return judged.select("_row.*", F.struct(*(c for c in judged.columns if c != "_row")).alias(out))


def keep_good(docs: DataFrame, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The documents that pass, columns as they were."""
    out = fresh(docs, "quality")
    return score(docs, text, threshold).filter(F.col(f"{out}.kept")).drop(out)
