"""Line dedup by overlapping windows of three lines.

Every run of three consecutive lines of a document is hashed; a document of fewer lines is one window. The
first place of each hash, by (doc_id, line number), is kept over the whole corpus, later ones are covered. Covered
windows overlap; a line goes if any covered window holds it. Single frequent lines ("Share this page") stay,
passages of three lines and more that recur go. One line of more than ``LONG_WORDS`` words, or two lines in a row that
together have more, count as a passage of their own, so that a repeated paragraph is found in whatever surroundings.

Only hashes are shuffled, two of 64 bits a window, so that unlike windows practically never agree, summed up per hash before the shuffle. A hot window is one row for
each task; the join that finds its later places is a sort-merge join that AQE splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelist.llm.common import SPACE, fresh, staged

WINDOW = 3
LONG_WORDS = 50


def windows(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id``, ``text_hash``, ``at`` (first line), ``n_lines``, ``hash`` and ``hash2`` of every window.

    Lines are split at ``\\n`` and compared without white space at their ends; blank lines are skipped.
    """
    lines = (
        "filter(transform(split({t}, '\\n'), (l, i) -> struct(i AS at, btrim(l, ' \\t\\r\\u000b\\f') AS l)), x -> x.l <> '')"
    ).format(t=f"`{text}`")
    df = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.expr(lines).alias("_lines"))
    words = SPACE.replace("\\", "\\\\") + "+"
    df = df.select("doc_id", "text_hash", F.expr(
        f"transform(_lines, x -> struct(x.at, xxhash64(x.l) AS h, xxhash64('second', x.l) AS g, size(split(x.l, '{words}')) AS n))").alias("_l"))

    def window(at: str, size: int, until: str) -> str:
        part = f"slice(a, {at} + 1, {size})"
        return (f"struct(a[{at}].at AS at, a[{until}].at - a[{at}].at + 1 AS n_lines, xxhash64(transform({part}, x -> x.h)) AS hash, "
                f"xxhash64(transform({part}, x -> x.g)) AS hash2)")

    places = "sequence(0, size(a) - 1)"
    runs = f"transform(sequence(0, greatest(0, size(a) - {WINDOW})), i -> {window('i', WINDOW, f'least(i + {WINDOW - 1}, size(a) - 1)')})"
    singles = f"transform(filter({places}, i -> size(a) > 1 AND a[i].n > {LONG_WORDS}), i -> {window('i', 1, 'i')})"
    pairs = (f"transform(filter({places}, i -> size(a) > 2 AND i < size(a) - 1 AND a[i].n + get(a, i + 1).n > {LONG_WORDS}), "
             f"i -> {window('i', 2, 'i + 1')})")
    return (
        df.filter("size(_l) > 0")
        .select("doc_id", "text_hash", F.explode(F.expr(f"transform(array(_l), a -> concat({runs}, {singles}, {pairs}))[0]")).alias("w"))
        .select("doc_id", "text_hash", "w.*")
    )


def repeated_lines(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id``, ``text_hash``, ``lines``: sorted numbers (from 0) of the lines to remove."""
    found = staged(windows(docs, text, doc_id), "line-windows")
    # written, so that both sides of the join are plain scans and AQE can split a hot hash
    first = staged(
        found.groupBy("hash", "hash2").agg(F.min(F.struct("doc_id", "text_hash", "at")).alias("first"), F.count("*").alias("n"))
        .filter("n > 1").select("hash", "hash2", "first"), "line-firsts")
    later = found.join(first, ["hash", "hash2"]).filter(~F.struct("doc_id", "text_hash", "at").eqNullSafe(F.col("first")))
    return later.groupBy("doc_id", "text_hash").agg(
        F.expr("sort_array(array_distinct(flatten(collect_set(sequence(at, at + n_lines - 1)))))").alias("lines"))


def drop_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", removed: str = "removed") -> DataFrame:
    """``docs`` with the repeated lines cut out of the texts and their numbers in ``removed``.

    Documents keep their rows: one whose lines all go has an empty text. NULL texts stay NULL, empty ones
    empty. Rows with equal id and text are one document that occurs twice: the one that is kept has the smallest id
    (NULL ids first), then text hash; rows equal in both are not told apart and stay as they are.
    An empty table gives an empty result; other columns pass through, whatever their names.
    """
    removed, key, gone = fresh(docs, removed), fresh(docs, "_text_hash"), fresh(docs, "_cut")
    cut_id, cut_hash = fresh(docs, "_cut_id"), fresh(docs, "_cut_hash")
    cut = repeated_lines(docs, text, doc_id).withColumnsRenamed({"doc_id": cut_id, "text_hash": cut_hash, "lines": gone})
    keyed = docs.withColumn(key, F.xxhash64(text))
    joined = keyed.join(cut, keyed[doc_id].eqNullSafe(cut[cut_id]) & (keyed[key] == cut[cut_hash]), "left")
    left = F.expr(
        f"if({gone} IS NULL, `{text}`, array_join(flatten(transform(array(array_except(sequence(0, size(split(`{text}`, '\\n')) - 1), {gone})), "
        f"k -> transform(array(split(`{text}`, '\\n')), l -> transform(k, i -> l[i])))[0]), '\\n'))"
    )
    return joined.select(
        *(left.alias(text) if c == text else F.col(f"`{c}`") for c in docs.columns),
        F.coalesce(gone, F.array().cast("array<int>")).alias(removed),
    )
