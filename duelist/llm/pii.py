"""Personal data: regular expressions propose, checksums confirm, context words adjust the score.

Every kind has a pattern, a test and a base score. A proposal that fails its test (a Luhn sum, a mod-97
sum, number ranges, digit counts) is dropped and not tried again at another start. Context words right
before a span raise its score. The four base kinds are reported whatever their score; added kinds need
``MIN_SCORE``, so a bare number that only looks like an identifier stays out.

DataFrame and SQL functions only, no shuffle: one pass over the texts. A pattern puts a mark around its
matches, the text is split at the marks, and lengths of the pieces give the positions. Patterns have no
loops that can backtrack (possessive quantifiers, no start inside a run), so long texts cost linear time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duelist.llm.common import fresh

MIN_SCORE = 0.6
CONTEXT_CHARS = 40
CONTEXT_BONUS = 0.3
BLOCK = 256

_MARK = "\u0001"
_LIKE_MARK = "\u0003"

_DIGITS = "regexp_replace(m, '[^0-9]', '')"
_MOD97 = (
    "aggregate(split(concat(substr(replace(m, ' ', ''), 5), substr(replace(m, ' ', ''), 1, 4)), ''), 0, (a, c) -> "
    "CASE WHEN c = '' THEN a WHEN c BETWEEN '0' AND '9' THEN (a * 10 + ascii(c) - 48) % 97 "
    "ELSE (a * 100 + ascii(c) - 55) % 97 END) = 1"
)

# Kind, what a text must contain, pattern, test of a match ``m``, base score, context words, always reported.
KINDS = [
    ("email", "contains(t, '@')",
     r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
     "true", 0.9, "mail|contact|write|kontakt|correo|courriel", True),
    ("ip", "contains(t, '.')",
     r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
     "forall(split(m, '[.]'), p -> length(ltrim('0', p)) <= 3 AND coalesce(try_cast(ltrim('0', p) AS int), 0) <= 255)",
     0.6, "ip|host|server|address|login", True),
    ("card", "true",
     r"[0-9](?:[\x20-]?[0-9])++",
     f"length({_DIGITS}) BETWEEN 16 AND 19 AND luhn_check({_DIGITS})",
     0.8, "card|visa|credit|karte|carte|tarjeta|pay", True),
    ("phone", "contains(t, '+')",
     r"\+[0-9][\x20().0-9-]+[0-9]",
     f"length({_DIGITS}) BETWEEN 8 AND 15",
     0.7, "phone|tel|call|mobile|fax|anruf", True),
    ("iban", "true",
     r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
     _MOD97, 0.9, "iban|account|bank|konto|compte|cuenta", False),
    ("national_id", "contains(t, '-')",
     r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
     "substr(m, 1, 3) NOT IN ('000', '666') AND substr(m, 1, 1) <> '9' AND substr(m, 5, 2) <> '00' AND substr(m, 8) <> '0000'",
     0.4, "ssn|social|security|tax|insurance", False),
    ("local_phone", "contains(t, '-')",
     r"(?<![0-9+()-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20-])[0-9]{3}-[0-9]{4}(?![0-9-])",
     "true", 0.4, "phone|tel|call|mobile|fax|anruf", False),
]
BASE_KINDS = [k[0] for k in KINDS if k[-1]]


def _pieces(pattern: str, gate: str) -> Column:
    """Text between and in matches, in turns; NULL if the text cannot have any."""
    marked = F.regexp_replace("t", pattern, f"{_MARK}$0{_MARK}")
    return F.when(F.expr(gate), F.split(marked, _MARK))


def _ends(pieces: str) -> Column:
    """End of every piece in code points. Blocks keep the appended arrays short: n * BLOCK steps at most."""
    block = (
        f"aggregate(slice(n, c * {BLOCK} + 1, {BLOCK}), named_struct('at', a.at, 'ends', cast(array() AS array<int>)), "
        "(b, len) -> named_struct('at', b.at + len, 'ends', array_append(b.ends, b.at + len)))"
    )
    return F.expr(
        f"if(size({pieces}) > 1, transform(array(transform({pieces}, p -> length(p))), n -> "
        f"aggregate(sequence(0, (size(n) - 1) div {BLOCK}), named_struct('at', 0, 'blocks', cast(array() AS array<array<int>>)), "
        f"(a, c) -> transform(array({block}), b -> named_struct('at', b.at, 'blocks', array_append(a.blocks, b.ends)))[0], "
        "a -> flatten(a.blocks)))[0], cast(array() AS array<int>))"
    )


def _spans(kind: str, pieces: str, ends: str, test: str, base: float, context: str, always: bool) -> Column:
    near = rf"lower(right({pieces}[i - 1], {CONTEXT_CHARS})) RLIKE '(?<![a-z])(?:{context})'"
    score = f"least(1.0D, {base}D + if({near}, {CONTEXT_BONUS}D, 0D))"
    found = (
        f"transform(filter(sequence(1, size({pieces}) - 2, 2), i -> transform(array({pieces}[i]), m -> {test})[0]), i -> named_struct("
        f"'kind', '{kind}', 'start', {ends}[i - 1], 'end', {ends}[i], 'value', {pieces}[i], 'score', {score}))"
    )
    if not always:
        found = f"filter({found}, s -> s.score >= {MIN_SCORE}D)"
    return F.expr(f"if(size({ends}) > 2, {found}, "
                  "cast(array() AS array<struct<kind: string, start: int, end: int, value: string, score: double>>))")


def find(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``pii``: an array of (kind, start, end, value, score), by kind as in ``KINDS``, then start.

    Positions are code points of the whole text, the end exclusive. NULL and empty texts have no spans; equal
    rows get equal spans; other columns pass through; an empty table gives an empty result.
    """
    out = fresh(docs, "pii")
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row")
    safe = F.replace(F.coalesce(F.col(f"`{text}`"), F.lit("")), F.lit(_MARK), F.lit(_LIKE_MARK)).alias("t")
    df = docs.select(row, safe)
    df = df.select("_row", *(_pieces(k[2], k[1]).alias(f"p_{k[0]}") for k in KINDS))
    df = df.select("*", *(_ends(f"p_{k[0]}").alias(f"e_{k[0]}") for k in KINDS))
    df = df.select("_row", *(
        _spans(kind, f"p_{kind}", f"e_{kind}", test, base, context, always).alias(f"s_{kind}")
        for kind, _, _, test, base, context, always in KINDS
    ))
    return df.select("_row.*", F.concat(*(f"s_{k[0]}" for k in KINDS)).alias(out))


def redact(docs: DataFrame, text: str = "text", spans: str = "pii") -> DataFrame:
    """The texts with every span replaced by ``<KIND>``; of overlapping spans the earlier, longer one wins."""
    ordered = f"array_sort({spans}, (x, y) -> CASE WHEN x.start <> y.start THEN x.start - y.start ELSE y.end - x.end END)"
    built = (
        f"aggregate({ordered}, named_struct('at', 0, 'out', ''), (a, s) -> if(s.start < a.at, a, named_struct('at', s.end, "
        f"'out', concat(a.out, substr({text}, a.at + 1, s.start - a.at), '<', upper(s.kind), '>'))), "
        f"a -> concat(a.out, substr({text}, a.at + 1)))"
    )
    return docs.withColumn(text, F.expr(f"if({text} IS NULL, NULL, {built})"))


def digest(spans: str = "pii", kinds: list[str] | None = None) -> Column:
    """``kind:start:end`` of the spans, comma-joined; of the given kinds only."""
    chosen = F.filter(spans, lambda s: s.kind.isin(kinds)) if kinds else F.col(spans)
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")
