from __future__ import annotations

import itertools
import random
import re

from duelist.llm import decontaminate, line_dedup, pii


# --- personal data -----------------------------------------------------------------------------------------------

def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def brute_pii(text):
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(f"email:{m.start()}:{m.end()}")
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append(f"ip:{m.start()}:{m.end()}")
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[ -]", "", m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(f"card:{m.start()}:{m.end()}")
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append(f"phone:{m.start()}:{m.end()}")
    return ",".join(out)


HARD = [
    None, "", "a@b.c_d@e.f x@y x@y.z. \U0001F600 a.b+c@d-e.co.uk", "1.2.3.4.5.6.7.8 001.2.3.255 256.1.1.1 999999999999999999.1.1.1",
    "4111 1111 1111 1111 x 4111-1111-1111-1112 4111111111111111.", "+1 (555) 123-4567 ++49 30 1234567. +1 2", "\u0001\u0001 a@b.cc \u0001",
    "1" * 5_000, "a" * 5_000, "a@b.co " * 2_000, "1.1.1.1" * 300,
]


def test_base_spans_equal_brute_force(spark, sf_dir):
    texts = HARD + [r[0] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["d"] for r in pii.find(df).select("doc_id", pii.digest(kinds=pii.BASE_KINDS).alias("d")).collect()}
    assert got == {k: brute_pii(t) for k, t in enumerate(texts)}


def test_very_long_runs_finish(spark):
    df = spark.createDataFrame([(1, "1" * 1_000_000), (2, "a." * 500_000), (3, "+1" + "(" * 500_000)], "doc_id long, text string")
    assert {r["n"] for r in pii.find(df).selectExpr("size(pii) AS n").collect()} == {0}


def test_checksums_and_context(spark):
    texts = ["iban DE89 3704 0044 0532 0130 00", "DE88 3704 0044 0532 0130 00", "ssn: 123-45-6789", "see 123-45-6789", "call 555-123-4567", "code 555-123-4567"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["k"] for r in pii.find(df).selectExpr("doc_id", "transform(pii, s -> s.kind) AS k").collect()}
    assert got == {0: ["iban"], 1: [], 2: ["national_id"], 3: [], 4: ["local_phone"], 5: []}


def test_redaction_and_extra_columns(spark):
    df = spark.createDataFrame([(1, "to a@b.cc, 10.0.0.1", "x"), (2, None, "y")], "doc_id long, text string, pii string")
    found = pii.find(df)
    assert found.columns == ["doc_id", "text", "pii", "_pii"]
    red = pii.redact(found, "text", "_pii").orderBy("doc_id").collect()
    assert [r["text"] for r in red] == ["to <EMAIL>, <IP>", None]
    assert pii.find(df.limit(0)).count() == 0


# --- line dedup --------------------------------------------------------------------------------------------------

def brute_lines(rows):
    seen, out = {}, {}
    for key, text in sorted(rows, key=lambda r: r[0]):
        if text is None:
            out[key] = (None, [])
            continue
        lines = text.split("\n")
        full = [(i, s) for i, s in ((i, line.strip(" \t\r\x0b\f")) for i, line in enumerate(lines)) if s]
        runs = [full[i : i + 3] for i in range(max(1, len(full) - 2))] if full else []
        size = lambda *some: sum(len(re.findall(r"[^\x20\x09-\x0D]+", x[1])) for x in some)
        runs += [[x] for x in full if len(full) > 1 and size(x) > 50]
        runs += [list(x) for x in zip(full, full[1:]) if len(full) > 2 and size(*x) > 50]
        gone = set()
        for run in sorted(runs, key=lambda r: r[0][0]):
            words = tuple(x[1] for x in run)
            if words in seen and seen[words] != (key, run[0][0]):
                gone.update(range(run[0][0], run[-1][0] + 1))
            else:
                seen[words] = (key, run[0][0])
        out[key] = ("\n".join(line for i, line in enumerate(lines) if i not in gone), sorted(gone))
    return out


def test_line_dedup_equals_brute_force(spark, sf_dir):
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    extra = [None, "", "a\nb\nc\nd\na\nb\nc", "\n a \n\nb\n\nc\n", "x", "x", "q\nq\nq\nq\nq", "p " * 200 + "\nz", "y\n" + "p " * 200, "r\n" * 20_000]
    rows += [(10**6 + k, t) for k, t in enumerate(extra)]
    got = line_dedup.drop_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["doc_id"]: (r["text"], r["removed"]) for r in got.collect()} == brute_lines(rows)


def test_long_passages_of_one_and_two_lines_go_whatever_their_characters(spark):
    one, short = " ".join(f"a{k}" for k in range(51)), " ".join(f"b{k}" for k in range(50))
    two = "\n".join(" ".join(f"{c}{k}" for k in range(40)) for c in "cd")
    rows = [(3 * k + j, f"own {k} {j}\n{text}\nends {k} {j}\nand {j} more {k}") for k in range(3) for j, text in enumerate((one, short, two))]
    rows += [(100, "x" * 400 + "\nq1\nq2\nq3"), (101, "q4\nq5\nq6\n" + "x" * 400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS _cut", "2 AS removed", "3 AS hash", "4 AS lines", "5 AS _cut_id")
    got = {r["doc_id"]: (r["text"], r["_removed"]) for r in line_dedup.drop_repeats(df).collect()}
    assert got == brute_lines(rows)
    assert [len(got[k][1]) for k in range(9)] == [0, 0, 0, 1, 0, 2, 1, 0, 2] and not got[101][1]


def test_line_dedup_edge_cases(spark):
    df = spark.createDataFrame([(None, "a\nb\nc", 1), (1, "a\nb\nc", 2), (1, "a\nb\nc", 3)], "doc_id long, text string, removed int")
    got = line_dedup.drop_repeats(df)
    assert got.columns == ["doc_id", "text", "removed", "_removed"]
    assert sorted((r["removed"], r["text"]) for r in got.collect()) == [(1, "a\nb\nc"), (2, ""), (3, "")]
    assert line_dedup.drop_repeats(df.limit(0)).count() == 0


# --- decontamination -----------------------------------------------------------------------------------------------

def test_passages_with_changed_words_are_found_and_others_left(spark, sf_dir):
    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(400)]
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.randrange(15, 60)))) for k in range(60)]
    docs = [(k, " ".join(rng.choices(vocabulary, k=300))) for k in range(200)]
    for k, text in items[:40]:
        words = text.split()
        for i in range(3, len(words), 8):
            words[i] = "changed"
        docs.append((1_000 + k, " ".join(rng.choices(vocabulary, k=50) + words + rng.choices(vocabulary, k=50))))
    docs += [(2_000, items[0][1].upper().replace(" ", ", ")), (2_001, " ".join(items[50][1].split()[:7])), (2_002, None), (2_003, "")]
    found = decontaminate.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    got = {r["doc_id"]: r["item_ids"] for r in found.collect()}
    assert got == {1_000 + k: [k] for k in range(40)} | {2_000: [0]}


def test_whole_items_in_the_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    plain = lambda t: f" {' '.join(re.findall(r'[^\W_]+', (t or '').lower()))} "
    items = {r["item_id"]: plain(r["text"]) for r in benchmark.collect()}
    expected = {r["doc_id"] for r in docs.collect() if any(v in plain(r["text"]) for v in items.values())}
    assert {r["doc_id"] for r in decontaminate.leaks(docs, benchmark).collect()} == expected


def test_decontamination_edge_cases(spark):
    item = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    benchmark = spark.createDataFrame([(1, item), (2, item), (3, "too short"), (4, None)], "item_id long, text string")
    docs = spark.createDataFrame([(None, item, 1), (7, item, 2), (7, item, 3), (8, "fine", 4), (9, None, 5)], "doc_id long, text string, text_hash int")
    rows = decontaminate.leaks(docs, benchmark).collect()
    assert sorted((str(r["doc_id"]), r["item_ids"]) for r in rows) == [("7", [1, 2]), ("None", [1, 2])]
    kept = decontaminate.drop_leaks(docs, benchmark)
    assert kept.columns == docs.columns and sorted(r["text_hash"] for r in kept.collect()) == [4, 5]
    assert decontaminate.leaks(docs.limit(0), benchmark).count() == 0
    assert decontaminate.drop_leaks(docs, benchmark.limit(0)).count() == 5


def accepted(same):
    """The diagonal verification on its own: hits of the best-scoring stretch against the number needed."""
    score = hits = best = found = 0
    for m in same:
        score, hits = (score, hits) if score > 0 else (0, 0)
        score, hits = score + (1 if m else -decontaminate.MISMATCH), hits + m
        if score > best:
            best, found = score, hits
    return found >= min(decontaminate.MIN_MATCHES, -(-len(same) * 8 // 10))


def seeded(same):
    return any(all(same[i + p] for p in mask) for mask in decontaminate.MASKS for i in range(len(same) - mask[-1]))


def test_every_period_and_offset_of_changed_words_has_a_seed():
    cases = [[i % period != offset for i in range(n)]
             for n in [*range(9, 61), 200] for period in range(4, 13) for offset in range(period)]
    assert [c for c in cases if accepted(c) and not seeded(c)] == []
    short = [[i not in gone for i in range(n)] for n in range(9, 16) for k in range(5) for gone in itertools.combinations(range(n), k)]
    assert [c for c in short if accepted(c) and not seeded(c)] == []


def test_periodic_changes_are_found_as_brute_force_accepts_them(spark):
    items, docs, expected = [], [], {}
    for n in (9, 10, 15, 38, 59, 200):
        items.append((n, " ".join(f"i{n}w{k}" for k in range(n))))
        for period in range(4, 13):
            for offset in range(period):
                same = [i % period != offset for i in range(n)]
                words = [w if m else "changed" for w, m in zip(items[-1][1].split(), same)]
                docs.append((len(docs), " ".join(["before"] * 20 + words + ["after"] * 20)))
                if accepted(same):
                    expected[docs[-1][0]] = [n]
    found = decontaminate.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {r["doc_id"]: r["item_ids"] for r in found.collect()} == expected
