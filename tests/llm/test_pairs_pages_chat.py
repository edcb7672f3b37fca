from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from duelist.llm import html_diff, jaccard_join, quote_link, toxicity_chain


# --- Jaccard join ------------------------------------------------------------------------------------------------------

def grams(text):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute_classes(rows):
    sets = defaultdict(list)
    for key, text in rows:
        sets[grams(text)].append(key)
    names, holders = list(sets), defaultdict(set)
    for i, s in enumerate(names):
        for g in s:
            holders[g].add(i)
    links, root = Counter(), list(range(len(names)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, s in enumerate(names):
        for j, n in Counter(j for g in s for j in holders[g] if j > i).items():
            if n >= 0.8 * (len(s) + len(names[j]) - n):
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    members = defaultdict(list)
    for i, s in enumerate(names):
        members[find(i)] += sets[s]
    return {k: (min(m for m in members[find(i)] if m is not None), links[i], len(sets[s])) for i, s in enumerate(names) for k in sets[s]}


@pytest.fixture(scope="module")
def near_rows(spark, sf_dir):
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    rng, base = random.Random(2), [f"w{k}" for k in range(150)]
    for k in range(300):  # one group of near copies larger than a block
        words = list(base)
        for _ in range(rng.choice([1, 2, 3])):
            words[rng.randrange(len(words))] = f"z{rng.randrange(1000)}"
        rows.append((10**6 + k, " ".join(words)))
    return rows + [(2 * 10**6, None), (2 * 10**6 + 1, ""), (2 * 10**6 + 2, "a b"), (2 * 10**6 + 3, "A b!"), (None, "A, b"), (2 * 10**6 + 4, "b a")]


def test_classes_and_link_counts_equal_brute_force(spark, near_rows):
    df = spark.createDataFrame(near_rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["class_id"], r["n_links"], r["n_copies"]) for r in jaccard_join.classes(df).collect()}
    assert got == brute_classes(near_rows)


def test_one_document_of_each_class_stays(spark, near_rows):
    rows = near_rows + near_rows[:50]
    df = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "doc_id long, text string, row_key int")
    kept = jaccard_join.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for c, _, _ in brute_classes(near_rows).values()})
    assert jaccard_join.classes(df.limit(0)).count() == 0


def test_classes_with_null_or_shared_ids_stay_apart(spark):
    texts = [" ".join(f"{name}{k}" for k in range(60)) for name in "abcdef"]
    near = " ".join([*texts[0].split()[:-1], "z"])
    rows = [(None, texts[0]), (None, near), (None, texts[1]), (None, texts[1]), (None, texts[2]), (7, texts[3]), (7, texts[4]), (7, texts[4]),
            (8, texts[5]), (None, texts[5]), (None, None), (None, "a b")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [(r["doc_id"], r["text"]) for r in jaccard_join.keep_one(df).collect()]
    assert len(kept) == 8 and ((None, texts[0]) in kept) != ((None, near) in kept)
    assert set(kept) - {(None, texts[0]), (None, near)} == {
        (None, texts[1]), (None, texts[2]), (7, texts[3]), (7, texts[4]), (8, texts[5]), (None, None), (None, "a b")}
    assert len({r["class_key"] for r in jaccard_join.classes(df).collect()}) == 8


def test_bayes_bounds():
    """Pairs at the threshold are kept, clearly different ones are dropped early."""
    least = dict(jaccard_join.least_matches(0.8, 1e-5))
    assert list(least) == list(range(16, 129, 16)) and least[16] >= 4 and least[128] > 0.6 * 128
    rng = np.random.default_rng(4)
    equal = rng.random((20_000, 128)) < 0.8
    kept = np.ones(20_000, bool)
    for n, m in least.items():
        kept &= equal[:, :n].sum(axis=1) >= m
    assert kept.mean() > 0.999


# --- pages -------------------------------------------------------------------------------------------------------------

def test_longest_common_subsequence():
    rng = random.Random(6)
    for _ in range(300):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(14))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        found, rest = html_diff.shared(np.array(a, np.int64), np.array(b, np.int64)), iter(b)
        assert len(found) == table[-1][-1] and found == sorted(found) and all(a[k] in rest for k in found)


LONG = "A sentence of the article that is long enough to outweigh the rest of this page."


@pytest.mark.parametrize("page", [
    '<body class="has-sidebar"><p>{}</p></body>', '<html class="no-sidebar"><body id="menu"><p>{}</p></body></html>',
    '<article class="post related"><p>{}</p></article>', '<main role="main" class="social"><p>{}</p></main>',
    '<div id="page" class="cookie-bar-open menu"><p>{}</p><div class="ad">Buy</div></div><div class="footer">Us</div>',
    '<body class="no-sidebar"><div class="share"><article><p>{}</p></article></div><div class="related">More</div></body>',
])
def test_class_words_around_everything_lose_no_text(page):
    assert html_diff.main_text(page.format(LONG), None) == (LONG, 0)


def test_an_article_in_a_div_with_teaser_cards_stays():
    cards = "<article><p>Teaser one</p></article><article><p>Teaser two</p></article>"
    page = f"<body><div class='menu'>Home</div><div class='post'><p>{LONG}</p><p>Shared by all pages</p></div>{cards}</body>"
    other = html_diff._hashes(html_diff.page_lines("<p>Other</p><p>Shared by all pages</p><p>Words</p>"))
    assert html_diff.main_text(page, other) == (f"{LONG}\n\nTeaser one\n\nTeaser two", 1)
    # an article that has the page's heading or outweighs what is around it is the text, as before
    assert html_diff.main_text(f"<p>{LONG}</p><article><h1>Title</h1><p>Short</p></article>", None) == ("Title\n\nShort", 0)
    assert html_diff.main_text(f"<div>Around</div><article><p>{LONG}</p></article>", None) == (LONG, 0)
    assert html_diff.main_text(f"<div class='ad'>Buy</div><p>{LONG}</p>", None) == (LONG, 0)


def test_articles_of_the_test_pages(spark, sf_dir):
    import html

    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    source = {r["page_id"]: r["html"] for r in pages.collect()}
    for r in html_diff.extract(pages).collect():
        inside = re.search(r"<article>(.*?)(?:</article>|$)", source[r["page_id"]], re.S)[1].replace("<br>", " ")
        blocks = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]+>", "", b))).strip() for b in re.split(r"</?(?:p|h1)>", inside)]
        assert r["text"] == "\n\n".join(b for b in blocks if b)


def test_pages_without_structure_are_differenced(spark):
    template = "<div>Site title</div><div>Main links</div><p>{}</p><p>{}</p><div>All rights reserved</div>"
    rows = [(k, f"http://a.b/news/{k}.html?x=1", template.format(f"first {k}", f"second {k}")) for k in range(6)]
    rows += [(10, None, None), (11, "bad", "<p>z"), (None, "http://a.b/news/0", "<main>q<br>r &amp; s<form>f</form></main>"), (12, "http://a.b/news/2#top", rows[2][2])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1))
    got = {r["page_id"]: (r["text"], r["n_deleted"]) for r in html_diff.extract(df).collect()}
    assert got == {k: (f"first {k}\n\nsecond {k}", 3) for k in range(6)} | {
        10: ("", 0), 11: ("z", 0), None: ("q r & s", 0), 12: ("first 2\n\nsecond 2", 3)}
    assert html_diff.extract(df.limit(0)).count() == 0


def test_a_short_article_on_a_rich_template_is_what_is_left(spark):
    """30 lines of template and two of the article; copies under other addresses and a page inside its neighbour."""
    template = "".join(f"<div>Template line {k}</div>" for k in range(15))
    page = lambda k: f"{template}<p>First of {k}</p><p>Second of {k}</p>{template.replace('line', 'end')}"
    rows = [(k, f"http://a.b/{k // 2}/{k % 2}.html", page(k)) for k in range(4)]
    rows += [(9, "http://a.b/0/1/print", page(1)), (10, "http://a.b/0/2", page(1)), (11, "http://a.b/3", page(3))]
    rows += [(20, "http://c.d/a", "<p>One</p><p>Two</p>"), (21, "http://c.d/b", "<p>One</p><p>Two</p><p>Three</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    got = {r["page_id"]: (r["text"], r["n_deleted"]) for r in html_diff.extract(df).collect()}
    article = {k: (f"First of {k}\n\nSecond of {k}", 30) for k in range(4)}
    assert got == article | {9: article[1], 10: article[1], 11: article[3], 20: ("One\n\nTwo", 0), 21: ("Three", 2)}


def test_differencing_equals_brute_force(spark):
    """Random pages without tags that tell: what is left is the page less a longest common subsequence with its neighbour."""
    rng = random.Random(8)
    pages = [[f"t{rng.randrange(6)}" for _ in range(rng.randrange(1, 12))] + [f"own {k}"] for k in range(12)]
    rows = [(k, f"http://h/{k:02d}", "".join(f"<p>{line}</p>" for line in page)) for k, page in enumerate(pages)]
    got = {r["page_id"]: r for r in html_diff.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for k, page in enumerate(pages):
        near = pages[k - 1 if k else 1]
        table = [[0] * (len(near) + 1) for _ in range(len(page) + 1)]
        for i, x in enumerate(page):
            for j, y in enumerate(near):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        left = got[k]["text"].split("\n\n")
        rest = iter(page)
        assert got[k]["n_deleted"] == table[-1][-1] == len(page) - len(left) and all(line in rest for line in left) and left[-1] == f"own {k}"


@pytest.mark.parametrize(("page", "text"), [
    ("<article><p>Body.</p></article><div class='comments'><p>{}</p></div>", "Body."),
    ("<article><h1>T</h1><p>Body.</p></article><div id='comments'><p>{}</p></div>", "T\n\nBody."),
    ("<article><p>Body.</p></article><article class='comment'><p>{}</p></article><article class='comment odd'><p>x</p></article>", "Body."),
    ("<article class='post comments-open'><p>Body.</p><ol class='comment-list'><li>{}</ol></article>", "Body."),
    ("<article><p>Body.</p></article><div>{}</div>", "Body."),
    ("<p>one<p/>two", "one\n\ntwo"),
    ("<p>one<script src='x'/>var a = 1;</script>two<svg/><br/>three", "onetwo three"),
    ("<p>one <script>var a;</script><button>Buy<div>now</div></button> two<style>p {{}}</style>", "one\n\ntwo"),
    ("<p>one<svg><title/><path/></svg>two", "onetwo"),
])
def test_comments_and_empty_tags(page, text):
    assert html_diff.main_text(page.format(LONG), None)[0] == text


def test_structure_rules():
    page = ("<html><head><title>t</title><script>var a='<p>no</p>'</script></head><body><header>top</header><nav>menu</nav>"
            "<div class='cookie-notice'>ok?</div><article><header><h1>T</h1></header><p>one <b>bold</b>\n two<p>three<aside>side</aside>"
            "<div class=\"ad\">buy</div><ul id=comments><li>me</ul></article><footer>f</footer>")
    assert html_diff.main_text(page, None) == ("T\n\none bold two\n\nthree", 0)
    assert html_diff.main_text(None, None) == ("", 0)


# --- chat ----------------------------------------------------------------------------------------------------------------

def test_quotes_are_linked_and_cut(spark):
    rows = [
        (1, 0, "user", "Hello dear list members.\nHow do I sort?"),
        (1, 1, "a", "On Monday X wrote:\n> Hello dear list members.\n> How do I sort?\nUse orderBy please now."),
        (1, 1, "a", "On Monday X wrote:\n> Hello dear list members.\n> How do I sort?\nUse orderBy please now."),
        (1, 2, "u", "A wrote:\n> > How do I sort?\n> Use orderBy please now.\n\nThanks a lot indeed."),
        (2, 0, "z", ">Thanks a lot indeed.\nWelcome"),
        (2, 1, "z", "> nobody said this ever\nok"),
        (3, 0, "u", "a > b is not a quote"), (None, 0, "u", None), (3, 1, "u", ""),
        (0, 5, "u", "> Use orderBy please now.\nEarlier conversation."),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("depth", F.lit("clash"))
    got = {(r["conv_id"], r["turn"], r["text"], r["reply_conv"], r["reply_turn"], r["thread_id"], r["depth"]) for r in quote_link.link(df).collect()}
    assert got == {
        (1, 0, rows[0][3], None, None, 1, 0), (1, 1, "Use orderBy please now.", 1, 0, 1, 1), (1, 2, "Thanks a lot indeed.", 1, 1, 1, 2),
        (2, 0, "Welcome", 1, 2, 1, 3), (2, 1, "ok", None, None, 2, 0), (3, 0, rows[6][3], None, None, 3, 0), (None, 0, None, None, None, None, 0),
        (3, 1, "", None, None, 3, 0), (0, 5, "Earlier conversation.", None, None, 0, 0)}
    assert quote_link.link(df).count() == len(rows)
    assert quote_link.link(df.limit(0)).count() == 0


def test_long_reply_chain(spark):
    rows = [(7, 0, "u", "words of message number zero")]
    rows += [(7, k, "u", f"> words of message number {'zero' if k == 1 else k - 1}\nwords of message number {k}") for k in range(1, 40)]
    out = quote_link.link(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert all(r["depth"] == r["turn"] and r["reply_turn"] == (r["turn"] - 1 if r["turn"] else None) for r in out.collect())


# --- toxicity --------------------------------------------------------------------------------------------------------------

def test_chain_on_held_out_rows(spark):
    rng = random.Random(8)
    rows, labels = [], []
    for k in range(700):
        toxic, quality = rng.random() < 0.3, rng.random() < 0.7
        words = [f"n{rng.randrange(300)}" for _ in range(30)] + ["clean"] * quality + [f"insult{rng.choice('abcdef')}"] * toxic
        rng.shuffle(words)
        rows.append((k, " ".join(words)))
        labels.append((k, int(quality), int(toxic)))
    docs = spark.createDataFrame([*rows, (900, None), (901, "")], "doc_id long, text string").withColumn("p_toxic", F.lit("clash"))
    known = spark.createDataFrame([*labels[:400], (None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int")
    chain = toxicity_chain.fit(docs, known)
    out = toxicity_chain.score(docs, chain)
    assert out.columns == ["doc_id", "text", "p_toxic", "p_quality", "_p_toxic"]
    got = {r["doc_id"]: r for r in out.collect()}
    assert len(got) == 702
    for name, k in (("p_quality", 1), ("_p_toxic", 2)):
        assert sum((got[row[0]][name] >= 0.5) == (row[k] == 1) for row in labels[400:]) > 0.97 * 300
    flagged = {r["doc_id"] for r in toxicity_chain.flag(docs, chain).collect()}
    assert flagged == {k for k, r in got.items() if r["_p_toxic"] >= 0.5}


def test_no_labels_and_one_class(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, "d e")], "doc_id long, text string")
    none = toxicity_chain.fit(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert {r["p_toxic"] for r in toxicity_chain.score(docs, none).collect()} == {0.0}
    one = toxicity_chain.fit(docs, spark.createDataFrame([(1, 1, 0), (2, 1, 0)], "doc_id long, quality int, toxic int"))
    assert {(r["p_quality"], r["p_toxic"]) for r in toxicity_chain.score(docs, one).collect()} == {(1.0, 0.0)}


def test_scores_are_those_of_the_whole_vocabulary(spark, sf_dir):
    """Pruned scoring against the fitted vocabulary and models applied one after the other, without any pruning."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    chain = toxicity_chain.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    got = {r["doc_id"]: (r["p_quality"], r["p_toxic"]) for r in toxicity_chain.score(docs, chain).collect()}
    words = docs.withColumn("_plain", toxicity_chain.plain_words(F.col("text"))).withColumn("_tokens", toxicity_chain._tokens("_plain"))
    rows = chain.vocabulary.transform(words)
    index = {r["doc_id"]: set(r["_words"].indices.tolist()) for r in rows.select("doc_id", "_words").collect()}
    assert len(got) == len(index) and any(m is not None for m in chain.models)
    for key, found in index.items():
        odds = []
        for k, model in enumerate(chain.models):
            p = chain.constants[k]
            if model is not None:
                own, size = model.coefficients.toArray(), len(chain.vocabulary.vocabulary)
                p = 1 / (1 + math.exp(-(model.intercept + sum(own[i] for i in found) + sum(w * o for w, o in zip(own[size:], odds)))))
            assert abs(p - got[key][k]) < 1e-12
            odds.append(math.log(max(p, 1e-4) / max(1 - p, 1e-4)) / 4)


def test_single_sentences_and_short_quotations(spark):
    """One sentence out of a line links; words under three link inside their conversation, not to others."""
    rows = [
        (1, 0, "Yes."), (1, 1, "The first thing is dull. The second thing is worth a quote! And a third."),
        (2, 0, "Can it be done?"), (2, 1, "Maybe not."), (2, 2, "> Maybe not.\nWhy?"), (2, 3, "> Yes.\nOf whom?"),
        (2, 4, "> the second thing is\n> worth a quote\nIndeed"), (2, 5, "> ...\nno words"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, text string").withColumn("role", F.lit("user"))
    got = {(r["conv_id"], r["turn"]): (r["reply_conv"], r["reply_turn"], r["n_quotes"]) for r in quote_link.link(df).collect()}
    assert {k: v[:2] for k, v in got.items() if v[0] is not None} == {(2, 2): (2, 1), (2, 4): (1, 1)}
    assert got[2, 3] == (None, None, 1) and got[2, 5] == (None, None, 1)


def test_links_equal_a_brute_force_linker(spark):
    """Random threads: the first message that holds a quoted line, of the conversation, else of all, in order."""
    rng = random.Random(9)
    lines = [f"line number {k} of the pool" for k in range(25)] + [f"w{k}" for k in range(8)]
    rows = []
    for conv in range(6):
        for turn in range(6):
            quotes = [f"> {rng.choice(lines)}"] if rng.random() < 0.5 else []
            rows.append((conv, turn, "\n".join([*quotes, *rng.sample(lines, 3)])))
    want = {}
    for conv, turn, text in rows:
        quoted = [line[2:] for line in text.split("\n") if line.startswith("> ")]
        if not quoted:
            continue
        holds = [(c, t) for c, t, other in rows if (c, t) < (conv, turn) and quoted[0] in other.split("\n")]
        own = [p for p in holds if p[0] == conv]
        found = own or (holds if len(quoted[0].split()) >= 3 else [])
        if found:
            want[conv, turn] = found[0]
    df = spark.createDataFrame(rows, "conv_id long, turn long, text string").withColumn("role", F.lit("user"))
    got = {(r["conv_id"], r["turn"]): (r["reply_conv"], r["reply_turn"]) for r in quote_link.link(df).collect()}
    assert len(want) > 5 and {k: v for k, v in got.items() if v[0] is not None} == want
