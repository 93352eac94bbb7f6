"""Mixing, host reputation, language, language model, extraction and the pipeline."""

import html
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from tests.llm import cases
from tideline.llm import extraction, language, maxent, mixing, reputation

ROWS = cases.make_documents()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, cases.SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], cases.SCHEMA)


# Mixing


def plain_targets(sizes):
    """Share by weight; what is above a limit is shared again, until nothing is."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    full, total = set(), 1.5 * sum(sizes.values())
    while True:
        left, weights = total - sum(2 * sizes[s] for s in full), sum(weight[s] for s in names if s not in full)
        goal = {s: 2 * sizes[s] if s in full else left * weight[s] / weights for s in names}
        over = {s for s in names if s not in full and goal[s] > 2 * sizes[s]}
        if not over:
            return goal
        full |= over


@pytest.mark.parametrize("table", ["cases", "many"])
def test_mix(spark, docs, table):
    rows = [(r[0], r[1], r[3]) for r in ROWS]
    if table == "many":
        rng = random.Random(2)
        rows = [(i, "w " * int(rng.paretovariate(2)), f"s{min(rng.randrange(30), 17)}") for i in range(6000)]
        docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)
    out = mixing.mix_counts(docs, keep_row=True).collect()
    size = {}
    for _, text, source in rows:
        size[source] = size.get(source, 0) + len(cases.WORD.findall(text or ""))
    goal, taken = plain_targets(size), Counter()
    assert len(out) == len(rows)
    for r in out:
        source = r["row"]["source"]
        assert r["source_size"] == size[source] and math.isclose(r["target"], goal[source], rel_tol=1e-12)
        assert r["taken"] == r["copies"] * r["size"] <= 2 * r["size"]
        taken[source] += r["taken"]
    longest = max(r["size"] for r in out)
    for source, want in goal.items():
        assert abs(taken[source] - want) <= longest * 1.01 + 1
        if table == "many":
            assert abs(taken[source] - want) <= 0.05 * want + longest
    again = mixing.mix_counts(docs.repartition(3)).collect()
    assert Counter((r["id"], r["taken"]) for r in again) == Counter((r["id"], r["taken"]) for r in out)


def test_mixed_documents(docs, none):
    out = mixing.mixed_documents(docs)
    assert [c for c in out.columns if c != "copy"] == [c for c in docs.columns if c != "copy"]
    copies = {(r["id"], r["size"]): r["copies"] for r in mixing.mix_counts(docs).collect()}
    assert out.count() == sum(r["copies"] for r in mixing.mix_counts(docs).collect()) and copies
    assert mixing.mixed_documents(none).count() == 0


# Host reputation

URLS = [
    (1, "http://A.example.ORG/es/1?q=/x"), (2, "https://example.org/en/17"), (3, "https://www.example.org/en/27#a/b"),
    (4, "ftp://b.example.com/fr/2"), (5, "http://example.com/de"), (6, "http://example.com/de/9"), (7, None),
    (8, "no address"), (9, "http://"), (10, "x://host.net?a=1"), (11, "http://org/"), (12, "http://notorg/"),
    (13, "http://org"), (14, "http://bad.example.net/5"), (14, "http://bad.example.net/5"), (None, "http://bad.example.net/6"),
]


def test_rules_and_reputation(spark):
    pages = spark.createDataFrame(URLS, "page_id long, url string").selectExpr("*", "'h' AS host", "1 AS bad", "2 AS n")
    labelled = [(f"http://bad.example.net/{i}", i % 10 != 0) for i in range(60)] + [
        (f"http://good{i % 9}.example.net/{i}", i % 12 == 0) for i in range(200)
    ]
    outcomes = spark.createDataFrame([*labelled, ("http://bad.example.net/x", None)], "url string, bad boolean")
    out = {(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in reputation.filter_urls(pages, outcomes).collect()}
    assert out == {
        (1, "a.example.org", "/es/1", "example.org/es/", "block"), (2, "example.org", "/en/17", "example.org/en/1", "block"),
        (3, "www.example.org", "/en/27", "org/", "allow"), (4, "b.example.com", "/fr/2", "com/fr/", "allow"),
        (5, "example.com", "/de", None, "allow"), (6, "example.com", "/de/9", "com/de/", "block"), (7, "", "", None, "allow"),
        (8, "", "", None, "allow"), (9, "", "", None, "allow"), (10, "host.net", "", None, "allow"),
        (11, "org", "/", "org/", "allow"), (12, "notorg", "/", None, "allow"), (13, "org", "", None, "allow"),
        (14, "bad.example.net", "/5", None, "block"), (None, "bad.example.net", "/6", None, "block"),
    }
    assert reputation.filter_urls(pages, outcomes).count() == len(URLS)
    assert reputation.filter_urls(pages.limit(0), outcomes.limit(0)).count() == 0
    assert reputation.filter_urls(pages, outcomes.limit(0)).where("rule IS NULL AND verdict = 'block'").count() == 0


def test_hosts_without_labels_have_their_domains_prior(spark):
    labelled = [(f"http://h{i % 30}.bad.net/{i}", i % 50 != 0) for i in range(3000)]
    labelled += [(f"http://h{i % 30}.good.net/{i}", i % 50 == 0) for i in range(3000)]
    outcomes = spark.createDataFrame(labelled, "url string, bad boolean")
    made = [(1, "http://new.bad.net/1"), (2, "http://new.good.net/1"), (3, "http://else.net/"), (4, None), (5, "http://h1.bad.net/")]
    out = reputation.filter_urls(spark.createDataFrame(made, "page_id long, url string"), outcomes, rules=())
    assert {r["page_id"]: r["verdict"] for r in out.collect()} == {1: "block", 2: "allow", 3: "allow", 4: "allow", 5: "block"}


def test_shrinkage(spark):
    """Small hosts lie near their domain, large ones near their own rate."""
    made = [("h1.a.com", i < 90) for i in range(100)] + [("h2.a.com", True)] + [("h3.b.com", i < 5) for i in range(100)]
    made += [(f"h{i}.b.com", i % 20 == 0) for i in range(4, 60)]
    rate = {r["host"]: r["rate"] for r in reputation.host_reputation(spark.createDataFrame(made, "host string, bad boolean")).collect()}
    assert abs(rate["h1.a.com"] - 0.9) < 0.05 and 0.3 < rate["h2.a.com"] < 1 and rate["h5.b.com"] < 0.15


# Language


def sentences(rng, syllables, n):
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 3))) for _ in range(n))


def test_languages(spark):
    rng = random.Random(4)
    tongues = {"aa": ["ka", "lo", "mi", "ten"], "bb": ["ür", "sch", "eng", "au"], "cc": ["oui", "tre", "eau", "pa"]}
    made = []
    for i in range(300):
        name = rng.choice(list(tongues))
        declared = rng.choice([name] * 9 + ["aa", None])
        host = f"{'www' if i % 3 else 'm'}.{name if i % 5 else 'aa'}site.com"
        made.append((i, sentences(rng, tongues[name], rng.randint(2, 80)), declared, host, name))
    made.append((900, sentences(rng, tongues["cc"], 200), "aa", "www.aasite.com", "cc"))
    junk = [(901, "".join(rng.choice("bcdfghjklmnpqrstvwxz") for _ in range(900)), "aa", None, "und"),
            (902, "12 34 -- 99", "bb", None, None), (903, "", None, None, None), (None, None, "cc-CH", None, None)]
    rows = spark.createDataFrame([*made, *junk], "id long, text string, declared string, site string, truth string")
    from pyspark.sql import functions as F

    out = {r["id"]: r for r in language.identify(rows, "id", "text", F.col("declared"), F.col("site")).collect()}
    right = sum(out[r[0]]["lang"] == r[4] for r in made)
    assert right >= 0.99 * len(made) and all(out[r[0]]["accepted"] for r in made)
    assert out[900]["lang"] == "cc" and out[901]["lang"] == "und" and not out[901]["accepted"]
    assert not out[902]["accepted"] and not out[903]["accepted"] and not out[None]["accepted"]
    assert out[None]["declared"] == "cc" and out[None]["lang"] == "cc"


def test_language_stage(docs, none):
    kept = language.in_known_language(docs.selectExpr("*", "1 AS __size"))
    assert kept.columns == [*docs.columns, "__size"]
    assert {r["doc_id"] for r in kept.where("text IS NOT NULL").collect()} >= {r[0] for r in ROWS if r[1] and len(r[1]) > 200}
    assert kept.where("text IS NULL OR trim(text) = ''").count() == 0
    assert language.in_known_language(none).count() == 0


def test_rare_languages_stay(spark):
    """Languages that few rows declare beside a hot source: one in other letters and one in Latin ones."""
    rng = random.Random(11)
    tongues = {"aa": (["ka", "lo", "mi", "ten"], 9000), "qg": (["მი", "და", "რო", "ლს"], 4), "qz": (["xhu", "zgj", "ëz", "qy"], 4)}
    made = [(sentences(rng, syllables, 60), name, name) for name, (syllables, n) in tongues.items() for _ in range(n)]
    rows = spark.createDataFrame([(i, *r) for i, r in enumerate(made)], "doc_id long, text string, lang string, source string")
    from pyspark.sql import functions as F

    out = language.identify(rows, "doc_id", "text", F.col("lang"), F.col("source")).collect()
    assert len(out) == len(made) and all(r["lang"] == made[r["id"]][1] and r["accepted"] for r in out)
    assert language.in_known_language(rows).count() == len(made)


def test_many_languages_in_small_parts(spark, monkeypatch):
    """Parts of counts and weights that are handed on early add up to the same."""
    rng = random.Random(12)
    names = [a + b for a in "abcdefgh" for b in "mnopqrst"]
    made = [(i, sentences(random.Random(names[i % 64]), [f"{names[i % 64]}{c}" for c in "aeiou"], 50 + rng.randint(0, 9)), names[i % 64])
            for i in range(640)]
    rows = spark.createDataFrame(made, "doc_id long, text string, lang string").selectExpr("*", "concat(lang, '.com') AS source")
    from pyspark.sql import functions as F

    def found():
        out = language.identify(rows, "doc_id", "text", F.col("lang"), F.col("source")).collect()
        return {r["id"]: (r["lang"], round(r["posterior"], 6), r["accepted"]) for r in out}

    whole = found()
    monkeypatch.setattr(language, "CELLS", 3 * language.FEATURES)
    assert found() == whole and all(whole[i][0] == name for i, _, name in made)


def test_page_languages(spark):
    rng = random.Random(5)
    made = [
        (i, f"http://h{i % 3}.com/{i}", f"<html lang='{n}-X'><script>var x = 1;</script><p>{sentences(rng, s, 40)}</p></html>")
        for i in range(60)
        for n, s in [(("en", ["th", "er", "ing"]), ("es", ["ción", "ar", "os"]))[i % 2]]
    ]
    out = language.page_languages(spark.createDataFrame([*made, (99, None, None)], "page_id long, url string, html string"))
    assert all(r["lang"] == ("en", "es")[r["page_id"] % 2] for r in out.collect() if r["page_id"] != 99)


# Language model


def test_scores(spark, docs, none):
    out = maxent.score_documents(docs, steps=6).collect()
    tokens = [(r[0], [*cases.WORD.findall(cases.lower(r[1] or "")), None]) for r in ROWS]
    held = lambda i: zlib.crc32(str("" if i is None else i).encode()) % 7 == 2
    counts = Counter(t for i, w in tokens if not held(i) for t in w)
    total, room = sum(counts.values()), sum(counts.values()) + len(counts) + 1
    want = Counter(
        (i, held(i), len(w), sum(counts[t] > 0 for t in w), total, round(sum(math.log10((counts[t] + 1) / room) for t in w), 6))
        for i, w in tokens
    )
    got = Counter((r[0], r[1], r[2], r[3], r[4], round(r["base_score"], 6)) for r in out)
    assert got == want
    assert all(r["score"] < 0 for r in out)
    assert maxent.score_documents(none, steps=1).count() == 0


def test_rare_words_come_by_the_join(docs, monkeypatch):
    full = {(r[0], r[2]): r for r in maxent.score_documents(docs, steps=2).collect()}
    monkeypatch.setattr(maxent, "HOT_WORDS", 250)
    for r in maxent.score_documents(docs, steps=2).collect():
        other = full[r[0], r[2]]
        assert r["n_known"] == other["n_known"] and math.isclose(r["base_score"], other["base_score"], rel_tol=1e-9)
        assert math.isclose(r["score"], other["score"], rel_tol=1e-5)


def test_words_of_one_zero_byte(spark):
    """A word that is a NUL ends like no other; it is not the end."""
    rng = random.Random(3)
    made = [(i, " ".join([*(f"w{rng.randrange(60)}" for _ in range(40)), *["\x00"] * 40])) for i in range(60)]
    out = maxent.score_documents(spark.createDataFrame(made, "doc_id long, text string"), steps=3).collect()
    assert len(out) == 60 and all(math.isfinite(r["score"]) and r["score"] < 0 for r in out)


def test_names_that_tell_what_an_element_holds(spark):
    made = [
        (1, "http://a.com/1", "<body class='has-sidebar no-ads'><article>Kept text.</article></body>"),
        (2, "http://a.com/2", "<article class='post has-comments comments-open'><p>Also kept.</p><div class='comments'>no</div></article>"),
        (3, "http://a.com/3", "<div class='with-banner'><p>Held by a frame.</p></div><div id='cookie-banner'>no</div>"),
    ]
    out = extraction.extract_main_text(spark.createDataFrame(made, "page_id long, url string, html string"))
    assert {r["page_id"]: r["text"] for r in out.collect()} == {1: "Kept text.", 2: "Also kept.", 3: "Held by a frame."}


def test_one_page_under_two_addresses_keeps_its_text(spark):
    body = "<div><p>" + " ".join(f"word{i}" for i in range(40)) + "</p></div>"
    banner = "<div><p>" + " ".join(f"menu{i}" for i in range(20)) + "</p></div>"
    made = [(1, "http://a.com/x", banner + body), (2, "http://a.com/y", banner + body), (3, "http://a.com/z", banner + "<div>Other words here.</div>")]
    out = extraction.extract_main_text(spark.createDataFrame(made, "page_id long, url string, html string"))
    want = " ".join(f"word{i}" for i in range(40))
    assert {r["page_id"]: r["text"] for r in out.collect()} == {1: want, 2: want, 3: "Other words here."}


def test_url_filter_sql_judges_hosts_without_labels(spark, tmp_path):
    """The query equals its SQL on pages of hosts that no label names, under bad and good domains and suffixes."""
    from tests.compare import compare
    from tideline.llm import queries

    rng = random.Random(7)
    pages, labels = [], []
    for i in range(600):
        domain, bad = rng.choice([("worse.net", 0.95), ("good.net", 0.05), ("mixed.org", 0.5), ("awful.xyz", 0.98)])
        pages.append((i, f"http://h{rng.randrange(4)}.{domain}/p/{i}", "x"))
        labels.append((i, int(rng.random() >= bad), 0))
    for i, host in enumerate(["new.worse.net", "new.good.net", "new.mixed.org", "other.xyz", "a.b.c", "", "new.org"]):
        pages.append((1000 + i, f"http://{host}/q", "x"))
    pages += [(2000, None, None), (2001, "no address", "x")]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels")
    for name in ("pages", "labels"):
        file = next((tmp_path / name).glob("part-*.parquet"))
        if len(list((tmp_path / name).glob("part-*.parquet"))) > 1:
            spark.read.parquet(f"{tmp_path}/{name}").coalesce(1).write.parquet(f"{tmp_path}/one-{name}")
            file = next((tmp_path / f"one-{name}").glob("part-*.parquet"))
        (tmp_path / f"{name}.parquet").symlink_to(file)
    assert compare(spark, str(tmp_path), queries.op4_url_filter, reputation.SQL) == ""
    verdicts = {r["page_id"]: r["verdict"] for r in queries.op4_url_filter(spark, str(tmp_path)).collect()}
    assert verdicts[1000] == "block" and verdicts[1003] == "block" and verdicts[1001] == "allow" and verdicts[1005] == "allow"


def plain_training(cells, steps):
    """The gradient steps over (context, class, n) in one array."""
    totals = np.zeros((maxent.CONTEXTS, 1))
    seen = np.zeros((maxent.BUCKETS, maxent.CLASSES))
    for context, own, n in cells:
        totals[context] += n
        for rows in maxent.feature_rows(np.array([context])):
            seen[rows[0], own] += n
    at = np.flatnonzero(totals)
    weights = np.zeros((maxent.BUCKETS, maxent.CLASSES), np.float32)
    for step in range(steps):
        expected = maxent.feature_sums(at, (totals[at] * np.exp(maxent.log_softmax(weights, at))).astype(np.float32))
        change = (seen - expected - maxent.PULL * weights * 0.01) / (expected + maxent.PULL)
        moved = np.where(change > 0, np.log1p(np.maximum(change, 0)), change)
        weights = (weights + (0.6 if step < 3 else 0.4) * np.clip(moved, -1.5, 1.5)).astype(np.float32)
    return weights


def test_training_equals_plain_steps(spark):
    rng = random.Random(4)
    cells = [(rng.randrange(maxent.CONTEXTS), c, rng.randint(1, 30)) for c in range(maxent.CLASSES) for _ in range(9)]
    frame = spark.createDataFrame(cells, "context int, class int, n long").repartition(5)
    assert np.allclose(maxent.train(frame, 4), plain_training(cells, 4), atol=2e-4)


def test_model_learns_and_adds_up(spark):
    rng = random.Random(6)
    follow = {a: rng.sample(range(30), 3) for a in range(30)}
    made = []
    for i in range(600):
        word, words = rng.randrange(30), []
        for _ in range(30):
            words.append(f"v{word}")
            word = rng.choice(follow[word])
        made.append((i, " ".join(words)))
    out = maxent.score_documents(spark.createDataFrame(made, "doc_id long, text string")).where("held_out")
    base, score, n = out.selectExpr("sum(base_score)", "sum(score)", "sum(n_tokens)").first()
    # Three words can follow each word: half a decimal digit a token.
    assert score / n > -0.75 and base / n < -1.3
    weights = np.random.default_rng(0).normal(size=(maxent.BUCKETS, maxent.CLASSES)).astype(np.float32)
    table = np.exp(maxent.log_softmax(weights, np.arange(500)))
    assert np.allclose(table.sum(1), 1, atol=1e-4)


# Extraction

PAGE = (
    "<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{{}}</style><script>var t='</p><p>no';</script></head><body>"
    "<nav><ul><li><a href='/x'>Menu</a></li></ul></nav><!-- <p>no</p> --><div class='ad big'>Buy</div>"
    "<article><h1>Head &lt;one&gt;</h1><p>First\n  <b>bold</b>text<br>more<p>Second &#233;&nbsp;x</p>"
    "<aside>side</aside><div class=\"user-comments\"><p>said</p></div><form><input value='>'>send</form></article>"
    "<footer>&copy; foot</footer></body></html>"
)


def test_markup_settles(spark):
    pages = spark.createDataFrame(
        [(1, "http://a.b/1", PAGE), (2, None, None), (3, "http://a.b/3", ""), (3, "http://a.b/3", ""), (None, "x", "<article>cut &am")],
        "page_id long, url string, html string",
    ).selectExpr("*", "'z' AS text", "'h' AS host", "1 AS page")
    out = Counter((r["page_id"], r["text"], r["n_chars"]) for r in extraction.extract_main_text(pages).collect())
    text = "Head <one>\nFirst boldtext more\nSecond é x"
    assert out == Counter({(1, text, len(text)): 1, (2, "", 0): 1, (3, "", 0): 2, (None, "cut &am", 7): 1})


def test_repeated_runs_go_unless_settled(spark):
    rng = random.Random(7)
    made, want = [], {}
    banner = " ".join(f"b{i}" for i in range(12))
    story = " ".join(f"s{i}" for i in range(30))
    for i in range(40):
        body = " ".join(f"w{rng.randrange(10**6)}" for _ in range(rng.randint(3, 40)))
        if i % 4 == 0:
            made.append((i, f"http://h.com/{i}", f"<div>{banner}</div><article><p>{story}</p></article>"))
            want[i] = story
        elif i == 5:
            made.append((i, "http://other.com/", f"<div>{banner}</div><p>{body}</p>"))
            want[i] = f"{banner}\n{body}"
        else:
            made.append((i, f"http://h.com/{i}", f"<div>{banner}</div><p>{body}</p><span>x{i}</span>"))
            want[i] = f"{body}\nx{i}"
    pages = spark.createDataFrame(made, "page_id long, url string, html string").repartition(6)
    assert {r["page_id"]: r["text"] for r in extraction.extract_main_text(pages).collect()} == want
    assert extraction.extract_main_text(pages.limit(0)).count() == 0


def test_given_pages(spark):
    """The pages at hand, by cutting out their article with plain string work."""
    import re

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    out = {r["page_id"]: r["text"] for r in extraction.extract_main_text(pages).collect()}
    for r in pages.collect():
        article = r["html"].partition("<article>")[2].partition("</article>")[0]
        parts = (re.sub("<[^>]*>", "", p.replace("<br>", " ")) for p in re.split("</?(?:p|h1)>", article))
        blocks = (" ".join(html.unescape(p).split()) for p in parts)
        assert out[r["page_id"]] == "\n".join(b for b in blocks if b)


# Pipeline


def test_pipeline(spark, tmp_path):
    """Each stage on its predecessor's rows, against brute force; the mix against its own counts."""
    folder = str(tmp_path)
    items = [(1, " ".join((ROWS[7][1] or "x").split()[:30])), (2, "no such words here at all")]
    spark.createDataFrame(ROWS, cases.SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    columns = frame.columns
    steps = {}
    for name, stage in corpus_pipeline.STAGES:
        frame = spark.createDataFrame(stage(spark, frame, folder).collect(), stage(spark, frame, folder).schema)
        steps[name] = [tuple(r) for r in frame.collect()]
        assert frame.columns[: len(columns) - 1] == columns[: len(columns) - 1] or name.startswith("mixing")
    assert list(steps) == list(stages)
    first, second, third, fourth, last = steps.values()
    assert {r[0] for r in first} >= {r[0] for r in ROWS if r[1] and len(r[1]) > 100}
    assert Counter((r[0]) for r in second) == Counter({w[1] for w in cases.exact(first)})
    groups = cases.jaccard(second, size=5, percent=80)
    assert {r[0] for r in third} == {g[2] for g in groups}
    bad = {w[0] for w in cases.contamination(third, items) if w[-1]}
    assert {r[0] for r in fourth} == {r[0] for r in third} - bad and bad
    assert {r[0] for r in last} <= {r[0] for r in fourth}
    ran = corpus_pipeline.run(spark, folder)
    assert Counter(r["doc_id"] for r in ran.collect()) == Counter(r[0] for r in last)
