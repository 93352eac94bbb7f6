"""Substring, line, exact and n-gram dedup and decontamination against brute force on awkward documents."""

from collections import Counter

import pytest

from tests.llm import cases
from tideline.llm import automaton, decontamination, exact, jaccard, language, lines, substrings

ROWS = cases.make_documents()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, cases.SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], cases.SCHEMA)


def rows(frame, *columns):
    return Counter(tuple(r) for r in frame.select(*columns).collect())


SPAN_COLUMNS = ("doc_id", "n_words", "n_removed", "kept_sha256")


@pytest.mark.parametrize("window", [50, 7])
def test_substrings(docs, window):
    got = rows(substrings.dedup_substrings(docs, window=window, landmark=window // 2, with_text=False), *SPAN_COLUMNS)
    assert got == Counter(cases.substrings(ROWS, window))


def test_substrings_with_text_and_small_shards(docs, monkeypatch):
    for name, value in (("SHARD_WORDS", 200), ("HOME_WORDS", 64), ("PROBES_PER_TASK", 8)):
        monkeypatch.setattr(substrings, name, value)
    out = substrings.dedup_substrings(docs, window=12, landmark=6)
    assert rows(out, *SPAN_COLUMNS) == Counter(cases.substrings(ROWS, 12))
    assert all(cases.sha(r["text"]) == r["kept_sha256"] for r in out.collect())


def test_automaton_knows_the_first_document():
    import random

    rng = random.Random(3)
    for _ in range(30):
        texts = [[rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(1, 40))] for _ in range(6)]
        machine = automaton.SuffixAutomaton()
        for doc, words in enumerate(texts):
            machine.add(words, doc)
        for doc, words in enumerate(texts):
            for least in (1, 2, 5):
                want = [
                    i
                    for i in range(len(words) - least + 1)
                    if any(
                        words[i : i + least] == other[j : j + least]
                        for other in texts[:doc]
                        for j in range(len(other) - least + 1)
                    )
                ]
                assert machine.repeats(words, doc, least) == want


def test_lines(docs, monkeypatch):
    columns = ("doc_id", "n_lines", "n_dropped", "kept_sha256")
    assert rows(lines.dedup_lines(docs), *columns) == Counter(cases.lines(ROWS))
    monkeypatch.setattr(lines, "KEYS_PER_SHARD", 2)
    monkeypatch.setattr(lines, "PROBES_PER_TASK", 3)
    assert rows(lines.dedup_lines(docs, with_text=False), *columns) == Counter(cases.lines(ROWS))


def test_perfect_hash():
    import numpy as np

    keys = np.random.default_rng(1).integers(0, 1 << 63, 5000).astype(np.uint64)
    table = lines.PerfectHash.unpacked(lines.PerfectHash.build(keys).packed())
    assert sorted(table.numbers(keys).tolist()) == list(range(len(keys)))
    assert lines.PerfectHash.build(keys[:0]).numbers(keys[:3]).tolist() == [-1, -1, -1]


@pytest.mark.parametrize("fan_in", [2, 16])
def test_exact(docs, fan_in):
    out = exact.exact_groups(docs, fan_in=fan_in)
    assert rows(out, "id", "keep_id", "group_size", "digest") == Counter(cases.exact(ROWS))
    kept = [r for r in out.collect() if r["kept"]]
    assert len(kept) == len({r["digest"] for r in kept}) and all(r["id"] == r["keep_id"] for r in kept)


def test_without_copies(docs):
    left = exact.without_copies(docs)
    assert left.columns == docs.columns
    want = {(w[1], w[3]) for w in cases.exact(ROWS)}
    assert left.count() == len(want)


def test_without_copies_keeps_the_longest_of_one_id(spark):
    rows = spark.createDataFrame([(1, "a b", 1), (1, "a      b", 2), (2, "a b", 3), (None, "x", 4), (None, "x ", 5)], "doc_id long, text string, n long")
    assert {r["n"] for r in exact.without_copies(rows).collect()} == {2, 5}


def test_columns_of_any_name_come_through(spark):
    """Columns named like those the helpers use themselves keep their values."""
    names = ["row", "id", "key", "digest", "text_", "__key", "__id", "__digest", "__text", "blank", "host", "n_chars", "component"]
    text = " ".join(f"w{i}" for i in range(40))
    made = [(i, f"{text} {i}" if i else None, "en", "s", *[f"{n}{i}" for n in names]) for i in range(4)]
    docs = spark.createDataFrame(made, f"doc_id long, text string, lang string, source string, {', '.join(f'`{n}` string' for n in names)}")
    items = spark.createDataFrame([(1, "none of these words here")], "item_id long, text string")
    for left in (
        exact.without_copies(docs),
        jaccard.one_of_each_group(docs),
        decontamination.without_contaminated(docs, items),
        language.in_known_language(docs),
    ):
        assert left.columns == docs.columns
        assert {tuple(r) for r in left.collect()} <= set(made) and left.count()


ITEMS = [
    (1, " ".join(ROWS[7][1].split()[:20]) if ROWS[7][1] else "x"),
    (12, "one"),
    (2, None),
    (3, ""),
    (4, "Shared LINE number-one, all rights"),
    (4, "a, b. c"),
    (None, "a b"),
    (30, " ".join((ROWS[11][1] or "y z").split())),
]


def test_contamination(spark, docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    columns = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    want = cases.contamination(ROWS, ITEMS)
    assert rows(decontamination.contamination(docs, items), *columns) == Counter(want)
    left = decontamination.without_contaminated(docs, items)
    assert left.columns == docs.columns
    assert rows(left, "doc_id") == Counter((w[0],) for w in want if not w[-1])


def test_contamination_in_blocks(spark, docs, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK_WORDS", 10)
    monkeypatch.setattr(decontamination, "SEGMENT_BYTES", 2000)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = rows(decontamination.contamination(docs, items), "doc_id", "n_hit", "n_items")
    assert got == Counter((w[0], w[2], w[3]) for w in cases.contamination(ROWS, ITEMS))


def test_proximity(spark):
    words = [f"w{i}" for i in range(40)]
    near = words[:5] + ["extra"] + words[5:13]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(near)), (3, "w1 w2")], "doc_id long, text string")
    index = decontamination.build_index(docs)
    items = spark.createDataFrame([(9, " ".join(words[:13]))], "item_id long, text string")
    (phrases,) = decontamination.item_blocks(items, "item_id", "text", 13)
    ids = {r["row"]: r["id"] for r in decontamination.document_rows(index).collect()}
    found = {(ids[r["row"]], r["exact"]) for r in decontamination.search(index, phrases, slop=2).collect()}
    assert found == {(1, True), (2, False)}


@pytest.mark.parametrize("percent", [85, 60])
def test_jaccard(docs, percent):
    got = rows(jaccard.jaccard_components(docs, percent=percent), "doc_id", "n_shingles", "component_id")
    assert got == Counter(cases.jaccard(ROWS, percent=percent))


def test_jaccard_in_small_blocks(spark, monkeypatch):
    import random

    monkeypatch.setattr(jaccard, "BLOCK", 4)
    rng = random.Random(8)
    base = [f"t{rng.randrange(10**6)}" for _ in range(120)]
    made = []
    for i in range(80):
        words = list(base)
        for _ in range(rng.randint(0, 9)):
            words[rng.randrange(len(words))] = f"n{rng.randrange(10**6)}"
        made.append((i, " ".join(words)))
    docs = spark.createDataFrame(made, "doc_id long, text string").repartition(4)
    got = rows(jaccard.jaccard_components(docs), "doc_id", "n_shingles", "component_id")
    assert got == Counter(cases.jaccard(made))


def test_bands_of_similar_sets_meet():
    for percent in (85, 60):
        for small in range(1, 400):
            for large in range(small, small * 100 // percent + 1):
                if jaccard.allowed(small, percent) == 0:
                    continue
                theirs = {b.number for b in jaccard.Band.of(large, percent)}
                assert jaccard.Band.of(small, percent)[0].number in theirs


def test_one_of_each_group(docs):
    left = jaccard.one_of_each_group(docs)
    assert left.columns == docs.columns
    want = cases.jaccard(ROWS)
    blank = [w for w in want if w[1] == 0]
    assert left.count() == len(blank) + len({w[2] for w in want if w[1]})


def test_one_of_each_group_by_component_not_by_id(spark):
    """Texts that share a null id, or one number, stay if their components differ; copies go."""
    import random

    rng = random.Random(13)
    texts = [" ".join(f"t{rng.randrange(10**6)}" for _ in range(60)) for _ in range(6)]
    near = texts[0].replace(texts[0].split()[30], "other")
    made = [(None, t) for t in texts[:3]] + [(5, t) for t in texts[3:]] + [(None, near), (9, texts[3] + " more"), (7, texts[5]), (5, texts[4])]
    made += [(None, "one"), (None, "two"), (None, "ONE"), (None, None), (None, None)]
    docs = spark.createDataFrame(made, "doc_id long, text string").repartition(4)
    left = [tuple(r) for r in jaccard.one_of_each_group(docs).collect()]
    kept = Counter(i for i, _ in left)
    assert kept == Counter({None: 3 + 2 + 2, 5: 3})
    assert {t for i, t in left if i == 5} == set(texts[3:]) and {t for i, t in left if i is None} >= set(texts[1:3])
    assert len({t for _, t in left} & {texts[0], near}) == 1 and len({t for _, t in left} & {"one", "ONE"}) == 1


def test_empty_tables(spark, none):
    items = spark.createDataFrame([], "item_id long, text string")
    for out in (
        substrings.dedup_substrings(none),
        lines.dedup_lines(none),
        exact.exact_groups(none),
        exact.without_copies(none),
        decontamination.contamination(none, items),
        jaccard.jaccard_components(none),
        jaccard.one_of_each_group(none),
    ):
        assert out.count() == 0


def test_no_items(spark, docs):
    items = spark.createDataFrame([], "item_id long, text string")
    out = decontamination.contamination(docs, items)
    assert out.count() == len(ROWS) and out.where("contaminated OR n_hit > 0").count() == 0
