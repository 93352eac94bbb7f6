"""Kept sketches, compressed bitmaps, Bloom filters and user accumulators against exact answers."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tideline.operators import accumulators as A
from tideline.operators import bitmaps as B
from tideline.operators import bloom, sketches


def visits(n=30_000, seed=3):
    """(day, channel, id): a third of all rows in one channel, some rows without an id."""
    rng = random.Random(seed)
    return [
        (rng.randrange(4), rng.choice(["app", "app", "web", None]), rng.choice([rng.randrange(9000), rng.randrange(9000), None]))
        for _ in range(n)
    ]


@pytest.fixture(scope="module")
def rows():
    return visits()


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, "day int, channel string, id long").repartition(6)


# Sketches


def test_sketches_are_kept_and_united(spark, frame, rows, tmp_path):
    path = f"{tmp_path}/daily"
    daily = sketches.sketched(frame, "day", ["channel"], "id")
    sketches.store_days(daily, path, "day")
    sketches.store_days(daily.where("day = 2"), path, "day")  # a day stored again replaces itself
    kept = spark.read.parquet(path)
    assert kept.count() == len({(d, c) for d, c, _ in rows})
    for days in ([0], [1, 3], [0, 1, 2, 3]):
        got = {r["channel"]: r["n"] for r in sketches.united(kept.where(F.col("day").isin(days)), ["channel"])
               .select("channel", sketches.estimate().alias("n")).collect()}
        for channel in ("app", "web", None):
            exact = len({i for d, c, i in rows if c == channel and d in days and i is not None})
            assert abs(got[channel] - exact) <= 4 * sketches.standard_error() * exact
    once, twice = sketches.united(kept, []), sketches.united(kept.unionByName(kept), [])
    n = [f.select(sketches.estimate().alias("n")).first()["n"] for f in (once, twice)]
    assert n[0] == n[1]


def test_common_estimate(frame, rows):
    got = {r["channel"]: r["common"] for r in sketches.common_estimate(frame, ["channel"], F.col("day") == 0, F.col("day") == 1, "id").collect()}
    for channel in ("app", "web", None):
        sides = [{i for d, c, i in rows if c == channel and d == day and i is not None} for day in (0, 1)]
        assert abs(got[channel] - len(sides[0] & sides[1])) <= 0.04 * len(sides[0] | sides[1])


# Bitmaps

WIDE = [(k, i) for k, numbers in {
    "sparse": [n * 2**47 - 2**62 for n in range(300)],
    "dense": [2**40 + n for n in range(0, 200_000, 3)],
    "runs": [*range(-70_000, 70_000), 2**63 - 1, -(2**63)],
    None: [5, 5, 7],
}.items() for i in numbers]


def test_encodings():
    rng = np.random.default_rng(1)
    cases = [np.arange(0), np.arange(65_536), np.array([0]), np.array([65_535]), np.arange(5, 9000)]
    cases += [np.sort(rng.choice(65_536, n, replace=False)) for n in (3, 4000, 5000, 60_000)]
    forms = set()
    for places in cases:
        form, data = B.encoded(places)
        forms.add(form)
        assert (B.decoded(form, data) == places).all() and len(data) <= 8192
        asked = rng.integers(0, 65_536, 500)
        if len(places):
            assert (B.contains(form, data, asked) == np.isin(asked, places)).all()
    assert forms == {B.ARRAY, B.BITMAP, B.RUNS}


def test_bitmaps_of_wide_ids(spark):
    rows = spark.createDataFrame([*WIDE, *WIDE[:500], ("none", None)], "k string, id long").repartition(5)
    sets = B.build(rows, ["k"], "id")
    want = defaultdict(set)
    for k, i in WIDE:
        want[k].add(i)
    assert {r["k"]: r["n"] for r in B.count(sets, ["k"]).collect()} == {k: len(s) for k, s in want.items()}
    size = {r["k"]: r["bytes"] for r in sets.groupBy("k").agg(F.sum(F.length("data")).alias("bytes")).collect()}
    assert size["sparse"] == 2 * 300 and size["runs"] < 40 and size["dense"] <= 2 * 66_667
    asked = spark.createDataFrame([(k, i + d) for k, i in WIDE[::97] for d in (0, 1) if i + d < 2**63] + [("none", 3), (None, None)], "k string, id long")
    for r in B.with_membership(asked, sets, ["k"], "id", "there").collect():
        assert r["there"] == (r["id"] in want[r["k"]])
    everything = B.united(sets, [])
    assert B.count(everything, []).first()["n"] == len(set().union(*want.values()))
    assert B.count(B.united(everything.unionByName(everything), []), []).first()["n"] == B.count(everything, []).first()["n"]


def test_common_bitmaps(spark, frame, rows):
    a, b = (B.build(frame.where(F.col("day") == day), ["channel"], "id") for day in (0, 1))
    got = {r["channel"]: r["n"] for r in B.count(B.common(a, b, ["channel"]), ["channel"]).collect()}
    side = lambda day, c: {i for d, x, i in rows if d == day and x == c and i is not None}
    assert got == {c: len(side(0, c) & side(1, c)) for c in ("app", "web", None)}
    assert B.build(frame.where("false"), ["channel"], "id").count() == 0


# Bloom filters


@pytest.mark.parametrize("error", [0.2, 0.01])
def test_bloom(spark, error):
    known = spark.range(0, 60_000, 3).withColumn("day", (F.col("id") % 5).cast("int")).repartition(4)
    sizing = bloom.Sizing.of(20_000, error)
    daily = bloom.build(known, ["day"], ["id"], sizing)
    assert daily.count() <= 5 * sizing.shards
    filters = bloom.united(daily)
    size = filters.agg(F.sum(F.length("bits"))).first()[0]
    assert size == sizing.bytes() and size < 20_000 * 3
    asked = spark.range(60_000).repartition(5)
    marked = bloom.with_maybe_seen(asked, filters, ["id"], sizing, "maybe")
    assert marked.count() == 60_000 and marked.where("id % 3 = 0 AND NOT maybe").count() == 0
    wrong = marked.where("id % 3 <> 0 AND maybe").count() / 40_000
    assert wrong <= 1.5 * error
    new = bloom.unseen(asked, filters, known, ["id"], sizing)
    assert new.count() == 40_000 and new.where("id % 3 = 0").count() == 0
    assert bloom.unseen(asked, bloom.united(daily.where("false")), known.where("false"), ["id"], sizing).count() == 60_000


# Accumulators


def test_accumulators(frame, rows):
    for held in (1, 20_000):
        got = A.accumulate(frame, ["day", "channel"], A.Average("id"), ["id"], held=held, parts=3).collect()
        assert len(got) == len({r[:2] for r in rows})
        for r in got:
            ids = [i for d, c, i in rows if (d, c) == (r["day"], r["channel"]) and i is not None]
            assert (r["total"], r["n"], r["average"]) == (sum(ids), len(ids), sum(ids) / len(ids))
    counted = A.accumulate(frame, [], A.CountPerItem("channel"), ["channel"]).first()["counts"]
    tally = Counter(c for _, c, _ in rows if c)
    assert counted == ",".join(f"{c}={tally[c]}" for c in sorted(tally))
    assert A.accumulate(frame.where("false"), ["day"], A.Average("id"), ["id"]).count() == 0


class Longest(A.Accumulator):
    """The longest text and whether any was missing."""

    state = output = "longest STRING, missing BOOLEAN"

    def create(self):
        return None, False

    def add(self, state, rows):
        texts = [t for t in rows["t"] if t is not None]
        return self.merge(state, (max(texts, key=lambda t: (len(t), t), default=None), len(texts) < len(rows)))

    def merge(self, a, b):
        found = [x for x in (a[0], b[0]) if x is not None]
        return max(found, key=lambda t: (len(t), t), default=None), a[1] or b[1]

    def result(self, state):
        return state


def test_a_users_own_accumulator_on_a_hot_key(spark):
    rows = [(1, "x" * (i % 50)) for i in range(3000)] + [(2, None), (None, "abc")]
    frame = spark.createDataFrame(rows, "k int, t string").repartition(9)
    got = {r["k"]: (r["longest"], r["missing"]) for r in A.accumulate(frame, ["k"], Longest(), ["t"], parts=4).collect()}
    assert got == {1: ("x" * 49, False), 2: (None, True), None: ("abc", False)}


def test_group_functions(spark):
    left = spark.createDataFrame([(k, t, f"l{t}") for k in (1, 2, None) for t in range(0, 10, 2)], "k int, t int, a string")
    right = spark.createDataFrame([(k, t, t * 10) for k in (1, 3) for t in range(0, 9, 3)], "k int, t int, b int")

    def newest(key, rows):
        seen = None
        for row in rows:
            if row["side"] == "right":
                seen = row["b"]
            else:
                yield row["t"], seen

    got = A.co_group(left.repartition(4), right.repartition(3), ["k"], ["t"], newest, "t int, seen int").collect()
    want = [(k, t, max((u * 10 for u in range(0, 9, 3) if u < t), default=None) if k == 1 else None)
            for k in (1, 2, None) for t in range(0, 10, 2)]
    assert Counter(map(tuple, got)) == Counter(want)

    def first_two(key, rows):
        yield (",".join(row["a"] for _, row in zip(range(2), rows)),)

    pairs = A.process_groups(left.repartition(4), ["k"], ["t"], first_two, "pair string").collect()
    assert Counter(map(tuple, pairs)) == Counter((k, "l0,l2") for k in (1, 2, None))
