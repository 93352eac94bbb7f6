"""Ordered scans must not depend on where a key is cut."""

import random

import pytest
from pyspark.sql import functions as F

from tideline.operators import ordered as O
from tideline.operators import rows as rows_module

ORDER = ["t", "id"]


def make_rows(seed):
    # Key 1 holds most rows, key 3 sits in one instant, some values are missing.
    rng = random.Random(seed)
    rows = []
    for i in range(400):
        key = 1 if i % 3 else rng.randint(2, 9)
        time = 1000 if key == 3 else rng.randint(0, 3000)
        rows.append((key, time, i, rng.choice([None, 1, 2, 5]), rng.choice("abc")))
    return rows


@pytest.fixture(scope="module", params=[1, 2])
def rows(request):
    return make_rows(request.param)


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, "k long, t long, id long, v long, s string").cache()


def by_key(rows, keyed):
    groups = {}
    for r in sorted(rows, key=lambda r: (r[1], r[2])):
        groups.setdefault(r[0] if keyed else 0, []).append(r)
    return groups.values()


@pytest.mark.parametrize("keyed", [True, False])
@pytest.mark.parametrize("max_rows", [3, 40, 10_000])
def test_scan_equals_brute_force(frame, rows, keyed, max_rows):
    cut = O.ordered(frame, ["k"] if keyed else [], ORDER, max_rows)
    got = {
        r["id"]: tuple(r)[1:]
        for r in cut.scan(
            O.running_count("cnt"),
            O.running_count("before", F.col("s") == "a", inclusive=False),
            O.running_sum("total", F.col("v")),
            O.running_max("top", F.struct("v", "id")),
            O.running_last("last", F.col("v")),
            O.previous_value("prev", F.col("id")),
            O.next_value("next", F.col("id")),
        )
        .rows()
        .select("id", "cnt", "before", "total", "top.v", "last", "prev", "next")
        .collect()
    }
    want = {}
    for group in by_key(rows, keyed):
        for i, r in enumerate(group):
            seen = group[: i + 1]
            values = [x[3] for x in seen if x[3] is not None]
            want[r[2]] = (
                i + 1,
                sum(x[4] == "a" for x in group[:i]),
                sum(values),
                max(values) if values else None,
                values[-1] if values else None,
                group[i - 1][2] if i else None,
                group[i + 1][2] if i + 1 < len(group) else None,
            )
    assert got == want


@pytest.mark.parametrize("keyed", [True, False])
@pytest.mark.parametrize("max_rows", [3, 40, 10_000])
def test_row_frames_equal_brute_force(frame, rows, keyed, max_rows):
    framed = O.row_frames(
        frame, ["k"] if keyed else [], ORDER, 4, lambda w: {"ids": F.collect_list("id").over(w)}, max_rows
    )
    got = {r["id"]: list(r["ids"]) for r in framed.select("id", "ids").collect()}
    want = {}
    for group in by_key(rows, keyed):
        ids = [r[2] for r in group]
        want.update({x: ids[max(0, i - 4) : i + 1] for i, x in enumerate(ids)})
    assert got == want


@pytest.mark.parametrize("max_rows", [3, 40, 10_000])
def test_range_sums_equal_brute_force(frame, rows, max_rows):
    framed = O.range_sums(frame, ["k"], ORDER, 200, {"n": F.lit(1), "total": F.col("v")}, max_rows)
    got = {r["id"]: (r["n"], r["total"]) for r in framed.select("id", "n", "total").collect()}
    want = {}
    for r in rows:
        near = [x for x in rows if x[0] == r[0] and r[1] - 200 <= x[1] <= r[1]]
        want[r[2]] = (len(near), sum(x[3] or 0 for x in near))
    assert got == want


def test_no_slice_is_large(spark):
    """An outlier in time, a burst, rows of one instant and rows without a time all stay bounded."""
    made = [(1, 5_000_000 + i * 40, i) for i in range(3000)] + [(1, 10**15, 3000)]
    made += [(2, 70_000 + i % 7, 4000 + i) for i in range(2000)] + [(3, 1, 7000 + i) for i in range(2500)]
    made += [(4, None, 10_000 + i) for i in range(900)] + [(4, i * 10**6, 11_000 + i) for i in range(900)]
    frame = spark.createDataFrame(made, "k long, t long, id long")
    cut = O.ordered(frame, ["k"], ORDER, 100)
    assert cut.frame.groupBy("k", O._SLICE).count().agg(F.max("count")).first()[0] <= 200
    got = {r["id"]: r["at"] for r in cut.scan(O.running_count("at")).rows().collect()}
    for key in range(1, 5):
        ids = sorted((r for r in made if r[0] == key), key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        assert [got[r[2]] for r in ids] == list(range(1, len(ids) + 1))


def test_preparing_runs_no_job(spark, frame):
    frame.count()
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "")
    O.ordered(frame, ["k"], ORDER).scan(O.running_count("a")).scan(O.running_count("b")).rows()
    O.row_frames(frame, ["k"], ORDER, 2, lambda w: {"n": F.count("id").over(w)})
    O.range_sums(frame, ["k"], ORDER, 200, {"n": F.lit(1)})
    jobs = tracker.getJobIdsForGroup("building")
    spark.sparkContext.setJobGroup("", "")
    assert not list(jobs)


@pytest.mark.parametrize("max_rows", [7, 10_000])
def test_counting_first_changes_no_result_and_keeps_nothing(spark, frame, max_rows):
    frame.count()  # the rows themselves are kept by the tests
    before = len(spark.sparkContext._jsc.getPersistentRDDs())

    def results(counted):
        whole = O.ordered(frame, ["k"], ORDER, max_rows, counted=counted, keep=counted)
        scanned = whole.scan(O.running_count("a"), O.running_sum("s", F.col("v"))).scan(
            O.running_last("l", F.col("v"), inclusive=False), O.next_value("n", F.col("t")), O.running_max("m", F.col("v"))
        )
        framed = O.row_frames(frame, ["k"], ORDER, 2, lambda w: {"n": F.sum("id").over(w)}, max_rows, counted=counted)
        ranged = O.range_sums(frame, ["k"], ORDER, 200, {"n": F.col("v")}, max_rows, counted=counted)
        return [sorted(map(str, f.collect())) for f in (scanned.rows(), framed, ranged)]

    counted = results(True)
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) == before
    assert counted == results(False)


@pytest.mark.parametrize("max_rows", [7, 10_000])
def test_counted_rows_are_dealt_by_their_number(frame, monkeypatch, capsys, max_rows):
    """400 rows, ten to a task, whatever the number of cores and the size of shuffle files."""
    monkeypatch.setattr(rows_module, "ROWS_PER_TASK", 10)
    whole = O.ordered(frame, ["k"], ORDER, max_rows, counted=True)
    scanned = whole.scan(O.running_count("a")).by("k", "s").scan(O.running_count("b")).rows()
    framed = O.row_frames(frame, ["k"], ORDER, 2, lambda w: {"n": F.sum("id").over(w)}, 10_000, counted=True)
    goes_on = whole.scan(O.running_count("a"), since=O.totals(frame, ["k"], ORDER, [O.running_count("a")])).rows()
    for result, times in ((scanned, 1), (framed, 1), (goes_on, 1)):
        capsys.readouterr()
        result.explain()
        assert capsys.readouterr().out.count(", 40), REPARTITION_BY_NUM") == times


@pytest.mark.parametrize("keyed", [True, False])
def test_scan_goes_on_from_earlier_totals(frame, keyed):
    keys = ["k"] if keyed else []
    running = lambda: [O.running_count("cnt"), O.running_sum("total", F.col("v")), O.running_last("last", F.col("v"))]
    early, late = frame.where("t < 1200"), frame.where("t >= 1200")
    reached = O.totals(early, keys, ORDER, running())
    first = O.ordered(early, keys, ORDER, 20).scan(*running()).rows()
    second = O.ordered(late, keys, ORDER, 20).scan(*running(), since=reached).rows()
    whole = O.ordered(frame, keys, ORDER, 10_000).scan(*running()).rows()
    columns = ["id", "cnt", "total", "last"]
    assert sorted(first.unionByName(second).select(columns).collect()) == sorted(whole.select(columns).collect())
    final = O.totals(late, keys, ORDER, running(), reached)
    straight = O.totals(frame, keys, ORDER, running())
    order = lambda d: sorted(map(str, d.select(*keys, "cnt", "total", "last").collect()))
    assert order(final) == order(straight)
