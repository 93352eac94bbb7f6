"""The warehouse jobs on small fixtures, with keys cut and not cut."""

import random

import pytest
from pyspark.sql import functions as F

from tideline.operators import rows as rows_module
from tideline.plans import identity as I
from tideline.plans import traffic as V
from tideline.queries import QUERIES
from tideline.session import scratch_folder

CUTS = pytest.mark.parametrize("max_rows", [6, 10_000])


def identity_rows(seed):
    rng = random.Random(seed)
    rows = []
    for i in range(240):
        device = "d1" if i % 3 else rng.choice(["d2", "d3", "d4"])
        account = "" if device == "d4" else rng.choice(["", "", "a", "b", "c", "stranger"])
        rows.append((i, device, account, rng.randint(1_700_000_000_000, 1_700_000_000_500)))
    return rows


def walk(rows, members):
    """The rule stated as a loop over each device's rows."""
    weights, temp, out, firsts = {}, {}, {}, []
    for i, device, account, t in sorted(rows, key=lambda r: (r[3], r[0])):
        if account in members:
            bound = weights.setdefault(device, {})
            for other in bound:
                if other != account:
                    bound[other] -= 1
            bound[account] = bound.get(account, 0) + 1
            out[i] = (members[account][0], account)
            continue
        best = sorted((-w, a) for a, w in weights.get(device, {}).items() if w > 0)
        if device in temp or not best:
            if device not in temp:
                temp[device] = t
                firsts.append((t, device))
            out[i] = (device, account)
        else:
            out[i] = (members[best[0][1]][0], best[0][1])
    ids = {d: I.TEMP_ID_BASE + n for n, (_, d) in enumerate(sorted(firsts), 1)}
    return {i: (ids.get(g, g), a) for i, (g, a) in out.items()}, weights


@CUTS
@pytest.mark.parametrize("seed", [1, 2])
def test_identity(spark, seed, max_rows):
    rows = identity_rows(seed)
    members = {"a": (1, 11), "b": (2, 22), "c": (3, 33)}
    logs = spark.createDataFrame(rows, "log_id long, deviceid string, account string, timestamp long")
    people = spark.createDataFrame([(i, a, t) for a, (i, t) in members.items()], "id long, account string, create_time long")
    want, weights = walk(rows, members)
    mapped = I.map_identity(logs, people, max_rows=max_rows).collect()
    assert {r["log_id"]: (r["guid"], r["account"]) for r in mapped} == want
    times = {r["log_id"]: (r["register_time"], r["first_access_time"]) for r in mapped}
    assert all((a is None) != (b is None) for a, b in times.values())
    bound = I.device_bindings(logs, people, max_rows).collect()
    assert {(r["deviceid"], r["account"]): r["weight"] for r in bound} == {
        (d, a): w for d, accounts in weights.items() for a, w in accounts.items()
    }


def test_identity_over_several_runs(spark):
    rows = identity_rows(3)
    members = {"a": (1, 11), "b": (2, 22), "c": (3, 33)}
    logs = spark.createDataFrame(rows, "log_id long, deviceid string, account string, timestamp long")
    people = spark.createDataFrame([(i, a, t) for a, (i, t) in members.items()], "id long, account string, create_time long")
    times = sorted({r[3] for r in rows})
    cuts = [times[len(times) // 3], times[2 * len(times) // 3]]
    got, state = {}, None
    for low, high in zip([0, *cuts], [*cuts, 1 << 60]):
        part = logs.where((F.col("timestamp") >= low) & (F.col("timestamp") < high))
        mapped, state = I.continue_identity(part, people, state, max_rows=20)
        state = state.written()
        got |= {r["log_id"]: (r["guid"], r["account"]) for r in mapped.collect()}
    assert got == walk(rows, members)[0]


def test_state_of_identity_is_taken_from_written_rows(spark):
    """The totals for the next run read what the run has written, not the log and its scans once more for each."""
    path = scratch_folder(spark, "log")
    logs = spark.createDataFrame(identity_rows(4), "log_id long, deviceid string, account string, timestamp long")
    logs.write.parquet(path)
    people = spark.createDataFrame([(1, "a", 11)], "id long, account string, create_time long")
    mapped, state = I.continue_identity(spark.read.parquet(path), people)
    for frame in (mapped, state.events, state.accounts, state.best, state.temporary):
        assert frame.inputFiles() and not [f for f in frame.inputFiles() if path.removeprefix("file:") in f]


@CUTS
def test_temporary_ids_go_on(spark, max_rows):
    visits = spark.createDataFrame([(f"d{i}", 100 - i) for i in range(20)], "deviceid string, first_time long")
    first = I.temporary_ids(visits.where("first_time > 90"), max_rows=max_rows)
    both = {r["deviceid"]: r["guid"] for r in I.temporary_ids(visits, first, max_rows).collect()}
    before = {r["deviceid"]: r["guid"] for r in first.collect()}
    assert all(both[d] == g for d, g in before.items())
    assert sorted(both.values()) == list(range(I.TEMP_ID_BASE + 1, I.TEMP_ID_BASE + 21))


SECOND = 1000
DIMS = "province string, city string, region string, devicetype string, is_new int, releasechannel string"
SCHEMA = f"log_id long, guid long, sessionid string, eventid string, timestamp long, properties map<string,string>, {DIMS}"


def visit(events, guid=1, start=0):
    place = ("p", "c", "r", "phone", 1, "ch")
    return [
        (start + i, guid, "s1", e, (i + 1) * SECOND, {"pageId": page} if page else {}, *place)
        for i, (e, page) in enumerate(events)
    ]


def test_walks_equal_brute_force(spark):
    rng = random.Random(21)
    kinds = ["applaunch", "wakeup", "pageload", "share", "putback"]
    events = [(kind, f"home/{rng.randint(1, 4)}" if kind == "pageload" else None) for kind in rng.choices(kinds, k=40)]
    rows = V.split_sessions(V.visit_rows(spark.createDataFrame(visit(events), SCHEMA))).collect()
    got = sorted((r["ts"] // SECOND, r["event_id"] != "flag", r["event_id"], r["split_session_id"], r["page_id"],
                  r["page_load_time"] // SECOND) for r in rows)
    want, page, begun, loaded = [], None, None, None
    for second, (kind, target) in enumerate(events, 1):
        if begun is None or kind in ("applaunch", "wakeup"):
            begun = loaded = second
        if kind == "pageload":
            if second > 1:
                want.append((second, False, "flag", f"s1:{begun * SECOND}", page, loaded))
            page, loaded = target, second
        want.append((second, True, kind, f"s1:{begun * SECOND}", page, loaded))
    assert [g[:5] for g in got if g[1]] == [w[:5] for w in sorted(want, key=lambda w: w[:2]) if w[1]]
    assert sum(not g[1] for g in got) <= sum(not w[1] for w in want)


def test_heartbeats_stop_at_the_next_row_and_the_cap(spark):
    place = ("p", "c", "r", "phone", 1, "ch")
    rows = [(0, 1, "s", "applaunch", 0, {}, *place), (1, 1, "s", "e", 10_000, {}, *place), (2, 1, "s", "putback", 90_000, {}, *place)]
    out = V.heartbeats(V.visit_rows(spark.createDataFrame(rows, SCHEMA)), 5000, 60_000).collect()
    # None at 10 s, where the next row is; twelve after it; none after going to the background.
    assert sorted(r["ts"] for r in out) == [5000, *range(15_000, 70_001, 5000)]


@CUTS
def test_cut_visits_equal_whole_ones(spark, max_rows):
    rng = random.Random(5)
    names = ["applaunch", "wakeup", "pageload", "e1", "putback"]
    rows = []
    for guid in (1, 2, 3):
        events = [(rng.choice(names), f"pg{rng.randint(1, 5)}") for _ in range(60 if guid == 1 else 8)]
        rows += visit(events, guid, guid * 1000)
    frame = spark.createDataFrame(rows, SCHEMA)
    whole = V.traffic(frame, 300, 900)
    cut = V.traffic(frame, 300, 900, max_rows)
    assert sorted(map(str, cut.collect())) == sorted(map(str, whole.collect()))
    report = V.traffic_report(V.session_summary(cut)).where("gid = 63").first()
    assert report["uv"] == 3 and report["pv"] == sum(r[3] == "pageload" for r in rows)


def test_retention_counts_rows_and_people(spark):
    day = 86_400_000
    today = 1705276800000
    rows = [("app", "phone", 1, today + 5, today - day), ("app", "phone", 1, today + 9, today - day),
            ("app", "phone", 2, today + 9, today - 3 * day), ("app", "phone", 3, today - 5, today - day)]
    frame = spark.createDataFrame(rows, "releasechannel string, devicetype string, guid long, timestamp long, first_time long")
    row = V.retention(frame, "2024-01-15").first()
    assert (row["rows_1day"], row["users_1day"], row["users_3day"], row["users_7day"]) == (2, 1, 1, 0)


@pytest.mark.parametrize(
    "name", ["topn_window_product_amount", "topn_window_product_coupon", "topn_window_product_qty", "dw_order_total_category"]
)
def test_tasks_grow_with_the_items(spark, monkeypatch, capsys, name):
    """A task gets a number of rows, whatever the number of cores and of shuffle partitions."""
    path = scratch_folder(spark, "shop")
    orders = [(i if i % 7 else None, 1, "F", 1.0, f"1996-0{i % 9 + 1}-10", "1-URGENT") for i in range(60)]
    lines = [(i % 70, i % 13 if i % 11 else None, float(i % 5), 10.0 + i, 0.01 * (i % 4)) for i in range(300)]
    parts = [(i, f"type {i % 3}") for i in [*range(12), 3]]
    made = {
        "orders": (orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate string, o_orderpriority string"),
        "lineitem": (lines, "l_orderkey long, l_partkey long, l_quantity double, l_extendedprice double, l_discount double"),
        "part": (parts, "p_partkey long, p_type string"),
    }
    for table, (rows, schema) in made.items():
        frame = spark.createDataFrame(rows, schema)
        if table == "orders":
            frame = frame.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz"))
        frame.coalesce(1).write.parquet(f"{path}/{table}.parquet")
    few = sorted(map(str, QUERIES[name](spark, path).collect()))
    monkeypatch.setattr(rows_module, "ROWS_PER_TASK", 10)
    many = QUERIES[name](spark, path)
    assert few and sorted(map(str, many.collect())) == few
    many.explain()
    # 300 items, ten to a task: the join with parts, the join with orders and, by product, the sums.
    assert capsys.readouterr().out.count(", 30), REPARTITION_BY_NUM") >= 4
    assert name == "dw_order_total_category" or len(few) > 3
