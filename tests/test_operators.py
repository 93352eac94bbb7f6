"""Operators against known answers and brute force, with keys cut and not cut."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from tideline.functions.geohash import with_geohash
from tideline.operators import aggregates as A
from tideline.operators import changes as C
from tideline.operators import joins as J
from tideline.operators import state as S
from tideline.operators import windows as W
from tideline.sources import files

ORDER = ["t", "id"]
CUTS = pytest.mark.parametrize("max_rows", [5, 10_000])


def make(seed, n=300, keys=6, span=2000):
    rng = random.Random(seed)
    rows = [
        (1 if i % 3 == 0 else rng.randint(1, keys), rng.randint(0, span), i, rng.choice("abdhx"), rng.randint(1, 9))
        for i in range(n)
    ]
    return sorted(rows, key=lambda r: (r[1], r[2]))


@pytest.fixture(scope="module")
def rows():
    return make(7)


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, "k long, t long, id long, s string, v long").cache()


def per_key(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[0], []).append(r)
    return groups


def test_geohash_of_known_places(spark):
    places = [(57.64911, 10.40744, "u4pru"), (39.92324, 116.3906, "wx4g0"), (-25.382708, -49.265506, "6gkzw"),
              (90.0, 180.0, "zzzzz"), (-90.0, -180.0, "00000"), (91.0, 0.0, ""), (None, 0.0, "")]
    frame = spark.createDataFrame(places, "lat double, lng double, want string")
    assert [r["geohash"] == r["want"] for r in with_geohash(frame, "lat", "lng").collect()] == [True] * len(places)


def test_geohash_of_eight_characters(spark):
    frame = spark.createDataFrame([(57.64911, 10.40744)], "lat double, lng double")
    assert with_geohash(frame, "lat", "lng", length=8).first()["geohash"] == "u4pruydq"


def test_growing_windows_equal_brute_force(spark):
    rng = random.Random(11)
    hour = 3_600_000
    rows = [(rng.randint(1, 12), rng.randint(0, 2 * 24 * hour - 1), rng.choice(["web", "shop"])) for _ in range(150)]
    frame = spark.createDataFrame(rows, "guid long, t long, channel string")
    out = W.cumulate(frame, F.col("t"), 24 * hour, 4 * hour, ["channel"], ("uv", "guid"))
    got = {(r["window_start"], r["window_end"], r["channel"]): r["uv"] for r in out.collect()}
    stamp = lambda ms: datetime.datetime(1970, 1, 1) + datetime.timedelta(milliseconds=ms)
    for day in (0, 1):
        for end in range(4, 25, 4):
            low, high = day * 24 * hour, day * 24 * hour + end * hour
            for channel in ("web", "shop"):
                users = {g for g, t, c in rows if c == channel and low <= t < high}
                assert got.get((stamp(low), stamp(high), channel), 0) == len(users)


def test_fixed_windows_equal_brute_force(spark):
    rng = random.Random(12)
    rows = [(rng.choice("pq"), rng.randint(-5, 40), rng.randint(0, 29_999)) for _ in range(80)]
    frame = spark.createDataFrame(rows, "id string, score int, t long").withColumn("ts", F.timestamp_millis("t"))
    out = W.tumble(frame, "ts", "7 seconds", ["id"], F.sum("score").alias("total"))
    want = {}
    for name, score, t in rows:
        want[name, t // 7000] = want.get((name, t // 7000), 0) + score
    assert sorted(r["total"] for r in out.collect()) == sorted(want.values())


def test_window_grid_offset(spark):
    frame = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-01 17:00:00' AS ts")
    out = W.tumble(frame, "ts", "1 day", [], F.count("*").alias("n"), offset="16 hours").first()
    assert str(out["window_start"]) == "2024-01-01 16:00:00"


def test_changes_of_a_count_lead_to_it(spark):
    rng = random.Random(13)
    words = [rng.choice("uvwxyz") for _ in range(60)]
    frame = spark.createDataFrame([(w, i // 3, i, 1) for i, w in enumerate(words)], "w string, t long, id long, one long")
    out = C.running_total_changes(["w"], ORDER, "one", "n").over(frame).collect()
    current = {}
    for r in sorted(out, key=lambda r: (r["id"], r["op"] != "-U")):
        if r["op"] == "-U":
            assert current.pop(r["w"]) == r["n"]
        else:
            assert (r["op"] == "+I") == (r["n"] == 1) and r["w"] not in current
            current[r["w"]] = r["n"]
    assert current == {w: words.count(w) for w in set(words)}


def test_common_numbers_of_two_bitmaps(spark):
    rng = random.Random(14)
    sides = {side: {rng.randint(0, 90_000) for _ in range(500)} | set(range(low, low + 40)) for side, low in (("l", 60), ("m", 75))}
    frame = spark.createDataFrame([(s, n) for s, numbers in sides.items() for n in numbers], "side string, n long")
    out = A.common_by_bitmap(frame, F.col("side") == "l", F.col("side") == "m", "n")
    assert out.first()["common"] == len(sides["l"] & sides["m"])


def test_null_keys_in_changes(spark):
    old = spark.createDataFrame([(None, 1), ("a", 2), ("b", 3)], "k string, v long")
    new = spark.createDataFrame([(None, 4), ("a", 2), ("c", 5)], "k string, v long")
    got = {tuple(r) for r in C.snapshot_changes(old, new, ["k"], ["v"]).select("k", "op", "v").collect()}
    assert got == {(None, "-U", 1), (None, "+U", 4), ("b", "-D", 3), ("c", "+I", 5)}


def test_as_of_join_leaves_null_keys_alone(spark):
    left = spark.createDataFrame([(None, 5, 1), (1, 5, 2)], "k long, t long, id long")
    right = spark.createDataFrame([(None, 1, 1, "x"), (1, 2, 2, "y")], "k long, vt long, vid long, name string")
    out = J.as_of_join(left, right, ["k"], ORDER, ["vt", "vid"], ["vid", "name"])
    assert {(r["id"], r["name"]) for r in out.collect()} == {(1, None), (2, "y")}


def test_a_missing_value_is_no_extreme(spark):
    frame = spark.createDataFrame([("a", None, "p"), ("a", 4, "r"), ("a", 4, "q"), ("a", 9, "s")], "k string, v long, name string")
    assert A.extreme_row(frame, ["k"], "v", "name", largest=False).first()["name"] == "q"
    assert A.extreme_row(frame, ["k"], "v", "name").first()["name"] == "s"


def test_approximate_users_are_near(spark):
    frame = spark.range(40_000).selectExpr("id % 9973 AS guid", "CAST(id % 2 AS STRING) AS channel")
    for r in frame.groupBy("channel").agg(F.approx_count_distinct("guid", 0.03).alias("uv")).collect():
        assert abs(r["uv"] - 9973) < 0.15 * 9973


@CUTS
def test_concatenation_in_parts(frame, rows, max_rows):
    out = A.concat_in_order(frame, ["k"], "s", ORDER, 7, "|", max_rows).orderBy("k", "part").collect()
    joined = {}
    for r in out:
        joined.setdefault(r["k"], []).append(r["joined"])
    assert {k: "|".join(v) for k, v in joined.items()} == {
        k: "|".join(r[3] for r in g) for k, g in per_key(rows).items()
    }


@CUTS
def test_count_windows(frame, rows, max_rows):
    full = W.count_tumble(frame, ["k"], ORDER, 4, F.sum("v").alias("total"), max_rows=max_rows)
    want = [
        (k, n, sum(r[4] for r in g[n * 4 : n * 4 + 4])) for k, g in per_key(rows).items() for n in range(len(g) // 4)
    ]
    assert sorted(map(tuple, full.select("k", "window_no", "total").collect())) == sorted(want)
    slide = W.count_slide(frame, ["k"], ORDER, 2, 5, F.sum("v").alias("total"), max_rows=max_rows)
    want = [
        (k, n, sum(r[4] for r in g[max(0, 2 * n - 5) : 2 * n]))
        for k, g in per_key(rows).items() for n in range(1, len(g) // 2 + 1)
    ]
    assert sorted(map(tuple, slide.select("k", "firing", "total").collect())) == sorted(want)


@pytest.mark.parametrize("fire,keep", [(5, 2), (3, 3), (1, 4), (7, 1)])
def test_other_slides(frame, rows, fire, keep):
    slide = W.count_slide(frame, [], ORDER, fire, keep, F.sum("v").alias("total"))
    want = [(n, sum(r[4] for r in rows[max(0, fire * n - keep) : fire * n])) for n in range(1, len(rows) // fire + 1)]
    assert sorted(map(tuple, slide.select("firing", "total").collect())) == want


@CUTS
def test_marker_windows(frame, rows, max_rows):
    out = W.marker_windows(frame, ["k"], ORDER, F.col("s") == "x", 3, max_rows)
    got = sorted((r["k"], r["window_no"], r["place"], r["id"]) for r in out.collect())
    want = []
    for k, g in per_key(rows).items():
        held, number = [], 0
        for r in g:
            held.append(r[2])
            if r[3] == "x":
                want += [(k, number, i + 1, x) for i, x in enumerate(held[::-1][:3])]
                held, number = [], number + 1
    assert got == sorted(want)


@CUTS
def test_sessions(frame, rows, max_rows):
    out = W.session_windows(frame, ["k"], ORDER, 40, F.count("*").alias("n"), max_rows=max_rows)
    got = sorted((r["k"], r["n"]) for r in out.collect())
    want = []
    for k, g in per_key(rows).items():
        n = 1
        for a, b in zip(g, g[1:]):
            if b[1] - a[1] < 40:
                n += 1
            else:
                want.append((k, n))
                n = 1
        want.append((k, n))
    assert got == sorted(want)


@CUTS
def test_pattern(frame, rows, max_rows):
    out = S.sequence_within(["k"], ORDER, "s", "b", "h", "d", 300).over(frame, max_rows)
    want = set()
    for g in per_key(rows).values():
        for i, d in enumerate(g):
            for j in range(i):
                if d[3] == "d" and g[j][3] == "b" and g[j][1] > d[1] - 300 and any(x[3] == "h" for x in g[j + 1 : i]):
                    want.add(d[2])
    assert {r["id"] for r in out.collect()} == want and want


@CUTS
def test_expiring_counter(frame, rows, max_rows):
    out = S.counter_with_expiry(["k"], ORDER, 30, "n").over(frame, max_rows)
    want = {}
    for g in per_key(rows).values():
        n, last = 0, None
        for r in g:
            n = 1 if last is None or r[1] - last >= 30 else n + 1
            want[r[2]], last = n, r[1]
    assert {r["id"]: r["n"] for r in out.collect()} == want


@CUTS
def test_silence(frame, rows, max_rows):
    out = S.silence_alerts(frame, ["k"], ORDER, F.col("s") == "a", 25, max_rows)
    want = []
    for g in per_key(rows).values():
        for i, r in enumerate(g):
            if r[3] == "a" and (i + 1 == len(g) or g[i + 1][1] > r[1] + 25):
                want.append((r[2], r[1] + 25))
    assert sorted((r["id"], r["alert_time"]) for r in out.collect()) == sorted(want)


@CUTS
def test_lateness(spark, max_rows):
    rng = random.Random(3)
    rows = [(i, max(0, i * 10 - rng.choice([0, 0, 50, 400]))) for i in range(200)]
    frame = spark.createDataFrame(rows, "arrival long, t long").withColumn("id", F.col("arrival"))
    out = S.lateness(["arrival", "id"], "t", 100, 60, 120).over(frame, max_rows)
    want, top = {}, 0
    for arrival, t in rows:
        top = max(top, t)
        end = (t // 100 + 1) * 100
        want[arrival] = "on_time" if end > top - 60 else "refire" if end + 120 > top - 60 else "late"
    got = {r["arrival"]: r["lateness"] for r in out.collect()}
    assert got == want and set(want.values()) == {"on_time", "refire", "late"}


@CUTS
def test_as_of_join(spark, frame, rows, max_rows):
    versions = make(11, 80)
    right = spark.createDataFrame(versions, "k long, vt long, vid long, name string, n long")
    out = J.as_of_join(frame, right, ["k"], ORDER, ["vt", "vid"], ["vid", "name"], max_rows)
    want = {}
    for r in rows:
        old = [v for v in versions if v[0] == r[0] and v[1] <= r[1]]
        want[r[2]] = max(old, key=lambda v: (v[1], v[2]))[2] if old else None
    assert {r["id"]: r["vid"] for r in out.collect()} == want


@pytest.mark.parametrize("lower,upper", [(0, 50), (-50, 0), (-20, 30), (0, 0)])
def test_interval_join(spark, frame, rows, lower, upper):
    others = make(13, 120)
    right = spark.createDataFrame(others, "k long, rt long, rid long, name string, n long")
    out = J.interval_join(frame, right, ["k"], "t", "rt", lower, upper)
    want = sorted((a[2], b[2]) for a in rows for b in others if a[0] == b[0] and b[1] + lower <= a[1] <= b[1] + upper)
    assert sorted((r["id"], r["rid"]) for r in out.collect()) == want


def test_sequence_and_collection(spark):
    assert [r["id"] for r in files.sequence(spark, 1, 5).collect()] == [1, 2, 3, 4, 5]
    assert files.collection(spark, [("a", 1)], "w string, n int").first()["w"] == "a"


def test_nested_json(spark):
    from pyspark.sql import types as T

    text = '{"status":"1","regeocode":{"addressComponent":{"city":[],"province":"p"},"pois":[{"id":"x"},{"id":"y"}]}}'
    schema = T.StructType.fromDDL(
        "status STRING, regeocode STRUCT<addressComponent: STRUCT<province: STRING>, pois: ARRAY<STRUCT<id: STRING>>>"
    )
    row = files.from_json_lines(spark.createDataFrame([(text,)], "value string"), schema).first()
    assert row["regeocode"]["addressComponent"]["province"] == "p" and row["regeocode"]["pois"][1]["id"] == "y"
