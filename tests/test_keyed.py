"""Keyed state in Spark's store: each job over parts, stopped and started in between, against its form for whole tables."""

import os
import random
import subprocess
import sys
from collections import Counter
from datetime import datetime, timedelta
from pathlib import Path
from types import SimpleNamespace

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tideline.operators import joins as J
from tideline.operators import state as S
from tideline.operators import windows as W
from tests.compare import compare
from tideline.plans.traffic import VisitState
from tideline.queries import ORACLES, QUERIES
from tideline.session import STATE_STORE
from tideline.streaming import keyed as K

ORDER = ["time", "id"]
SCHEMA = "key long, time long, id long, kind string, value long"


def made_rows(seed, n=400, keys=6, hot=0.4, step=40, far=0):
    """Rows in order of time, many of them of one key; ``far`` leaves some keys behind after that time."""
    rng, time, rows = random.Random(seed), 0, []
    for i in range(n):
        time += rng.choice([0, 1, rng.randint(0, step)])
        key = 0 if rng.random() < hot else rng.randrange(keys)
        if far and time > far:
            key = rng.randrange(2)
        rows.append((rng.choice([key, key, key, None]) if key == 3 else key, time, i, rng.choice("vcpx"), rng.randint(-5, 9)))
    return rows


def cut(rows, n, seed=1):
    """Parts in order of time, each shuffled and with no time in two parts."""
    rng = random.Random(seed)
    times = sorted({r[1] for r in rows})
    marks = sorted(rng.sample(times[1:], n - 1))
    parts = [[] for _ in range(n)]
    for r in rows:
        parts[sum(r[1] >= m for m in marks)].append(r)
    for part in parts:
        rng.shuffle(part)
    return parts


@pytest.fixture(autouse=True)
def few_partitions(spark):
    """Each partition of a stateful run starts a Python process."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def run_parts(spark, folder, parts, build, schema=SCHEMA):
    """All rows given, and the progress of the last run."""
    result = None
    for part in parts:
        spark.createDataFrame(part, schema).repartition(3).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(spark.read.parquet(f"{folder}/in").schema).parquet(f"{folder}/in")
        result = build(stream)
        query = (
            result.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/check")
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()
    return spark.read.schema(result.schema).parquet(f"{folder}/out"), query.recentProgress


def same(a, b):
    columns = sorted(a.columns)
    assert columns == sorted(b.columns)
    assert Counter(map(tuple, a.select(columns).collect())) == Counter(map(tuple, b.select(columns).collect()))


def state_rows(progress):
    return sum(s["numRowsTotal"] for s in progress[-1].stateOperators)


def test_expiring_counter(spark, tmp_path):
    rows = made_rows(1, far=2500)
    got, progress = run_parts(
        spark, tmp_path, cut(rows, 3),
        lambda s: K.in_order(s.select("key", *ORDER), ["key"], ORDER, "0 seconds", "key LONG, id LONG, n LONG", K.ExpiringCounter, 100, "n"),
    )
    whole = S.counter_with_expiry(["key"], ORDER, 100, "n").over(spark.createDataFrame(rows, SCHEMA))
    same(got, whole.select("key", "id", "n"))
    newest = {}
    for key, time, *_ in rows:
        newest[key] = time
    alive = sum(time + 100 > rows[-1][1] for time in newest.values())
    # One counter and one timer (kept under two orders) for each key that is alive.
    assert 0 < alive < len(newest) and state_rows(progress) <= 3 * alive


def test_sequence(spark, tmp_path):
    rows = made_rows(2, n=700)
    got, _ = run_parts(
        spark, tmp_path, cut(rows, 3, seed=5),
        lambda s: K.in_order(s.select("key", *ORDER, "kind"), ["key"], ORDER, "0 seconds", "key LONG, id LONG",
                             K.SequenceWithin, "kind", "v", "c", "p", 120),
    )
    whole = S.sequence_within(["key"], ORDER, "kind", "v", "c", "p", 120).over(spark.createDataFrame(rows, SCHEMA))
    assert whole.count() > 20
    same(got, whole.select("key", "id"))


def total(rows, window):
    return rows.groupby(window, as_index=False).agg(total=("value", "sum"), held=("value", "size"))


@pytest.mark.parametrize("kind", ["tumble", "slide", "early", "marker"])
def test_row_windows(spark, tmp_path, kind):
    rows = made_rows(3, n=300)
    frame = spark.createDataFrame(rows, SCHEMA)
    sums = [F.sum("value").alias("total"), F.count(F.lit(1)).alias("held")]
    picked = lambda s: s.select("key", *ORDER, "value", (F.col("kind") == "p").alias("closes"))
    name, processor, named, whole = {
        "tumble": ("window_no", K.CountTumble, {"size": 7}, lambda: W.count_tumble(frame, ["key"], ORDER, 7, *sums)),
        "slide": ("firing", K.CountSlide, {"fire_every": 2, "keep_last": 5}, lambda: W.count_slide(frame, ["key"], ORDER, 2, 5, *sums)),
        "early": ("firing", K.CountSlide, {"fire_every": 5, "keep_last": 3}, lambda: W.count_slide(frame, ["key"], ORDER, 5, 3, *sums)),
        "marker": ("window_no", K.MarkerWindows, {"marker": "closes", "keep_last": 4},
                   lambda: W.marker_windows(frame, ["key"], ORDER, F.col("kind") == "p", 4).groupBy("key", "window_no").agg(*sums)),
    }[kind]
    got, progress = run_parts(
        spark, tmp_path, cut(rows, 4, seed=7),
        lambda s: K.row_windows(picked(s), ["key"], ORDER, "0 seconds", f"key LONG, {name} LONG, total LONG, held LONG",
                                name, total, processor, **named),
    )
    same(got, whole())
    keys = len({r[0] for r in rows})
    most = {"tumble": 6, "slide": 5, "early": 3, "marker": 4}[kind]
    assert state_rows(progress) <= keys * (most + 2)


def test_due_alerts(spark, tmp_path):
    rows = made_rows(4, n=300)
    got, _ = run_parts(
        spark, tmp_path, cut(rows, 3), lambda s: K.due_alerts(s.withColumn("w", F.col("kind") == "x"), ["key"], "time", "w", 50, "0 seconds", parts=4),
    )
    end = max(r[1] for r in rows)
    whole = S.delayed_alerts(spark.createDataFrame(rows, SCHEMA), ["key"], "time", F.col("kind") == "x", 50)
    same(got, whole.where(F.col("alert_time") <= end))


def test_silence_alerts_in_any_order_up_to_the_watermark(spark, tmp_path):
    """Rows up to 300 ms out of order over the parts; a row of a later part takes an alert back."""
    rows = made_rows(5, n=500, step=90)
    rng = random.Random(3)
    arrived = sorted(rows, key=lambda r: (r[1] + rng.randint(0, 280), r[2]))
    parts = [arrived[:150], arrived[150:320], arrived[320:]]
    # Chunks are told by their newest row, so a part may hold rows as old as the delay allows.
    got, progress = run_parts(
        spark, tmp_path, parts,
        lambda s: K.silence_alerts(s.withColumn("w", F.col("kind") == "v"), ["key"], ORDER, "w", 60, "300 milliseconds"),
    )
    whole = S.silence_alerts(spark.createDataFrame(rows, SCHEMA), ["key"], ORDER, F.col("kind") == "v", 60)
    mark = max(r[1] for r in rows) - 300
    want = whole.where(F.col("alert_time") < mark)
    assert want.count() > 10
    same(got, want)


def test_a_later_part_withdraws_an_alert(spark, tmp_path):
    parts = [[(1, 100, 1, "v", 0), (2, 100, 2, "v", 0)], [(1, 150, 3, "x", 0)], [(9, 1000, 4, "x", 0)]]
    got, _ = run_parts(
        spark, tmp_path, parts,
        lambda s: K.silence_alerts(s.withColumn("w", F.col("kind") == "v"), ["key"], ORDER, "w", 60, "0 seconds"),
    )
    assert [tuple(r) for r in got.collect()] == [(2, 100, 2, 160)]


class Kept:
    """What a processor of one key sees of Spark: a value and timers."""

    def __init__(self):
        self.value, self.timers = None, set()

    def getValueState(self, *_):
        return self

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None

    def listTimers(self):
        return iter(sorted(self.timers))

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.remove(at)


@pytest.mark.parametrize("mark, alerts, timers", [(60, 0, [61]), (461, 5, [561]), (560, 5, [561]), (5000, 9, [])])
def test_a_key_has_one_silence_timer(mark, alerts, timers):
    """However many stretches of a key are open: timers are state, and each costs a call when it goes off."""
    made, kept = K.SilenceAlerts("key", ORDER, 60), Kept()
    made.init(kept)
    times = [100 * i for i in range(9)]
    for part in (times[5:], times[:5]):
        made.handleInputRows((1, "0"), [{"first__": part, "last__": part, "id__": part, "watched__": [True] * len(part)}], None)
        assert list(kept.listTimers()) == [part[0] + 61]
    out = []
    while kept.timers and min(kept.timers) <= mark:
        at = min(kept.timers)
        out += made.handleExpiredTimer(
            (1, "0"), SimpleNamespace(getCurrentWatermarkInMs=lambda: mark), SimpleNamespace(getExpiryTimeInMs=lambda: at)
        )
        kept.timers.discard(at)
    assert len(out) <= 1
    assert [a for frame in out for a in frame["alert_time"]] == [t + 60 for t in times[:alerts]]
    assert list(kept.listTimers()) == timers


def test_joined_stretches():
    rng = random.Random(1)
    for _ in range(200):
        rows = sorted((rng.randint(0, 300), i, rng.random() < 0.5) for i in range(rng.randint(1, 25)))
        whole = K.joined_stretches([(t, t, i, w) for t, i, w in rows], 10)
        pieces = [K.joined_stretches([(t, t, i, w) for t, i, w in rows[k::3]], 10) for k in range(3)]
        rng.shuffle(pieces)
        assert K.joined_stretches([s for p in pieces for s in p], 10) == whole
        ends = [(t, i, w) for n, (t, i, w) in enumerate(rows) if n + 1 == len(rows) or rows[n + 1][0] - t > 10]
        assert [s[1:] for s in whole] == ends


def test_as_of_join_takes_late_versions(spark, tmp_path):
    rows = made_rows(6, n=400)
    rng = random.Random(8)
    arrived = sorted(rows, key=lambda r: (r[1] + rng.randint(0, 90), r[2]))
    parts = [arrived[:130], arrived[130:300], arrived[300:], [(99, 10**6, 10**6, "x", 0)]]

    def sides(frame):
        left = frame.where("kind <> 'v'").select("key", *ORDER, "kind")
        return left, frame.where("kind = 'v'").select("key", F.col("time").alias("since"), F.col("id").alias("vid"), (F.col("value") + (1 << 60)).alias("value"))

    got, progress = run_parts(
        spark, tmp_path, parts,
        lambda s: K.as_of_join(*sides(s), ["key"], ORDER, ["since", "vid"], ["since", "value"], "100 milliseconds", parts=2),
    )
    whole = J.as_of_join(*sides(spark.createDataFrame(rows, SCHEMA)), ["key"], ORDER, ["since", "vid"], ["since", "value"])
    same(got.select("key", *ORDER, "kind", "since", "value"), whole.select("key", *ORDER, "kind", "since", "value"))
    # The newest version of each key and part, the last row and its timer are what is left.
    assert state_rows(progress) <= 2 * 2 * len({r[0] for r in rows}) + 4


def test_as_of_join_with_many_keys_is_few_states(spark, tmp_path):
    """A call and a state per group of keys; versions are found again after more keys have come and pages were dealt anew."""
    rng = random.Random(9)
    rows = [(None if i % 50 == 7 else rng.randrange(20 + i), 3 * i, i, rng.choice("vcp"), i) for i in range(1800)]
    parts = [rows[:100], rows[100:800], rows[800:]]

    def sides(frame):
        left = frame.where("kind <> 'v'").select("key", *ORDER, "kind")
        return left, frame.where("kind = 'v'").select("key", F.col("time").alias("since"), F.col("id").alias("vid"), "value")

    got, progress = run_parts(
        spark, tmp_path, parts,
        lambda s: K.as_of_join(*sides(s), ["key"], ORDER, ["since", "vid"], ["since", "value"], "0 seconds", parts=2, groups=4),
    )
    whole = J.as_of_join(*sides(spark.createDataFrame(rows, SCHEMA)), ["key"], ORDER, ["since", "vid"], ["since", "value"])
    same(got, whole.select(got.columns))
    keys = len({r[0] for r in rows if r[3] == "v"} - {None})
    assert keys > 400 and state_rows(progress) < keys / 4


def test_packed_keeps_every_row(spark, tmp_path):
    rows = made_rows(7, n=200) + [(None, 5, 10**6, None, None)]
    spark.createDataFrame(rows, SCHEMA).repartition(4).write.parquet(f"{tmp_path}/in")
    frame = spark.read.parquet(f"{tmp_path}/in")
    chunks = K.packed(frame, ["key"], ORDER, "0 seconds").collect()
    assert len(chunks) < 60
    assert Counter((None if c[K.NULLS] == "1" else c["key"], *r) for c in chunks for r in zip(c["time"], c["id"], c["kind"], c["value"])) == Counter(rows)
    assert all(list(zip(c["time"], c["id"])) == sorted(zip(c["time"], c["id"])) for c in chunks)


def test_numbers_beside_nulls_are_exact(spark, tmp_path):
    rows = [(i % 2, 7 + i if i % 3 else None, i, None, None if i % 5 == 1 else (1 << 60) + i) for i in range(40)]
    spark.createDataFrame(rows, SCHEMA).coalesce(2).write.parquet(f"{tmp_path}/in")
    columns = [*ORDER, "kind", "value"]
    chunks = K.packed(spark.read.parquet(f"{tmp_path}/in"), ["key"], ORDER, "0 seconds", masked=True).toPandas()
    got = K.unpacked([chunks], columns).astype(object)
    assert Counter(got.where(got.notna(), None).itertuples(index=False, name=None)) == Counter(r[1:] for r in rows)
    # A chunk is as late as its newest row with a time.
    assert sorted(chunks[K.CHUNK_TIME].dt.microsecond // 1000) == sorted(max(t) for t in (
        [r[1] for r in half if r[0] == key and r[1]] for half in (rows[:20], rows[20:]) for key in (0, 1)))


NULLED = ["out_changelog_stream", "out_changelog_rows_stream", "running_sum_stream", "st_recovery", "running_count_stream", "st_pattern_ttl_stream", "st_value_ttl_stream", "st_timer_alert_stream", "st_timer_cancel_stream", "win_count_tumble_stream", "win_trigger_evict_stream", "win_marker_trigger_stream", "join_temporal_stream"]


@pytest.fixture(scope="module")
def nulled(tmp_path_factory):
    """Events of which some lack a time, a user, a kind, a value or the text that gives the channel; no time comes twice."""
    rng, start, rows = random.Random(11), datetime(2024, 1, 1), []
    for i in range(700):
        at = start + timedelta(minutes=60 * i + rng.randrange(50), milliseconds=i)
        kind = rng.choice(["view", "click", "purchase", "error", "signup"])
        row = [at, i // 40 % 3 if i % 4 else 0, kind, rng.randrange(9000) / 100, '{"k": %d}' % rng.randrange(100)]
        rows.append((i, *[None if rng.random() < 0.06 else x for x in row]))
    rng.shuffle(rows)
    names, kinds = ["event_id", "ts", "user_id", "event_type", "value", "props"], ["int64", pa.timestamp("us"), "int64", "string", "float64", "string"]
    folder = tmp_path_factory.mktemp("nulled")
    pq.write_table(pa.table([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names), folder / "events.parquet")
    return str(folder)


@pytest.mark.parametrize("name", NULLED)
def test_rows_with_nulls_equal_sql(spark, nulled, name):
    """With the store that a session has by default."""
    before = spark.conf.get(STATE_STORE)
    spark.conf.unset(STATE_STORE)
    try:
        assert compare(spark, nulled, QUERIES[name], ORACLES[name]) == ""
    finally:
        spark.conf.set(STATE_STORE, before)


def test_fire_is_pure():
    slide = K.CountSlide(["k"], ORDER, [*ORDER, "v"], [], "firing", "", total, fire_every=3, keep_last=2)
    frame = pd.DataFrame({"time": range(8), "id": range(8), "v": range(8)})
    fired, left, n = slide.fire(frame, 0, 0)
    assert fired.groupby("firing")["v"].apply(list).to_dict() == {1: [1, 2], 2: [4, 5]} and list(left["v"]) == [6, 7] and n == 8


PROCESSORS = [
    *[kind for kind in vars(K).values() if isinstance(kind, type) and issubclass(kind, K.StatefulProcessor)], VisitState
]


@pytest.mark.parametrize("kind", [k for k in PROCESSORS if k is not K.StatefulProcessor], ids=lambda k: k.__name__)
def test_processors_can_be_read_where_the_package_is_not(tmp_path, kind):
    made = kind.__new__(kind)
    made.values = [K.Value("n", "sum", "one")]
    (tmp_path / "made").write_bytes(cloudpickle.dumps(made))
    code = "import pickle, sys; made = pickle.load(open('made', 'rb')); assert 'tideline' not in sys.modules; print(type(made).__name__, made.values[0].name)"
    found = subprocess.run([sys.executable, "-I", "-c", code], cwd=tmp_path, capture_output=True, text=True)
    assert found.stdout.split() == [kind.__name__, "n"], found.stderr


FAR_AWAY = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from tideline.queries import QUERIES
conf = {"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2", "spark.checkpoint.dir": "shared"}
spark = SparkSession.builder.master("local[2]").config(map=conf).getOrCreate()
day = F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(id % 28, 0, 0, id)").alias("ts")
rows = spark.range(60).select(
    F.col("id").alias("event_id"), day, (F.col("id") % 4).alias("user_id"), F.lit("view").alias("event_type"),
    F.col("id").cast("double").alias("value"), F.lit('{"k": 1}').alias("props"),
)
rows.coalesce(1).write.parquet("in/events.parquet")
got, want = ([tuple(r) for r in QUERIES[n](spark, "in").orderBy("log_id").collect()] for n in ("running_sum_stream", "running_sum"))
assert len(got) == 60 and got == want
print("equal")
"""


def test_a_stream_runs_where_only_the_driver_finds_the_package(tmp_path):
    root = str(Path(K.__file__).parents[2])
    # Started anew, so nothing of this process's Spark or of its path is left.
    kept = {k: v for k, v in os.environ.items() if not k.startswith(("PYTHONPATH", "PYSPARK", "SPARK", "_"))}
    found = subprocess.run(
        [sys.executable, "-I", "-c", FAR_AWAY, root], cwd=tmp_path, capture_output=True, text=True,
        env={**kept, "PYSPARK_PYTHON": sys.executable, "SPARK_LOCAL_IP": "127.0.0.1"},
    )
    assert "equal" in found.stdout.split(), found.stderr[-2000:]
