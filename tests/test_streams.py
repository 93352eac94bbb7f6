"""Streams fed file by file must give what one batch gives, also across restarts."""

import random

import pytest
from pyspark.sql import functions as F

from tideline.operators import changes as C
from tideline.operators import state as S
from tideline.operators.ordered import OrderedJob, Stage, running_count, running_last, running_sum
from tideline.plans import traffic as V
from tideline.queries import QUERIES
from tideline.session import STATE_STORE, scratch_folder
from tideline.sinks import tables as K
from tideline.sources.files import watch_lines
from tideline.streaming import operators as O
from tideline.streaming.carry import batch_work, ordered_stream
from tideline.streaming.run import append_to, appended, each_batch, kept_current, with_event_time

ORDER = ["t", "id"]
SCHEMA = "k long, t long, id long, s string, v long"


def rows_of(n=240, seed=4):
    rng = random.Random(seed)
    times = sorted(rng.randint(0, 40_000) for _ in range(n))
    return [(1 if i % 3 else rng.randint(2, 5), t, i, rng.choice("bhdx"), rng.randint(1, 9)) for i, t in enumerate(times)]


def add_file(spark, folder, rows, schema=SCHEMA):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


@pytest.fixture(scope="module")
def parts():
    rows = rows_of()
    return [rows[i : i + 60] for i in range(0, 240, 60)]


@pytest.fixture(scope="module")
def folder(spark, parts):
    path = scratch_folder(spark, "feed")
    for part in parts:
        add_file(spark, path, part)
    return path


def stream(spark, folder, schema=SCHEMA):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def values(frame):
    names = sorted(frame.columns)
    return sorted(str(tuple(r)) for r in frame.select(names).collect())


def running_job():
    return OrderedJob(
        ["k"], ORDER,
        [Stage(lambda: [running_count("n"), running_sum("total", F.col("v")), running_last("h", F.when(F.col("s") == "h", F.col("id")))])],
        lambda frame: frame.select("id", "n", "total", "h"),
    )


JOBS = {
    "running": running_job,
    "pattern": lambda: S.sequence_within(["k"], ORDER, "s", "b", "h", "d", 5000),
    "expiry": lambda: S.counter_with_expiry(["k"], ORDER, 400, "n"),
    "first": lambda: S.mark_first_seen(["k"], ORDER, "is_first"),
    "changes": lambda: C.running_total_changes(["k"], ORDER, "v", "total"),
    "lateness": lambda: S.lateness(["t", "id"], "v", 3, 1, 2),
}


@pytest.mark.parametrize("name", JOBS)
@pytest.mark.parametrize("max_rows", [10, 10_000])
def test_job_over_files_equals_batch(spark, folder, name, max_rows):
    got = ordered_stream(spark, stream(spark, folder), JOBS[name](), max_rows=max_rows)
    assert values(got) == values(JOBS[name]().over(spark.read.parquet(folder)))


def test_sessions_over_files_equal_batch(spark):
    schema = (
        "log_id long, guid long, sessionid string, eventid string, timestamp long, properties map<string,string>, "
        "province string, city string, region string, devicetype string, is_new int, releasechannel string"
    )
    rng, rows = random.Random(9), []
    for i in range(90):
        event = rng.choice(["applaunch", "wakeup", "pageload", "e1", "putback"])
        rows.append((i, rng.randint(1, 3), "s", event, i * 10, {"pageId": f"p{i % 4}"}, "p", "c", "r", "x", 1, "ch"))
    path = scratch_folder(spark, "visits")
    for i in range(0, 90, 30):
        add_file(spark, path, rows[i : i + 30], schema)
    got = ordered_stream(spark, stream(spark, path, schema), V.session_job())
    assert values(got) == values(V.split_sessions(V.visit_rows(spark.read.parquet(path))))


def test_stopped_stream_goes_on_where_it_was(spark, parts):
    path, base = scratch_folder(spark, "grow"), scratch_folder(spark, "job")
    for part in parts[:2]:
        add_file(spark, path, part)
    ordered_stream(spark, stream(spark, path), running_job(), base)
    for part in parts[2:]:
        add_file(spark, path, part)
    got = ordered_stream(spark, stream(spark, path), running_job(), base)
    assert values(got) == values(running_job().over(spark.read.parquet(path)))


def test_failed_batch_is_repeated_without_duplicates(spark, folder):
    base = scratch_folder(spark, "fails")
    work = batch_work(running_job(), f"{base}/rows", f"{base}/state")
    failed = []

    def fails_once(batch, number):
        work(batch, number)
        if number == 1 and not failed:
            failed.append(number)
            raise RuntimeError("lost after the batch was written, before it was committed")

    with pytest.raises(Exception, match="lost after"):
        each_batch(stream(spark, folder), fails_once, f"{base}/checkpoint", "append")
    each_batch(stream(spark, folder), fails_once, f"{base}/checkpoint", "append")
    got = K.read_batches(spark, f"{base}/rows")
    assert failed and values(got) == values(running_job().over(spark.read.parquet(folder)))


def test_file_sink_restart_writes_each_row_once(spark, parts):
    path, base = scratch_folder(spark, "once"), scratch_folder(spark, "sink")
    for part in parts[:2]:
        add_file(spark, path, part)
        append_to(stream(spark, path), f"{base}/rows", f"{base}/checkpoint")
    append_to(stream(spark, path), f"{base}/rows", f"{base}/checkpoint")
    assert spark.read.parquet(f"{base}/rows").count() == 120


def test_change_feed_adds_up_to_the_result(spark, folder):
    base = scratch_folder(spark, "feed")
    counts = stream(spark, folder).groupBy("k", "s").agg(F.count("*").alias("n"))
    each_batch(counts, O.change_feed(["k", "s"], ["n"], f"{base}/state", f"{base}/rows"), f"{base}/checkpoint")
    feed = spark.read.parquet(f"{base}/rows")
    assert {r["op"] for r in feed.select("op").distinct().collect()} == {"+I", "-U", "+U"}
    newest = C.current_rows(feed, ["k", "s"], ["batch"]).drop("batch")
    want = spark.read.parquet(folder).groupBy("k", "s").agg(F.count("*").alias("n"))
    assert values(newest) == values(want)


def test_state_counts_over_files(spark, folder):
    counted = O.counts_in_state(stream(spark, folder), ["k"], "k long", "n", "id", 3)
    want = spark.read.parquet(folder).groupBy("k").agg(F.count("*").alias("n"))
    current = kept_current(spark, counted, ["k", "part"], "state")
    assert values(current.groupBy("k").agg(F.sum("n").alias("n"))) == values(want)


def test_stream_interval_join_over_files_equals_batch(spark, folder):
    from tideline.operators.joins import interval_join

    def side(rows, kind, name):
        moment = F.timestamp_millis("t")
        return rows.where(F.col("s") == kind).select("k", F.col("id").alias(f"{name}_id"), "t", moment.alias("moment"))

    rows, whole = stream(spark, folder), spark.read.parquet(folder)
    left = with_event_time(side(rows, "b", "l"), "moment", "1 second", "l_rt").drop("t", "moment")
    right = with_event_time(side(rows, "d", "r"), "moment", "1 second", "r_rt").drop("t", "moment")
    pairs = O.interval_join(left, right, ["k"], "l_rt", "r_rt", 3000)
    got = appended(spark, pairs.select("k", "l_id", "r_id"), "pairs")
    want = interval_join(
        side(whole, "b", "l").withColumnRenamed("t", "l_t").drop("moment"),
        side(whole, "d", "r").withColumnRenamed("t", "r_t").drop("moment"), ["k"], "l_t", "r_t", 0, 3000,
    ).select("k", "l_id", "r_id")
    assert values(got) == values(want) and want.count() > 0


def test_rows_behind_the_watermark_are_dropped_and_counted(spark):
    path, base = scratch_folder(spark, "late"), scratch_folder(spark, "late-job")
    add_file(spark, path, [(1, 0, 0, "a", 1), (1, 60_000, 1, "a", 1)])
    add_file(spark, path, [(1, 61_000, 2, "a", 1)])
    add_file(spark, path, [(1, 1_000, 3, "a", 1), (1, 90_000, 4, "a", 1)])
    rows = stream(spark, path).withColumn("moment", F.timestamp_millis("t"))
    counted = O.windowed(with_event_time(rows, "moment", "5 seconds"), "rt", "10 seconds", [], F.count("*").alias("n"))
    query = (
        counted.writeStream.outputMode("append").format("parquet").option("path", f"{base}/rows")
        .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    dropped = sum(o["numRowsDroppedByWatermark"] for p in query.recentProgress for o in p["stateOperators"])
    assert dropped == 1
    out = {str(r["window_start"])[-8:]: r["n"] for r in spark.read.parquet(f"{base}/rows").collect()}
    assert out == {"00:00:00": 1, "00:01:00": 2}


def test_growing_windows_over_files_equal_batch(spark, folder):
    from tideline.operators.windows import cumulate

    rows = stream(spark, folder).withColumn("moment", F.timestamp_millis("t"))
    marked = with_event_time(rows, "moment", "1 second")
    got = O.growing(spark, marked, "rt", 20_000, 2_000, ["s"], ("users", "k"), {"total": F.col("v")})
    want = cumulate(spark.read.parquet(folder), F.col("t"), 20_000, 2_000, ["s"], ("users", "k"), {"total": F.col("v")})
    assert values(got) == values(want)


def test_watched_folder_takes_new_files(spark):
    path, base = scratch_folder(spark, "lines"), scratch_folder(spark, "watch")
    for text in ("one", "two"):
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("append").text(path)
        append_to(watch_lines(spark, path, 1), f"{base}/rows", f"{base}/checkpoint")
    assert sorted(r["value"] for r in spark.read.parquet(f"{base}/rows").collect()) == ["one", "two"]


def test_union_follows_the_slower_input(spark):
    left, right = scratch_folder(spark, "fast"), scratch_folder(spark, "slow")
    add_file(spark, left, [(1, 0, 0, "a", 1), (1, 100_000, 1, "a", 1)])
    add_file(spark, right, [(1, 0, 2, "a", 1), (1, 25_000, 3, "a", 1)])
    both = [
        with_event_time(stream(spark, p).withColumn("moment", F.timestamp_millis("t")), "moment", "0 seconds")
        for p in (left, right)
    ]
    out = appended(spark, O.windowed(both[0].unionByName(both[1]), "rt", "10 seconds", [], F.count("*").alias("n")), "slow")
    assert [(str(r["window_start"])[-8:], r["n"]) for r in out.collect()] == [("00:00:00", 2)]


def test_upsert_is_repeatable_and_compacts(spark):
    path, target = scratch_folder(spark, "keyed"), scratch_folder(spark, "compact")
    schema = "k int, name string, at long"
    batches = [[(1, "a", 1), (2, "b", 1), (1, "c", 2)], [(2, "d", 3)], [(3, "e", 4)]]
    for number in (0, 1, 1, 2, 2):
        K.upsert_batch(spark.createDataFrame(batches[number], schema), path, ["k"], ["at"], number)
    want = [(1, "c"), (2, "d"), (3, "e")]
    assert sorted((r["k"], r["name"]) for r in K.read_keyed(spark, path, ["k"], ["at"]).collect()) == want
    K.compact(spark, path, target, ["k"], ["at"])
    K.upsert_batch(spark.createDataFrame([(1, "z", 9)], schema), target, ["k"], ["at"], 1)
    got = sorted((r["k"], r["name"]) for r in K.read_keyed(spark, target, ["k"], ["at"]).collect())
    assert got == [(1, "z"), (2, "d"), (3, "e")]


DEFAULT_STORE = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"


@pytest.fixture
def default_store(spark):
    """The state store of a session that ``build_session`` did not make."""
    before = {c: spark.conf.get(c) for c in (STATE_STORE, "spark.sql.shuffle.partitions")}
    spark.conf.set(STATE_STORE, DEFAULT_STORE)
    # Each partition of a stateful run starts a Python process.
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    for c, value in before.items():
        spark.conf.set(c, value)


@pytest.mark.parametrize(
    "name, batch",
    [("running_sum_stream", "running_sum"), ("st_recovery", "running_sum"), ("dw_session_split_stream", "dw_session_split")],
)
def test_keyed_queries_run_where_the_store_is_sparks_default(spark, default_store, name, batch):
    path, kinds = scratch_folder(spark, "plain"), ["signup", "view", "click", "purchase", "error"]
    rows = [(i, f"2024-01-{i % 28 + 1:02d} 0{i % 10}:00:00", i % 4, kinds[i % 5], float(i), f'{{"k": {i}}}') for i in range(60)]
    schema = "event_id long, ts string, user_id long, event_type string, value double, props string"
    events = spark.createDataFrame(rows, schema).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    events.coalesce(1).write.parquet(f"{path}/events.parquet")
    got = values(QUERIES[name](spark, path))
    assert got and got == values(QUERIES[batch](spark, path))
    assert spark.conf.get(STATE_STORE) == DEFAULT_STORE
