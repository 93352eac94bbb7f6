"""Connector options and message shapes; no broker or database is contacted."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.session import scratch_folder
from tideline.sinks import messages as M
from tideline.sinks import tables as K
from tideline.sources import files, jdbc, kafka

SCHEMA = T.StructType(
    [T.StructField("guid", T.LongType()), T.StructField("event", T.StringType()), T.StructField("long", T.LongType())]
)


def test_kafka_start_positions():
    base = kafka.kafka_options("h1:9092,h2:9092", ["a", "b"], "earliest", "g", 1000)
    assert base["subscribe"] == "a,b" and base["startingOffsets"] == "earliest"
    assert base["kafka.group.id"] == "g" and base["maxOffsetsPerTrigger"] == "1000"
    explicit = kafka.kafka_options("h", ["a"], {"a": {0: 5, 1: -2}})
    assert json.loads(explicit["startingOffsets"]) == {"a": {"0": 5, "1": -2}}
    with pytest.raises(ValueError):
        kafka.kafka_options("h", ["a"], "somewhere")


def topic(spark, texts):
    rows = [(None, bytearray(t.encode()), "tp", i % 2, i, None) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, kafka.KAFKA_COLUMNS)


def test_decoding_skips_what_does_not_fit(spark):
    csv = kafka.decode(topic(spark, ["1,click,5", "x,click,5", "rubbish"]), SCHEMA, "csv").collect()
    assert [(r["guid"], r["event"], r["long"], r["topic"], r["offset"]) for r in csv] == [(1, "click", 5, "tp", 0)]
    texts = ['{"guid":1,"event":"a","long":2}', '{"guid":2}']
    rows = kafka.decode(topic(spark, texts), SCHEMA, "json").collect()
    assert [(r["guid"], r["event"], r["partition"]) for r in rows] == [(1, "a", 0), (2, None, 1)]


def test_decoding_a_stream_of_topic_rows(spark):
    path, base = scratch_folder(spark, "topic"), scratch_folder(spark, "decoded")
    topic(spark, ["1,click,5", "2,view,6"]).write.parquet(path)
    rows = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
    from tideline.streaming.run import append_to

    append_to(kafka.decode(rows, SCHEMA, "csv"), f"{base}/rows", f"{base}/checkpoint")
    assert spark.read.parquet(f"{base}/rows").count() == 2


def test_unknown_encodings(spark):
    with pytest.raises(ValueError):
        kafka.decode(topic(spark, []), SCHEMA, "avro")
    with pytest.raises(ValueError):
        M.append_messages(spark.range(1), ["id"], "avro")


def test_keyed_messages(spark):
    rows = [("a", "+I", 0, 1), ("a", "-U", 1, 1), ("a", "+U", 2, 5), ("b", "+I", 0, 7), ("b", "-D", 1, 7)]
    changes = spark.createDataFrame(rows, "id string, op string, seq int, n int")
    out = {r["key"]: r["value"] for r in M.upsert_messages(changes, ["id"], ["id", "n"], ["seq"]).collect()}
    assert out == {"a": "a,5", "b": None}


def test_jdbc_options():
    options = jdbc.jdbc_options("jdbc:x://h/db", "t", "u", "p", split=("id", 0, 100, 8))
    assert options["dbtable"] == "t" and options["numPartitions"] == "8" and options["partitionColumn"] == "id"
    assert "partitionColumn" not in jdbc.jdbc_options("jdbc:x://h/db", "t", "u", "p")


def test_dated_write_replaces_only_its_days(spark):
    path = scratch_folder(spark, "dated")
    schema = "n int, dw_date string"
    K.write_dated(spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], schema), path)
    K.write_dated(spark.createDataFrame([(3, "2024-01-02")], schema), path)
    got = spark.read.schema(schema).parquet(path).collect()
    assert sorted((r["n"], str(r["dw_date"])) for r in got) == [(1, "2024-01-01"), (3, "2024-01-02")]


def test_console(spark, capsys):
    K.print_rows(spark.createDataFrame([("hello",)], "w string"))
    assert "hello" in capsys.readouterr().out


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Conf:
        def get(self, name):
            return None

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_folder(Session(), "x")
    Conf.get = lambda self, name: "hdfs://nn/shared/"
    assert scratch_folder(Session(), "x").startswith("hdfs://nn/shared/x-")


def test_row_helpers(spark):
    from tideline.operators.rows import branch, parse_delimited, route, split_rows

    lines = spark.createDataFrame([("1.a.2_2.b.x",)], "value string")
    parsed = parse_delimited(split_rows(lines, "value", "_"), "value", SCHEMA, ".").collect()
    assert [tuple(r) for r in parsed] == [(1, "a", 2), (2, "b", None)]
    routed = route(spark.range(6), {"low": F.col("id") < 2, "even": F.col("id") % 2 == 0}, "rest")
    assert [branch(routed, n).count() for n in ("low", "even", "rest")] == [2, 2, 2]


def test_delimited_rows_do_not_depend_on_the_columns_read(spark, tmp_path):
    (tmp_path / "rows.csv").write_text('1,a\nx,b\n2,"c,d"\n3\n4,e,f\n5,\n')
    schema = T.StructType.fromDDL("n BIGINT, name STRING")
    rows = files.read_delimited(spark, str(tmp_path), schema)
    assert sorted((r["n"], r["name"]) for r in rows.collect()) == [(1, "a"), (2, "c,d"), (5, None)]
    assert rows.count() == rows.select("name").count() == rows.select("n").count() == 3
