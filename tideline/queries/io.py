"""Sources and sinks over the given tables: written, read back and checked."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.timing import local_time
from tideline.plans.detail import passes_gate
from tideline.queries.registry import query
from tideline.queries.relational import action_sql, actions
from tideline.queries.views import APP_LOG, ORDER_CHANGES, with_views
from tideline.session import scratch_folder
from tideline.sinks import messages as M
from tideline.sinks import tables as K
from tideline.sources import files, kafka
from tideline.sources.behaviour import app_log, order_changes
from tideline.sources.tables import table
from tideline.streaming.run import appended

FIELDS = ["guid", "event_id", "channel", "action_time", "action_timelong"]
_LINE = "guid || ',' || event_id || ',' || channel || ',' || action_time || ',' || action_timelong"


def _line_folder(spark, folder):
    """Action events as lines of text in a new folder."""
    path = scratch_folder(spark, "lines")
    actions(spark, folder).select(F.concat_ws(",", *FIELDS).alias("value")).write.text(path)
    return path


@query("src_text", action_sql(f"SELECT {_LINE} AS value FROM action_event"))
def src_text(spark, folder):
    """Lines of a folder of text files."""
    return files.read_lines(spark, _line_folder(spark, folder))


@query("src_watch_dir", action_sql(f"SELECT {_LINE} AS value FROM action_event"))
def src_watch_dir(spark, folder):
    """Lines of the files found in a watched folder."""
    return appended(spark, files.watch_lines(spark, _line_folder(spark, folder)), "watched")


@query(
    "src_csv",
    action_sql("SELECT guid, event_id, channel, action_time, action_timelong FROM action_event WHERE log_id % 50 <> 0"),
)
def src_csv(spark, folder):
    """Delimited rows; those with a text where a number belongs are skipped."""
    path = scratch_folder(spark, "csv")
    broken = F.when(F.col("log_id") % 50 == 0, "n/a").otherwise(F.col("guid").cast("string"))
    rows = actions(spark, folder).withColumn("guid", broken)
    rows.select(F.concat_ws(",", *FIELDS).alias("value")).write.text(path)
    schema = T.StructType.fromDDL(
        "guid BIGINT, event_id STRING, channel STRING, action_time BIGINT, action_timelong BIGINT"
    )
    return files.read_delimited(spark, path, schema)


APP_LOG_SCHEMA = (
    "log_id BIGINT, account STRING, deviceid STRING, eventid STRING, latitude DOUBLE, longitude DOUBLE, "
    "properties MAP<STRING, STRING>, releasechannel STRING, sessionid STRING, timestamp BIGINT"
)


@query(
    "src_json",
    with_views(
        "SELECT log_id, account, deviceid, eventid, latitude, longitude, page, releasechannel, sessionid, timestamp FROM app_log",
        APP_LOG,
    ),
)
def src_json(spark, folder):
    """Application log lines in JSON, parsed to typed records."""
    schema = T.StructType.fromDDL(APP_LOG_SCHEMA)
    lines = app_log(table(spark, folder, "events")).select(F.to_json(F.struct(*schema.fieldNames())).alias("value"))
    parsed = files.from_json_lines(lines, schema)
    return parsed.withColumn("page", F.col("properties")["pageId"]).drop("properties")


def _kafka_rows(rows, value):
    """Rows in the shape the Kafka source gives them."""
    return rows.select(
        F.col("guid").cast("string").cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit("action").alias("topic"),
        (F.col("guid") % 4).cast("int").alias("partition"),
        F.col("log_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


_KAFKA_SQL = """
SELECT guid, event_id, action_timelong, 'action' AS topic, CAST(guid % 4 AS INTEGER) AS partition, log_id AS "offset", ts AS message_time
FROM action_event"""


@query("src_kafka", action_sql(_KAFKA_SQL))
def src_kafka(spark, folder):
    """JSON messages in the shape of a topic, decoded to typed columns."""
    fields = ["guid", "event_id", "action_timelong"]
    rows = _kafka_rows(actions(spark, folder), F.to_json(F.struct(*fields)))
    schema = T.StructType.fromDDL("guid BIGINT, event_id STRING, action_timelong BIGINT")
    return kafka.decode(rows, schema, "json")


@query("src_metadata_cols", action_sql(_KAFKA_SQL + " WHERE log_id % 10 <> 3"))
def src_metadata_cols(spark, folder):
    """CSV messages with topic, partition, offset and time as columns; bad messages skipped."""
    fields = ["guid", "event_id", "action_timelong"]
    value = F.when(F.col("log_id") % 10 == 3, "what is this").otherwise(F.concat_ws(",", *fields))
    schema = T.StructType.fromDDL("guid BIGINT, event_id STRING, action_timelong BIGINT")
    return kafka.decode(_kafka_rows(actions(spark, folder), value), schema, "csv")


@query("src_file_metadata", "SELECT count(*) AS cnt, true AS named FROM events")
def src_file_metadata(spark, folder):
    """File name of every row, from the file source's metadata columns."""
    rows = table(spark, folder, "events")
    named = rows.select(files.file_metadata(rows)[0])
    return named.agg(F.count(F.lit(1)).alias("cnt"), F.bool_and(F.col("file_name").endswith(".parquet")).alias("named"))


@query(
    "src_jdbc_dim",
    """SELECT p_partkey AS id, p_name AS name, p_brand AS description, count(*) AS sold
       FROM part JOIN lineitem ON l_partkey = p_partkey GROUP BY ALL""",
)
def src_jdbc_dim(spark, folder):
    """A product dimension kept as Parquet in place of a database, looked up per item."""
    dimension = table(spark, folder, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_brand").alias("description")
    )
    sold = table(spark, folder, "lineitem").groupBy(F.col("l_partkey").alias("id")).agg(F.count(F.lit(1)).alias("sold"))
    return sold.join(dimension, "id").select("id", "name", "description", "sold")


# Sinks


@query(
    "sink_kafka_append",
    action_sql("""SELECT '{"guid":' || guid || ',"event_id":"' || event_id || '","channel":"' || channel || '"}' AS value FROM action_event"""),
)
def sink_kafka_append(spark, folder):
    """The messages an append-only topic receives."""
    return M.append_messages(actions(spark, folder), ["guid", "event_id", "channel"])


@query(
    "sink_kafka_upsert",
    with_views(
        """SELECT CAST(id AS VARCHAR) AS key, CASE WHEN op <> '-D' THEN id || ',' || member_id || ',' || pay_type END AS value
           FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS rn FROM order_changes WHERE op <> '-U')
           WHERE rn = 1""",
        ORDER_CHANGES,
    ),
)
def sink_kafka_upsert(spark, folder):
    """The messages a keyed topic receives: newest row per key, null for a deleted one."""
    changes = order_changes(table(spark, folder, "orders"))
    return M.upsert_messages(changes, ["id"], ["id", "member_id", "pay_type"], ["seq"])


@query(
    "sink_upsert",
    action_sql("""SELECT guid, action_time, log_id, channel, event_id FROM (
        SELECT *, row_number() OVER (PARTITION BY guid ORDER BY action_time DESC, log_id DESC) AS rn FROM action_event) WHERE rn = 1"""),
)
def sink_upsert(spark, folder):
    """Three batches upserted one after the other, then the table as it stands."""
    path = scratch_folder(spark, "upsert")
    rows = actions(spark, folder).select("guid", "action_time", "log_id", "channel", "event_id", "ts")
    early, middle = "ts < TIMESTAMP_NTZ '2024-01-11'", "ts < TIMESTAMP_NTZ '2024-01-21'"
    for number, part in enumerate((early, f"NOT ({early}) AND {middle}", f"NOT ({middle}) OR ts IS NULL")):
        K.upsert_batch(rows.where(part).drop("ts"), path, ["guid"], ["action_time", "log_id"], number)
    return K.read_keyed(spark, path, ["guid"], ["action_time", "log_id"])


@query(
    "sink_warehouse",
    with_views(
        """SELECT strftime(make_timestamp(timestamp * 1000), '%Y-%m-%d') AS dw_date, count(*) AS cnt,
             count(DISTINCT deviceid) AS devices FROM app_log
           WHERE trim(deviceid) <> '' AND trim(eventid) <> '' AND page IS NOT NULL GROUP BY ALL""",
        APP_LOG,
    ),
)
def sink_warehouse(spark, folder):
    """Clean log rows written by day, then counted from the table."""
    path = scratch_folder(spark, "warehouse")
    day = F.date_format(local_time(F.col("timestamp")), "yyyy-MM-dd")
    rows = app_log(table(spark, folder, "events")).where(passes_gate()).drop("properties")
    K.write_dated(rows.withColumn("dw_date", day), path)
    stored = spark.read.schema(T.StructType.fromDDL("deviceid STRING, dw_date STRING")).parquet(path)
    return stored.groupBy("dw_date").agg(
        F.count(F.lit(1)).alias("cnt"), F.count_distinct("deviceid").alias("devices")
    )


@query("sink_insert_table", action_sql("SELECT event_id, count(*) * 2 AS cnt FROM action_event GROUP BY event_id"))
def sink_insert_table(spark, folder):
    """Rows appended twice to a catalog table, then counted by SQL."""
    name = f"tideline_{uuid.uuid4().hex}"
    rows = actions(spark, folder).select("guid", "event_id")
    path = scratch_folder(spark, "catalog")
    K.insert_into(rows, name, path)
    K.insert_into(rows, name, path)
    return spark.sql(f"SELECT event_id, count(*) AS cnt FROM {name} GROUP BY event_id")
