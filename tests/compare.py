"""Run a registered query and its SQL check side by side and compare every value.

    python -m tests.compare /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import datetime
import glob
import math
import os
import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb
from pyspark.sql import SparkSession


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, Decimal):
        value = int(value) if value == value.to_integral_value() else float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(glob.glob(os.path.join(folder, "*.parquet"))):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


KINDS = {
    "bigint": "int", "int": "int", "smallint": "int", "tinyint": "int",
    "double": "float", "float": "float", "string": "text", "boolean": "bool",
    "date": "date", "timestamp_ntz": "time", "timestamp": "time",
}
DUCK_KINDS = {
    "BIGINT": "int", "INTEGER": "int", "HUGEINT": "huge", "DOUBLE": "float", "FLOAT": "float",
    "VARCHAR": "text", "BOOLEAN": "bool", "DATE": "date", "TIMESTAMP": "time",
}


def compare(spark: SparkSession, folder: str, run, sql: str | None) -> str:
    """An empty string when both sides agree, otherwise what differs."""
    frame = run(spark, folder)
    columns = sorted(frame.columns)
    kinds = {c: KINDS.get(t, t) for c, t in frame.dtypes}
    got = Counter(tuple(plain(row[c]) for c in columns) for row in frame.collect())
    if sql is None:
        return "" if got else "no rows"
    cursor = duck(folder).execute(sql)
    names = [d[0] for d in cursor.description]
    types = {d[0]: DUCK_KINDS.get(str(d[1]).upper(), str(d[1])) for d in cursor.description}
    rows = cursor.fetchall()
    if sorted(names) != columns:
        return f"columns {columns} against {sorted(names)}"
    differing = {c: (kinds[c], types[c]) for c in columns if kinds[c] != types[c]}
    if differing:
        return f"types (ours, SQL) differ: {differing}"
    index = [names.index(c) for c in columns]
    want = Counter(tuple(plain(row[i]) for i in index) for row in rows)
    if got == want:
        return "" if got else "no rows on either side"
    only_got, only_want = list((got - want).elements()), list((want - got).elements())
    return (
        f"{sum(got.values())} rows against {sum(want.values())}; columns {columns}; "
        f"only ours {sorted(only_got, key=str)[:3]}; only SQL {sorted(only_want, key=str)[:3]}"
    )


def main() -> int:
    import __spark_entry__ as entry

    from tideline.session import build_session

    folder, wanted = sys.argv[1], sys.argv[2:]
    spark = build_session(
        "compare",
        "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
           "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("OFF")
    oracles, failed = entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        began = time.time()
        try:
            problem = compare(spark, folder, run, oracles.get(name))
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:900]}"
        state = "ok  " if not problem else "FAIL"
        failed += bool(problem)
        print(f"{state} {name} {time.time() - began:.1f}s {'' if name in oracles else '(no SQL)'} {problem}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main())
