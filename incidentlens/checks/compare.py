"""Compare a Spark query with its DuckDB oracle: row count, column names/types, and the
multiset of rows (order-insensitive), the way the external correctness gate does."""

from __future__ import annotations

import datetime as dt
import decimal
from collections import Counter

from pyspark.sql import DataFrame

from ..sources.fixtures import SOURCE_TABLES

SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "date": "DATE",
                 "timestamp_ntz": "TIMESTAMP", "double": "DOUBLE", "boolean": "BOOLEAN",
                 "smallint": "SMALLINT", "tinyint": "TINYINT", "float": "FLOAT"}


def duck_connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in SOURCE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 9)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def compare(df: DataFrame, sql: str, con) -> dict:
    spark_cols = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    rows = [tuple(_norm(v) for v in r) for r in df.collect()]
    cur = con.execute(sql)
    duck_cols = [(d[0], str(d[1])) for d in cur.description]
    drows = [tuple(_norm(v) for v in r) for r in cur.fetchall()]
    names_ok = [c for c, _ in spark_cols] == [c for c, _ in duck_cols]
    types_ok = all(SPARK_TO_DUCK.get(a, a).upper() == b.upper() for (_, a), (_, b) in zip(spark_cols, duck_cols))
    ca, cb = Counter(rows), Counter(drows)
    only_spark = list((ca - cb).elements())[:5]
    only_duck = list((cb - ca).elements())[:5]
    return {"rows_spark": len(rows), "rows_duck": len(drows), "names_ok": names_ok, "types_ok": types_ok,
            "values_ok": ca == cb, "spark_schema": spark_cols, "duck_schema": duck_cols,
            "only_spark": only_spark, "only_duck": only_duck}
