"""Comparison helpers shared by the tests."""

import datetime as dt
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events").split()


def duck(sf_dir: str, **paths: str) -> duckdb.DuckDBPyConnection:
    """Views of the tables below ``sf_dir``; ``paths`` name files kept elsewhere."""
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{paths.get(t, f'{sf_dir}/{t}.parquet')}')")
    return con


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=lambda r: [repr(x) for x in r])
    return [cols[i] for i in order], out


SPARK_TO_DUCK = {"LongType": "BIGINT", "IntegerType": "INTEGER", "DoubleType": "DOUBLE",
                 "StringType": "VARCHAR", "DateType": "DATE", "TimestampNTZType": "TIMESTAMP",
                 "BooleanType": "BOOLEAN"}


def same(spark_df, con, sql):
    """Same column names, column types and rows (order-insensitive)."""
    c1, r1 = canon(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cur = con.execute(sql)
    t2 = {d[0]: str(d[1]) for d in cur.description}
    c2, r2 = canon([d[0] for d in cur.description], cur.fetchall())
    t1 = {f.name: SPARK_TO_DUCK.get(type(f.dataType).__name__, str(f.dataType)) for f in spark_df.schema.fields}
    return c1 == c2 and r1 == r2 and t1 == t2, (c1, c2, r1[:3], r2[:3], t1, t2)
