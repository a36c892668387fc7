"""Compare queries with their SQL: python tests/oracle_check.py SF_DIR [name ...]"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def sql_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def comparable(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        df[c] = df[c].map(lambda x: None if x is None or x is pd.NA or (isinstance(x, float) and x != x) else x)
        df[c] = df[c].astype(object)
        if df[c].map(lambda x: isinstance(x, (int, float)) and not isinstance(x, bool)).any():
            whole = all(float(x).is_integer() for x in df[c].dropna())
            df[c] = pd.Series([None if x is None or x != x else int(x) if whole else float(x) for x in df[c]], dtype=object)
    return df.sort_values(list(df.columns), key=lambda s: s.map(repr)).reset_index(drop=True)


def difference(actual: pd.DataFrame, expected: pd.DataFrame) -> str | None:
    if sorted(actual.columns) != sorted(expected.columns):
        return f"columns {sorted(actual.columns)} != {sorted(expected.columns)}"
    if len(actual) != len(expected):
        return f"rows {len(actual)} != {len(expected)}"
    a, b = comparable(actual), comparable(expected)
    for c in a.columns:
        bad = [(x, y) for x, y in zip(a[c], b[c], strict=True) if not (x == y or (x is None and y is None))]
        if bad:
            return f"column {c}: {len(bad)} of {len(a)} differ, e.g. {bad[:3]}"
    return None


def kinds(spark_type: str) -> str:
    return {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}.get(spark_type, spark_type)


def check(spark, con, name: str, sf_dir: str, queries, oracles) -> str:
    start = time.time()
    df = queries[name](spark, sf_dir)
    actual = df.toPandas()
    took = time.time() - start
    if name not in oracles:
        return f"rows-only {len(actual)} rows {took:.2f}s"
    relation = con.sql(oracles[name])
    expected = relation.df()
    problem = difference(actual, expected)
    types = dict(zip(relation.columns, [str(t) for t in relation.types], strict=True))
    odd = {c: (t, types.get(c)) for c, t in df.dtypes if kinds(t) != types.get(c)}
    return (f"FAIL {problem}" if problem else f"ok {len(actual)} rows {took:.2f}s") + (f" types {odd}" if odd else "")


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from forumlens.session import build_session

    session = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.enabled": "false"})
    session.sparkContext.setLogLevel("ERROR")
    folder, names = sys.argv[1], sys.argv[2:] or list(queries())
    connection = sql_connection(folder)
    failed = 0
    for n in names:
        try:
            line = check(session, connection, n, folder, queries(), oracle_sql())
        except Exception as e:  # noqa: BLE001
            line = f"FAIL {type(e).__name__}: {str(e)[:600]}"
        failed += line.startswith("FAIL")
        print(f"{n}: {line}", flush=True)
    print(f"{len(names)} queries, {failed} failed")
