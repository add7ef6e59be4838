"""Run a registered query on Spark and its SQL check in DuckDB and compare the rows.

From the command line: python tests/compare.py FOLDER [name ...]
"""
from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from stockwright.suite.fixtures import TABLES  # noqa: E402


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def kind(s: pd.Series) -> str:
    if pd.api.types.is_bool_dtype(s):
        return "bool"
    if pd.api.types.is_integer_dtype(s):
        return "int"
    if pd.api.types.is_float_dtype(s):
        return "float"
    if pd.api.types.is_datetime64_any_dtype(s):
        return "time"
    return "object"


def normal(df: pd.DataFrame) -> pd.DataFrame:
    out = pd.DataFrame(index=df.index)
    for c in sorted(df.columns):
        s = df[c]
        k = kind(s)
        if k == "time":
            s = s.dt.tz_localize(None) if getattr(s.dt, "tz", None) is not None else s
            out[c] = s.astype("datetime64[us]").astype(str)
        elif k == "float":
            out[c] = s.map(lambda v: "null" if pd.isna(v) else repr(round(float(v), 6) + 0.0))
        else:
            def text(v):
                if v is None or v is pd.NaT or (not isinstance(v, (list, dict)) and pd.api.types.is_scalar(v) and pd.isna(v)):
                    return "null"
                if isinstance(v, (int, float)) and not isinstance(v, bool) and float(v) == int(v):
                    return repr(round(float(v), 6))
                if hasattr(v, "strftime"):
                    return pd.Timestamp(v).strftime("%Y-%m-%d %H:%M:%S")
                return str(v)
            if k == "int":
                out[c] = s.map(lambda v: "null" if pd.isna(v) else repr(float(v)))
            else:
                out[c] = s.map(text)
    out = out.replace({"NaT": "null"})
    for c in out.columns:
        out[c] = out[c].str.replace(" 00:00:00", "", regex=False)
    return out.sort_values(list(out.columns)).reset_index(drop=True)


def types(spark_df, relation) -> dict[str, tuple[str, str]]:
    same = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "date": "DATE", "boolean": "BOOLEAN",
            "timestamp": "TIMESTAMP", "smallint": "SMALLINT"}
    ddl = {f.name: f.dataType.simpleString() for f in spark_df.schema}
    duck_types = dict(zip(relation.columns, map(str, relation.types)))
    return {c: (ddl.get(c), duck_types.get(c)) for c in set(ddl) | set(duck_types) if same.get(ddl.get(c), ddl.get(c)) != duck_types.get(c)}


def check(spark, con, folder: str, name: str, query, sql: str | None, inspect=None) -> list[str]:
    df = query(spark, folder)
    if inspect:
        inspect(df)
    got = df.toPandas()
    if sql is None:
        return [] if len(got) else ["no rows"]
    rel = con.sql(sql)
    want = rel.df()
    bad = []
    if odd := types(df, rel):
        bad.append(f"types {odd}")
    if sorted(got.columns) != sorted(want.columns):
        return bad + [f"columns {sorted(got.columns)} / {sorted(want.columns)}"]
    if len(got) != len(want):
        bad.append(f"rows {len(got)} / {len(want)}")
    if not len(want):
        return bad + ["no rows"]
    a, b = normal(got), normal(want)
    if len(a) == len(b) and not a.equals(b):
        diff = (a != b).any(axis=1)
        bad.append(f"{int(diff.sum())} of {len(a)} rows differ, e.g.\n{a[diff].head(3).to_string()}\n{b[diff].head(3).to_string()}")
    elif len(a) != len(b):
        m = a.merge(b, how="outer", indicator=True)
        bad.append(m[m._merge != "both"].head(6).to_string())
    return bad


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    folder, names = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, failed = duck(folder), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if names and not any(name == n or (n.endswith("*") and name.startswith(n[:-1])) for n in names):
            continue
        t = time.time()
        try:
            bad = check(spark, con, folder, name, query, oracles.get(name))
        except Exception as e:  # noqa: BLE001
            bad = [f"{type(e).__name__}: {str(e)[:1500]}"]
        failed += bool(bad)
        print(f"{'BAD ' if bad else 'ok  '} {name} {time.time() - t:.1f}s" + ("" if name in oracles else " (rows only)"), *bad, sep="\n    " if bad else "", flush=True)
    print("failed:", failed)
