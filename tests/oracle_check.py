"""Compare registered queries with their SQL counterparts.

    python tests/oracle_check.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def normalized(df: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, rows in order, dates and numbers as plain texts."""
    out = pd.DataFrame()
    for c in sorted(df.columns):
        s = df[c]
        if pd.api.types.is_bool_dtype(s):
            s = s.astype(object)
        elif pd.api.types.is_numeric_dtype(s):
            s = s.astype(float).map(lambda x: None if pd.isna(x) else repr(float(x)))
        elif pd.api.types.is_datetime64_any_dtype(s):
            s = s.map(lambda x: None if pd.isna(x) else str(x)[:19])
        elif len(s) and hasattr(s.dropna().iloc[0] if s.notna().any() else None, "isoformat"):
            s = s.map(lambda x: None if pd.isna(x) else f"{pd.Timestamp(x)}"[:19])
        out[c] = s.map(lambda x: "∅" if x is None or x is pd.NA or (isinstance(x, float) and pd.isna(x)) else str(x))
    return out.sort_values(list(out.columns)).reset_index(drop=True) if len(out.columns) else out


def difference(spark_df, oracle_df: pd.DataFrame) -> str | None:
    got, want = normalized(spark_df.toPandas()), normalized(oracle_df)
    if list(got.columns) != list(want.columns):
        return f"columns {list(got.columns)} != {list(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    bad = (got != want).any(axis=1)
    if bad.any():
        i = bad[bad].index[0]
        return f"{int(bad.sum())} of {len(got)} rows differ, first\n  {got.loc[i].to_dict()}\n  {want.loc[i].to_dict()}"
    return None


def main() -> int:
    import __spark_entry__ as entry
    from barline.session import build_session

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = build_session(
        master="local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g",
        spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(args.sf)
    queries, oracle = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in args.names or queries:
        t0 = time.time()
        try:
            df = queries[name](spark, args.sf)
            if name in oracle:
                t1 = time.time()
                want = con.execute(oracle[name]).df()
                t2 = time.time()
                diff = difference(df, want)
                note = f"rows={len(want)} duckdb={t2 - t1:.1f}s"
            else:
                diff, note = None, f"rows={df.count()} (no SQL)"
        except Exception as exc:  # report and go on with the next query
            diff, note = f"{type(exc).__name__}: {str(exc)[:600]}", ""
        failed += diff is not None
        print(f"{'FAIL' if diff else 'ok  '} {name} {note} {time.time() - t0:.1f}s {diff or ''}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
