"""Compare every registered query with its DuckDB oracle.

usage: python tools/oracle_check.py [sf_dir] [query ...]

For each query: row counts, column names, and values (columns sorted by
name, rows sorted) with exact comparison and a 1e-9 float tolerance.
"""

from __future__ import annotations

import math
import sys
import time

import duckdb
import pandas as pd

from rankflow.plans import oracle, registry
from rankflow.session import local_session

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return v.item()
        except Exception:  # noqa: BLE001
            return v
    return v


def rows_of(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    out = []
    for rec in df[cols].itertuples(index=False):
        out.append(tuple(norm(x) for x in rec))
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def close(a, b) -> bool:
    if a == b:
        return True
    if isinstance(a, (int, float)) and isinstance(b, (int, float)) and not isinstance(a, bool):
        return abs(float(a) - float(b)) <= 1e-9 * max(1.0, abs(float(a)), abs(float(b)))
    return str(a) == str(b)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    spark = local_session(8)
    qs = registry.queries()
    for name, sql in oracle.ORACLE.items():
        if only and name not in only:
            continue
        t0 = time.time()
        try:
            s = qs[name](spark, sf).toPandas()
        except Exception as e:  # noqa: BLE001
            print(f"SPARK-FAIL {name}: {str(e).splitlines()[0][:300]}")
            continue
        try:
            d = con.execute(sql).df()
        except Exception as e:  # noqa: BLE001
            print(f"SQL-FAIL   {name}: {str(e).splitlines()[0][:300]}")
            continue
        if sorted(s.columns) != sorted(d.columns):
            print(f"COLS       {name}: spark={sorted(s.columns)} sql={sorted(d.columns)}")
            continue
        tdiff = [(c, str(s[c].dtype), str(d[c].dtype)) for c in sorted(s.columns) if str(s[c].dtype) != str(d[c].dtype)]
        if tdiff:
            print(f"TYPES      {name}: {tdiff}")
        rs, rd = rows_of(s), rows_of(d)
        if len(rs) != len(rd):
            print(f"ROWS       {name}: spark={len(rs)} sql={len(rd)}")
            continue
        exact = sum(1 for a, b in zip(rs, rd) if a == b)
        near = sum(1 for a, b in zip(rs, rd) if all(close(x, y) for x, y in zip(a, b)))
        status = "MATCH" if exact == len(rs) else ("NEAR" if near == len(rs) else "DIFF")
        print(f"{status:10s} {name}: rows={len(rs)} exact={exact} near={near} {time.time() - t0:.1f}s", flush=True)
        if status == "DIFF":
            cols = sorted(s.columns)
            shown = 0
            for a, b in zip(rs, rd):
                if not all(close(x, y) for x, y in zip(a, b)):
                    diffs = [(c, x, y) for c, x, y in zip(cols, a, b) if not close(x, y)]
                    print("   ", diffs[:6])
                    shown += 1
                    if shown >= 3:
                        break


if __name__ == "__main__":
    main()
