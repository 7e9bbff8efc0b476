"""Compare registered queries with their SQL on DuckDB: `python tests/oracle_check.py SF [name ...]`."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(v):
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, dict):
        return tuple((k, _plain(x)) for k, x in v.items())
    if isinstance(v, (list, tuple)):
        return tuple(_plain(x) for x in v)
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float) and v == 0:
        return 0.0
    return v


def rows_of(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    out = [tuple(_plain(v) for v in r) for r in pdf[cols].astype(object).itertuples(index=False)]
    return sorted(out, key=repr)


def compare(spark_pdf: pd.DataFrame, sql_pdf: pd.DataFrame) -> str | None:
    """None when equal, else what differs first."""
    if sorted(spark_pdf.columns) != sorted(sql_pdf.columns):
        return f"columns {sorted(spark_pdf.columns)} vs {sorted(sql_pdf.columns)}"
    a, b = rows_of(spark_pdf), rows_of(sql_pdf)
    if len(a) != len(b):
        return f"rows {len(a)} vs {len(b)}"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        x, y = bad[0]
        cells = [(c, p, q) for c, p, q in zip(sorted(spark_pdf.columns), x, y) if p != q][:4]
        return f"{len(bad)} of {len(a)} rows differ, first: {cells}"
    kinds = {c: (spark_pdf[c].dtype, sql_pdf[c].dtype) for c in spark_pdf.columns
             if spark_pdf[c].dtype.kind != sql_pdf[c].dtype.kind and not spark_pdf[c].isna().any()}
    return f"types {kinds}" if kinds else None


def main() -> None:
    root = Path(__file__).resolve().parents[1]
    sys.path.insert(0, str(root))
    import __spark_entry__ as entry
    from wearline.session import build_session

    sf_dir = f"/root/testdata/sf{sys.argv[1]}"
    queries, sqls = entry.queries(), entry.oracle_sql()
    names = sys.argv[2:] or list(queries)
    spark = build_session("oracle-check", "local[8]", 8, "12g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = []
    for name in names:
        t0 = time.time()
        try:
            got = queries[name](spark, sf_dir).toPandas()
            t1 = time.time()
            if name in sqls:
                problem = compare(got, con.execute(sqls[name]).df())
                verdict = problem or "equal"
            else:
                problem, verdict = None, "rows only"
            print(f"{name:32s} {len(got):8d} rows spark {t1 - t0:6.1f}s sql {time.time() - t1:6.1f}s  {verdict}", flush=True)
        except Exception as e:  # report and go on with the next query
            problem = repr(e)[:600]
            print(f"{name:32s} ERROR {problem}", flush=True)
        if problem:
            failed.append(name)
    print("failed:", failed)
    sys.exit(1 if failed else 0)


if __name__ == "__main__":
    main()
