"""Run registered queries against their SQL: ``python tests/check_queries.py [sf] [name...]``."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as spark_entry  # noqa: E402

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, int) and not isinstance(v, bool):
        return repr(float(v)) if abs(v) < 2 ** 53 else repr(v)
    return repr(v)


def _bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(r[i]) for i in order) for r in rows)


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when equal, else what differs."""
    got = [tuple(r) for r in df.collect()]
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    want = result.fetchall()
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(set(df.columns) ^ set(columns))}"
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    left, right = _bag(df.columns, got), _bag(columns, want)
    if left != right:
        extra, missing = list((left - right).elements()), list((right - left).elements())
        return f"{len(extra)} rows differ, e.g. {str(extra[0])[:300]} / {str(missing[0])[:300]}"
    return None


def main() -> None:
    from tests.conftest import make_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.001"
    names = sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark, con = make_session(), connect(sf_dir)
    sqls = spark_entry.oracle_sql()
    bad = 0
    for name, run in spark_entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            if name in sqls:
                problem = compare(df, con, sqls[name])
                outcome = "ok" if problem is None else f"DIFFERS {problem}"
                bad += problem is not None
            else:
                outcome = f"ran, {len(df.collect())} rows"
        except Exception as e:  # report and go on with the next query
            outcome, bad = f"FAILED {type(e).__name__}: {str(e)[:600]}", bad + 1
        print(f"{name:28s} {time.time() - start:6.1f}s {outcome}", flush=True)
    print(f"{bad} problems")


if __name__ == "__main__":
    main()
