"""Run queries against their SQL twins: ``python -m checks.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf: str):
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return float(f"{v:.9g}")
    return v


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, fn, sql, sf):
    """(rows, problem): problem is None when both sides hold the same bag of rows."""
    df = fn(spark, sf)
    got = _bag(df.columns, [tuple(r) for r in df.collect()])
    n = sum(got.values())
    if sql is None:
        return n, None
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return n, f"columns differ: {sorted(set(names) ^ set(df.columns))}"
    want = _bag(names, result.fetchall())
    if got == want:
        types = {type(v) for row in got for v in row} ^ {type(v) for row in want for v in row}
        return n, f"types differ: {types}" if types else None
    extra, missing = got - want, want - got
    return n, (f"{n} rows against {sum(want.values())}; columns {sorted(names)}\n  only Spark: {list(extra)[:2]}"
               f"\n  only SQL:   {list(missing)[:2]}")


def main(argv):
    from loantide.session import build_session

    from . import registry

    sf = argv[0] if argv else "/root/testdata/sf0.01"
    spark, con = build_session("compare", "8"), connect(sf)
    twins, failed = registry.sql_twins(), []
    for name, fn in registry.spark_queries().items():
        if argv[1:] and name not in argv[1:]:
            continue
        start = time.time()
        try:
            rows, problem = compare(spark, con, fn, twins.get(name), sf)
        except Exception as error:  # report and go on with the next query
            rows, problem = 0, f"{type(error).__name__}: {str(error)[:1500]}"
        mark = "ok" if problem is None else "DIFF"
        kind = "sql" if name in twins else "rows"
        print(f"{mark:4} {kind} {name:32} {rows:7} rows {time.time() - start:6.2f}s", flush=True)
        if problem:
            print("  " + problem, flush=True)
            failed.append(name)
    print(f"{len(failed)} failed: {failed}")
    spark.stop()
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
