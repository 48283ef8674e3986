"""Run registered queries against their SQL twins: python tests/oracle_check.py [--sf 0.01] [names...]"""

from __future__ import annotations

import math
import sys
import time
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _norm(v):
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, (int, Decimal)):
        return ("i", int(v)) if v == int(v) else ("f", float(v))
    if isinstance(v, float):
        return ("f", "nan") if math.isnan(v) else ("f", v)
    if isinstance(v, (date, datetime)):
        return ("d", str(v))
    return ("s", str(v)) if v is not None else ("n", None)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def compare(df, con, sql: str) -> str | None:
    """None where both give the same columns, kinds and values, else what differs."""
    spark_columns, spark_rows = _rows(df.columns, [tuple(x) for x in df.collect()])
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    oracle_columns, oracle_rows = _rows(columns, result.fetchall())
    if spark_columns != oracle_columns:
        return f"columns {spark_columns} / {oracle_columns}"
    if len(spark_rows) != len(oracle_rows):
        return f"rows {len(spark_rows)} / {len(oracle_rows)}"
    if not spark_rows:
        return "no rows"
    for a, b in zip(spark_rows, oracle_rows):
        if a != b:
            return f"values {a} / {b}"
    return None


if __name__ == "__main__":
    import __spark_entry__ as entry
    from tests.conftest import session

    args = sys.argv[1:]
    sf = args[args.index("--sf") + 1] if "--sf" in args else "0.01"
    names = [a for a in args if not a.startswith("--") and a != sf]
    sf_dir = f"/root/testdata/sf{sf}"
    spark, con = session(), connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = []
    for name, fn in queries.items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            problem = compare(df, con, oracles[name]) if name in oracles else (None if df.count() else "no rows")
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        kind = "sql" if name in oracles else "rows"
        print(f"{'FAIL' if problem else 'ok  '} {kind} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
        failed += [name] if problem else []
    print(f"{len(failed)} failed: {failed}")
    sys.exit(bool(failed))
