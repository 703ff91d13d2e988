"""Compare registered queries with their SQL oracles, strictly: names, types, rows.

Run as a script: ``python tests/oracle_check.py sf0.01 [key ...]``.
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
TYPES = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def difference(spark, con, sf_dir: str, query, sql: str) -> str | None:
    """None when both sides agree, else what differs."""
    ours, theirs = query(spark, sf_dir), con.execute(sql)
    names = [d[0] for d in theirs.description]
    if sorted(ours.columns) != sorted(names):
        return f"columns {sorted(ours.columns)} != {sorted(names)}"
    kinds = dict(zip(names, (str(d[1]) for d in theirs.description)))
    wrong = {n: (k, kinds[n]) for n, k in ours.dtypes if TYPES.get(k) != kinds[n]}
    if wrong:
        return f"types {wrong}"
    order = sorted(names)
    right = Counter(tuple(row[names.index(n)] for n in order) for row in theirs.fetchall())
    left = Counter(tuple(row[n] for n in order) for row in ours.collect())
    if left != right:
        extra, missing = list((left - right).items()), list((right - left).items())
        extra.sort(key=repr), missing.sort(key=repr)
        return (f"rows {sum(left.values())} vs {sum(right.values())}; {len(extra)} only ours, {len(missing)} only SQL; "
                f"{order}\n   ours {extra[:2]}\n   sql  {missing[:2]}")
    return None


def main() -> None:
    sys.path.insert(0, str(ROOT))
    import __spark_entry__ as registered
    from tests.conftest import local_session

    scale, *keys = sys.argv[1:]
    sf_dir = f"/root/testdata/{scale}"
    spark, con = local_session(), connect(sf_dir)
    queries, oracles = registered.queries(), registered.oracle_sql()
    bad = 0
    for key in keys or queries:
        start = time.time()
        if key not in oracles:
            print("NO SQL", key)
            continue
        try:
            found = difference(spark, con, sf_dir, queries[key], oracles[key])
        except Exception as problem:  # report and go on with the other keys
            found = f"{type(problem).__name__}: {str(problem)[:500]}"
        bad += found is not None
        print(f"{'ok  ' if found is None else 'DIFF'} {key:28s} {time.time() - start:6.2f}s {found or ''}", flush=True)
    print(f"{bad} differences")


if __name__ == "__main__":
    main()
