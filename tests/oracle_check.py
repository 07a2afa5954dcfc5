"""Compare registered queries with their SQL on DuckDB.

``python -m tests.oracle_check [folder] [query ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float) and v == 0:
        return 0.0
    return v


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cells = [tuple(_cell(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(cells, key=repr)


def compare(df, con, sql) -> str | None:
    """None when both agree, else what differs."""
    left = _sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    right = _sorted_rows(names, result.fetchall())
    if left[0] != right[0]:
        return f"columns {left[0]} against {right[0]}"
    if len(left[1]) != len(right[1]):
        return f"{len(left[1])} rows against {len(right[1])}"
    if repr(left[1]) != repr(right[1]):
        wrong = [(a, b) for a, b in zip(left[1], right[1]) if repr(a) != repr(b)]
        return f"{len(wrong)} rows differ, such as {str(wrong[0])[:900]}"
    return None


def main() -> None:
    import __spark_entry__ as registered
    from vanewright.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session("oracle-check")
    con = connect(folder)
    oracles = registered.oracle_sql()
    bad = 0
    for name, query in registered.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            if name in oracles:
                problem = compare(query(spark, folder), con, oracles[name])
            else:
                problem = None if (n := query(spark, folder).count()) else f"{n} rows"
        except Exception as e:  # noqa: BLE001 - one broken query must not hide the others
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{bad} failed")


if __name__ == "__main__":
    main()
