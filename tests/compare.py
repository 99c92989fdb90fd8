"""Run registered queries and their SQL side by side: python tests/compare.py FOLDER [name ...]"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(folder):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


spark_done = 0.0


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v + 0.0
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_cell(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def difference(spark, con, name, folder):
    """None when both sides agree, else a description; values must be equal."""
    import __spark_entry__ as e

    df = e.queries()[name](spark, folder)
    rows = df.collect()
    global spark_done
    spark_done = time.time()
    got = _rows(df.columns, [tuple(r) for r in rows])
    res = con.execute(e.oracle_sql()[name])
    want = _rows([d[0] for d in res.description], res.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} / {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} / {len(want[1])}"
    bad = [(a, b) for a, b in zip(got[1], want[1]) if a != b]
    return f"{len(bad)} of {len(got[1])} rows differ, first {bad[0]}"[:600] if bad else None


if __name__ == "__main__":
    import __spark_entry__ as e
    from texttrend.session import local_session

    folder, names = sys.argv[1], sys.argv[2:] or list(e.queries())
    spark, con, failed = local_session(8), duck(folder), 0
    for n in names:
        start = time.time()
        try:
            found = difference(spark, con, n, folder)
        except Exception as exc:
            found = f"{type(exc).__name__}: {str(exc)[:700]}"
        failed += found is not None
        print(f"{n:24s} {spark_done - start:6.2f}s of {time.time() - start:6.2f}s {'ok' if found is None else 'DIFF ' + found}", flush=True)
    print("failed", failed, "of", len(names))
    print("without SQL:", sorted(set(e.queries()) - set(e.oracle_sql())), "without query:", sorted(set(e.oracle_sql()) - set(e.queries())))
