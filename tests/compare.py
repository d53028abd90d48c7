"""Side-by-side run of a registered query and its checking SQL."""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import tempfile
import time
from decimal import Decimal

import duckdb

sys.path.insert(0, __file__.rsplit("/", 2)[0])

from linkscore.catalog.data import TABLES  # noqa: E402


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    # a query beyond fails instead of ending the run
    con.execute("SET memory_limit = '6GB'")
    con.execute(f"SET temp_directory = '{tempfile.mkdtemp(prefix='compare-')}'")
    con.execute("SET max_temp_directory_size = '2GB'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if v == int(v) and abs(v) < 1e15:
            return repr(float(v))
        return repr(v)
    if isinstance(v, int):
        return f"i{v}"
    if isinstance(v, dt.datetime) and v.tzinfo is not None:
        v = v.astimezone(dt.timezone.utc).replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(plain(x) for x in v) + "]"
    return str(v)


def rows_of(names, rows):
    at = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(r[i]) for i in at) for r in rows)


def check(spark, con, name, fn, oracle, sf_dir):
    t0 = time.time()
    df = fn(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    took = time.time() - t0
    if oracle is None:
        return len(got) > 0, f"rows={len(got)} {took:.1f}s rows-only"
    t1 = time.time()
    rel = con.execute(oracle)
    names = [d[0] for d in rel.description]
    want = rel.fetchall()
    took2 = time.time() - t1
    note = f"rows={len(got)}/{len(want)} {took:.1f}s/{took2:.1f}s"
    if sorted(names) != sorted(df.columns):
        return False, f"{note} columns {sorted(df.columns)} vs {sorted(names)}"
    a, b = rows_of(df.columns, got), rows_of(names, want)
    if a != b:
        extra = [x for x in a if x not in set(b)][:2]
        missing = [x for x in b if x not in set(a)][:2]
        return False, f"{note} values spark={extra} sql={missing}"
    return True, note


def main(argv):
    import __spark_entry__ as entry

    from linkscore.runtime import local_session

    sf = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
    names = argv or list(entry.queries())
    spark = local_session()
    con = connect(sf)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for pattern in names:
        for n in [q for q in queries if q.startswith(pattern)]:
            try:
                ok, note = check(spark, con, n, queries[n], oracles.get(n), sf)
            except Exception as e:  # report and go on with the next query
                ok, note = False, f"{type(e).__name__}: {str(e)[:700]}"
            bad += not ok
            print("ok  " if ok else "FAIL", n, note, flush=True)
    print("failed:", bad, flush=True)


if __name__ == "__main__":
    main(sys.argv[1:])
