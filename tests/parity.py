"""Compare a registered query with its SQL text, order-insensitively and exactly."""

from __future__ import annotations

import datetime
import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
KINDS = {"INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean",
         "FLOAT": "float", "HUGEINT": "hugeint"}


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET threads TO 4")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat()
    return repr(v)


def spark_rows(df):
    cols = sorted(df.columns)
    rows = sorted(tuple(_cell(r[c]) for c in cols) for r in df.collect())
    types = dict(df.dtypes)
    return cols, [types[c] for c in cols], rows


def duck_rows(con, sql):
    rel = con.sql(sql)
    cols = sorted(rel.columns)
    pos = [rel.columns.index(c) for c in cols]
    types = [KINDS.get(str(rel.types[p]), str(rel.types[p])) for p in pos]
    rows = sorted(tuple(_cell(r[p]) for p in pos) for r in rel.fetchall())
    return cols, types, rows


def compare(spark, con, sf_dir, fn, sql) -> str | None:
    """None when equal, else a short description of the difference."""
    sc, st, sr = spark_rows(fn(spark, sf_dir))
    if sql is None:
        return None if sr else "no rows"
    dc, dt, dr = duck_rows(con, sql)
    if sc != dc:
        return f"columns {sc} vs {dc}"
    if st != dt:
        return f"types {list(zip(sc, st, dt))}"
    if len(sr) != len(dr):
        return f"rows {len(sr)} vs {len(dr)}"
    bad = [(a, b) for a, b in zip(sr, dr) if a != b]
    return f"{len(bad)}/{len(sr)} rows differ, e.g. {bad[0][0]} vs {bad[0][1]}" if bad else None


def main(argv):
    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as entry
    from tests.session import make_session
    sf = argv[0]
    pats = argv[1:]
    spark = make_session()
    con = connect(sf)
    oracles = entry.oracle_sql()
    failed = []
    for name, fn in entry.queries().items():
        if pats and not any(p in name for p in pats):
            continue
        t = time.time()
        try:
            diff = compare(spark, con, sf, fn, oracles.get(name))
        except Exception as e:  # noqa: BLE001
            diff = f"ERROR {type(e).__name__}: {str(e)[:600]}"
        mark = "ok  " if diff is None else "FAIL"
        print(f"{mark} {name:28s} {time.time() - t:6.2f}s {'' if name in oracles else '(rows only) '}{diff or ''}", flush=True)
        if diff:
            failed.append(name)
    print("failed:", failed)


if __name__ == "__main__":
    main(sys.argv[1:])
