"""Run a registered query in Spark and its SQL in DuckDB and compare the rows."""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("set TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def normal(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return value + 0.0
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(normal(r[i]) for i in order) for r in rows], key=repr)


def difference(spark, con, sf_dir, query, sql):
    """None when equal, else a short description."""
    df = query(spark, sf_dir)
    mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    theirs = rows_of(columns, result.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} <> {sorted(columns)}"
    if not mine:
        return "no rows"
    if len(mine) != len(theirs):
        return f"rows {len(mine)} <> {len(theirs)}"
    kinds = [tuple(type(v).__name__ for v in r) for r in (mine[0], theirs[0])]
    wrong = [(a, b) for a, b in zip(mine, theirs) if a != b]
    if wrong:
        pairs = [
            (c, x, y) for c, x, y in zip(sorted(columns), *wrong[0]) if x != y
        ]
        return f"{len(wrong)} of {len(mine)} rows differ, first: {pairs[:4]}"
    if kinds[0] != kinds[1]:
        return f"types {kinds[0]} <> {kinds[1]}"
    return None


def main(argv):
    from flowlab.session import local_session
    from __spark_entry__ import oracle_sql, queries

    sf_dir = argv[0]
    wanted = argv[1:]
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sql = oracle_sql()
    failed = 0
    for name, query in queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            if name in sql:
                problem = difference(spark, con, sf_dir, query, sql[name])
            else:
                n = query(spark, sf_dir).count()
                problem = None if n else "no rows"
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        failed += problem is not None
        mark = "ok " if problem is None else "BAD"
        kind = "sql" if name in sql else "rows"
        print(f"{mark} {kind} {time.time() - start:6.2f}s {name} {problem or ''}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main(sys.argv[1:])
