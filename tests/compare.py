"""Run a registered query and its oracle and compare the two as sets of rows."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _key(row: tuple) -> tuple:
    return tuple((value is None, str(value)) for value in row)


def _same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or (math.isnan(a) and math.isnan(b))
    return a == b and type(a) is type(b)


def compare(spark, con, query, sql: str, sf_dir: str) -> str | None:
    """None when equal, otherwise the first difference."""
    df = query(spark, sf_dir)
    names = sorted(df.columns)
    got = sorted((tuple(r) for r in df.select(*names).collect()), key=_key)
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    if sorted(columns) != names:
        return f"columns {names} against {sorted(columns)}"
    order = [columns.index(n) for n in names]
    want = sorted((tuple(r[i] for i in order) for r in cursor.fetchall()), key=_key)
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if not all(map(_same, g, w))]
    if bad:
        g, w = bad[0]
        cells = [(n, x, y) for n, x, y in zip(names, g, w) if not _same(x, y)]
        return f"{len(bad)} of {len(got)} rows differ, first: {cells}"
    return None


if __name__ == "__main__":
    import __spark_entry__ as registry
    from tallymart.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.001"
    folder = f"/root/testdata/sf{sf}"
    wanted = sys.argv[2:]
    spark, con = local_session(8), oracle_connection(folder)
    sqls, failed = registry.oracle_sql(), 0
    for name, query in registry.queries().items():
        if wanted and name not in wanted:
            continue
        begin = time.time()
        try:
            if name in sqls:
                problem = compare(spark, con, query, sqls[name], folder)
            else:
                problem = None if query(spark, folder).count() else "no rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        failed += problem is not None
        print(f"{name:32} {time.time() - begin:6.2f}s {problem or 'ok'}", flush=True)
    print("failed:", failed)
