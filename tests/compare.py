"""Run a registered query in Spark and its SQL in DuckDB, and compare rows by value and type."""

from __future__ import annotations

import collections
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, float):
        return ("f", round(v, 6) + 0.0)
    return v


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return (
        [columns[i] for i in order],
        collections.Counter(tuple(_cell(r[i]) for i in order) for r in rows),
    )


def difference(spark, con, query, sql, sf_dir) -> str:
    """Empty if equal, else a short account of what differs."""
    df = query(spark, sf_dir)
    got_cols, got = _bag(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    want_cols, want = _bag([d[0] for d in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if got != want:
        return (
            f"rows {sum(got.values())} / {sum(want.values())}; "
            f"only Spark: {list((got - want).items())[:3]}; only SQL: {list((want - got).items())[:3]}"
        )
    return ""


if __name__ == "__main__":
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from tests.conftest import build_session

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark, con = build_session(), oracle_connection(sf_dir)
    bad = 0
    for name, query in entry.queries().items():
        if name not in (names or entry.oracle_sql()):
            continue
        started = time.monotonic()
        try:
            diff = difference(spark, con, query, entry.oracle_sql()[name], sf_dir)
        except Exception as err:  # report and go on with the next query
            diff = f"{type(err).__name__}: {str(err)[:600]}"
        bad += bool(diff)
        print(f"{'FAIL' if diff else 'ok  '} {name} {time.monotonic() - started:.1f}s {diff}", flush=True)
    print("failed:", bad)
    spark.stop()
