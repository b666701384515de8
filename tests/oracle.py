"""Run registered queries beside their SQL in DuckDB and compare the rows."""

from __future__ import annotations

import math
import sys
import time

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _value(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 5) + 0.0
    if isinstance(v, int):
        return float(v)
    return str(v)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_value(r[i]) for i in order) for r in data]
    return sorted(columns), sorted(out, key=repr)


def compare(spark, con, sf_dir, build, check):
    df = build(spark, sf_dir)
    got_cols, got = rows(df.columns, [tuple(r) for r in df.collect()])
    if check is None:
        return len(got), None
    cur = con.execute(check)
    want_cols, want = rows([d[0] for d in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return len(got), f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        return len(got), f"rows {len(got)} != {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            near = all(
                a == b or (isinstance(a, float) and isinstance(b, float) and abs(a - b) < 2e-5)
                for a, b in zip(g, w)
            )
            if not near:
                return len(got), f"first difference {g} != {w}"
    return len(got), None


def main(sf_dir, patterns):
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from geoloom import session

    conf = {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"}
    spark = session.build("check", "local[8]", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, checks = entry.queries(), entry.oracle_sql()
    failed = 0
    for name, build in queries.items():
        if patterns and not any(name.startswith(p) for p in patterns):
            continue
        start = time.time()
        try:
            n, problem = compare(spark, con, sf_dir, build, checks.get(name))
        except Exception as e:  # noqa: BLE001
            n, problem = -1, f"{type(e).__name__}: {str(e)[:1500]}"
        mark = "ok " if problem is None else "BAD"
        failed += problem is not None
        kind = "" if name in checks else " (rows only)"
        print(f"{mark} {name} rows={n} {time.time() - start:.1f}s{kind} {problem or ''}", flush=True)
    print("failed:", failed)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
