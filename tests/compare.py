"""Runs registered queries beside their SQL in DuckDB and compares whole results."""

from __future__ import annotations

import math
import os
import sys
import time
from decimal import Decimal

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}'")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.12g}") + 0.0
    if hasattr(v, "asDict"):
        v = v.asDict()
    if isinstance(v, dict):
        return tuple((k, norm(x)) for k, x in v.items())
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if hasattr(v, "isoformat"):
        return v.isoformat()[:26].replace("T", " ")
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(norm(row[i]) for i in order) for row in rows]
    return sorted(out, key=repr)


def compare(entry, spark, sf_dir, con) -> str | None:
    df = entry.run(spark, sf_dir)
    got = rows_of(df.columns, [tuple(x) for x in df.collect()])
    if not entry.sql:
        return None if got else "no rows"
    cur = con.execute(entry.sql)
    names = [d[0] for d in cur.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    want = rows_of(names, cur.fetchall())
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(bad)} rows differ: {bad[:3]}" if bad else None


def main() -> None:
    from salescope.plans.registry import ENTRIES
    from salescope.session import build_session

    sf_dir = sys.argv[1]
    wanted = sys.argv[2:]
    spark = build_session(
        master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.enabled": "false",
           "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    failed = 0
    for name, entry in ENTRIES.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        t = time.time()
        try:
            problem = compare(entry, spark, sf_dir, con)
        except Exception as exc:  # report and go on with the next query
            problem = f"{type(exc).__name__}: {str(exc)[:1500]}"
        kind = "sql" if entry.sql else "rows"
        print(f"{'FAIL' if problem else 'ok  '} {name} [{kind}] {time.time() - t:.1f}s {problem or ''}", flush=True)
        failed += bool(problem)
    print("failed:", failed)


if __name__ == "__main__":
    main()
