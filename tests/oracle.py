"""Compare registered queries with their SQL counterparts in DuckDB."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(value)
    if hasattr(value, "asDict"):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(plain(v) for v in value.values())
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(out, key=repr)


def compare(df, con, sql: str) -> str:
    """Empty when equal, else a short description of the difference."""
    got_cols, got = normal([tuple(r) for r in df.collect()], df.columns)
    res = con.execute(sql)
    exp_cols, exp = normal(res.fetchall(), [d[0] for d in res.description])
    if got_cols != exp_cols:
        return f"columns {got_cols} != {exp_cols}"
    if len(got) != len(exp):
        return f"rows {len(got)} != {len(exp)}; first {got[:1]} / {exp[:1]}"
    bad = [(g, e) for g, e in zip(got, exp) if repr(g) != repr(e)]
    if bad:
        return f"{len(bad)} of {len(got)} rows differ, e.g. {bad[0][0]} != {bad[0][1]}"
    return "" if got else "EMPTY"


def main(sf_dir: str, names: list[str]) -> int:
    root = str(Path(__file__).resolve().parent.parent)
    sys.path.insert(0, root)
    import __spark_entry__ as entry
    from fleetlens.session import build_session

    spark = build_session("oracle", "local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, failed = connect(sf_dir), entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if names and not any(name.startswith(n) for n in names):
            continue
        start = time.time()
        try:
            if name in sqls:
                verdict = compare(fn(spark, sf_dir), con, sqls[name]) or "ok"
            else:
                verdict = f"rows-only {len(fn(spark, sf_dir).collect())}"
        except Exception as exc:  # report and go on
            verdict = f"ERROR {type(exc).__name__}: {str(exc)[:700]}"
        failed += not verdict.startswith(("ok", "rows-only"))
        print(f"{name:34s} {time.time() - start:6.2f}s  {verdict}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
