"""Run named queries and their SQL twins and report differences.

    python tests/compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

_FAMILY = {
    "tinyint": "int", "smallint": "int", "int": "int", "integer": "int", "bigint": "bigint", "hugeint": "hugeint",
    "double": "double", "float": "double", "string": "string", "varchar": "string", "boolean": "boolean",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when names, types and the multiset of rows agree."""
    rel = con.sql(sql)
    names = sorted(df.columns)
    if names != sorted(rel.columns):
        return f"columns {names} vs {sorted(rel.columns)}"
    ours = {n: _FAMILY.get(t, t) for n, t in df.dtypes}
    theirs = {n: _FAMILY.get(str(t).lower(), str(t).lower()) for n, t in zip(rel.columns, rel.types)}
    if ours != theirs:
        return "types " + ", ".join(f"{n}: {ours[n]}/{theirs[n]}" for n in names if ours[n] != theirs[n])
    key = lambda row: tuple((v is not None, str(type(v)), v) for v in row)
    a = sorted((tuple(r[n] for n in names) for r in df.collect()), key=key)
    b = sorted(rel.select(*[f'"{n}"' for n in names]).fetchall(), key=key)
    if len(a) != len(b):
        return f"rows {len(a)} vs {len(b)}"
    for x, y in zip(a, b):
        if x != y:
            return f"{x} vs {y}"
    return None


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from pulsefeed.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(queries())
    spark = build_session(
        "compare", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
           "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sql = oracle_sql()
    bad = 0
    for name in chosen:
        start = time.time()
        try:
            df = queries()[name](spark, sf_dir)
            problem = difference(df, con, sql[name]) if name in sql else "no SQL twin"
        except Exception as e:  # report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {time.time() - start:6.2f}s {name} {problem or ''}", flush=True)
    print(f"{len(chosen) - bad} of {len(chosen)} agree")
    return int(bad > 0)


if __name__ == "__main__":
    sys.exit(main())
