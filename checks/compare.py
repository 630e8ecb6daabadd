"""Run the registered queries against their SQL twins: ``python -m checks.compare DIR [NAME ...]``."""

from __future__ import annotations

import sys
import time

import duckdb

from checks.oracles import ORACLES
from checks.queries import QUERIES
from spendlens.session import build_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def _rows(columns: list[str], rows) -> list[str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([row[i] for i in order]) for row in rows)


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def compare(spark, con, sf_dir: str, name: str) -> str | None:
    """None when both sides agree, else what differs."""
    df = QUERIES[name](spark, sf_dir)
    spark_rows = _rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(ORACLES[name])
    columns = [c[0] for c in cur.description]
    sql_rows = _rows(columns, cur.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} <> {sorted(columns)}"
    if spark_rows != sql_rows:
        left = [r for r in spark_rows if r not in set(sql_rows)][:2]
        right = [r for r in sql_rows if r not in set(spark_rows)][:2]
        return f"{len(spark_rows)} <> {len(sql_rows)} rows; only Spark {left}; only SQL {right}"
    if not sql_rows:
        return "both are empty"
    return None


def main() -> int:
    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = build_session(
        "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g",
           "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for name in names or QUERIES:
        start = time.time()
        if name not in ORACLES:
            n = QUERIES[name](spark, sf_dir).count()
            print(f"rows {name}: {n} {time.time() - start:.1f}s", flush=True)
            continue
        try:
            difference = compare(spark, con, sf_dir, name)
        except Exception as exc:  # noqa: BLE001 - report and go on
            difference = f"{type(exc).__name__}: {str(exc)[:600]}"
        bad += difference is not None
        print(f"{'ok  ' if difference is None else 'DIFF'} {name} {time.time() - start:.1f}s {difference or ''}", flush=True)
    print(f"{bad} differences", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
