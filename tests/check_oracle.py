"""Run the queries next to their SQL and report differences.

    python tests/check_oracle.py [directory] [query ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (float, decimal.Decimal)):
        number = float(value)
        return "nan" if math.isnan(number) else round(number, 9)
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    return value


def _normal(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


def compare(con, df, sql: str) -> str | None:
    """None if equal, else what differs."""
    result = con.sql(sql)
    theirs_columns = list(result.columns)
    theirs_types = dict(zip(theirs_columns, [str(t) for t in result.types], strict=True))
    ours_columns = df.columns
    if sorted(ours_columns) != sorted(theirs_columns):
        return f"columns {sorted(ours_columns)} vs {sorted(theirs_columns)}"
    names = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR"}
    names |= {"date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}
    for column, kind in df.dtypes:
        if names.get(kind, kind) != theirs_types[column]:
            return f"type of {column}: {kind} vs {theirs_types[column]}"
    ours = _normal(ours_columns, [tuple(r) for r in df.collect()])
    theirs = _normal(theirs_columns, result.fetchall())
    if len(ours) != len(theirs):
        return f"rows {len(ours)} vs {len(theirs)}"
    for a, b in zip(ours, theirs, strict=True):
        if a != b:
            return f"first difference {a} vs {b}"
    return None


def main() -> int:
    import __spark_entry__ as entry
    from cartwise.session import build_session

    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    wanted = args[1:]
    spark = build_session(
        master="local[8]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracle, bad = entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            if name in oracle:
                problem = compare(con, df, oracle[name])
                verdict = "ok" if problem is None else f"DIFFERENT {problem}"
            else:
                verdict, problem = f"rows only: {df.count()}", None
        except Exception as error:
            problem = verdict = f"ERROR {type(error).__name__} {str(error)[:600]}"
        bad += problem is not None
        print(f"{name:32s} {time.time() - start:6.1f}s {verdict}", flush=True)
    print(f"{bad} problems; in oracle only: {sorted(set(oracle) - set(entry.queries()))}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
