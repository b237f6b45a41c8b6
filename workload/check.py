"""Run the queries and their SQL side by side: ``python -m workload.check [folder] [names...]``."""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time

import duckdb

from viewtide.session import local_session
from workload.catalog import QUERIES, SQL

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def normal(value):
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, (int, float, decimal.Decimal)):
        number = float(value)
        return "None" if math.isnan(number) else f"{number:.6g}" if abs(number) < 1 else f"{number:.6f}"
    if isinstance(value, (datetime.date, datetime.datetime)):
        return f"{type(value).__name__}:{value}"
    return str(value)


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(normal(row[i]) for i in order) for row in rows)


def main(folder: str, names: list[str]) -> int:
    spark = local_session()
    database = duckdb.connect()
    for name in TABLES:
        database.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    wrong = 0
    for name in names or QUERIES:
        start = time.time()
        df = QUERIES[name](spark, folder)
        rows = df.collect()
        seconds = time.time() - start
        verdict = "rows only"
        if name in SQL:
            result = database.execute(SQL[name])
            columns = [c[0] for c in result.description]
            expected = sorted_rows(columns, result.fetchall())
            found = sorted_rows(df.columns, rows)
            verdict = "ok"
            if sorted(columns) != sorted(df.columns):
                verdict = f"COLUMNS {sorted(df.columns)} <> {sorted(columns)}"
            elif expected != found:
                extra = [r for r in found if r not in set(expected)][:3]
                lacking = [r for r in expected if r not in set(found)][:3]
                verdict = f"ROWS found {len(found)} expected {len(expected)}\n  + {extra}\n  - {lacking}"
        wrong += verdict not in ("ok", "rows only")
        print(f"{name:28} {len(rows):7} rows {seconds:6.2f} s  {verdict}", flush=True)
    return wrong


if __name__ == "__main__":
    sys.exit(main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01", sys.argv[2:]))
