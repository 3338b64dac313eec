"""Run registered queries against their SQL: `python tests/compare.py [folder] [names...]`."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pyarrow as pa

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = ("lineitem", "documents", "embeddings", "labels", "events", "benchmark", "conversations", "pages")


def rows_of(table: pa.Table) -> list[tuple]:
    """Rows as sorted text, columns in name order."""
    names = sorted(table.column_names)
    return sorted(tuple(repr(row[n]) for n in names) for row in table.to_pylist())


def oracle(folder: str, sql: str) -> pa.Table:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con.sql(sql).to_arrow_table()


def difference(spark_rows: pa.Table, sql_rows: pa.Table) -> str | None:
    """None when equal, else what differs."""
    kinds = [sorted((f.name, str(f.type).replace("large_", "")) for f in t.schema)
             for t in (spark_rows, sql_rows)]
    if kinds[0] != kinds[1]:
        return f"columns {[x for x in zip(*kinds) if x[0] != x[1]] or kinds}"
    if len(spark_rows) != len(sql_rows):
        return f"{len(spark_rows)} rows != {len(sql_rows)} rows"
    wrong = [(x, y) for x, y in zip(rows_of(spark_rows), rows_of(sql_rows)) if x != y]
    if not wrong:
        return None
    cells = [(a[-60:], b[-60:]) for a, b in zip(*wrong[0]) if a != b]
    return f"{len(wrong)} rows differ, row {wrong[0][0][0]}: {cells}"


def main() -> int:
    from conftest import make_session

    import __spark_entry__ as contract

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = make_session()
    sql, failed = contract.oracle_sql(), 0
    for name, query in contract.queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            rows = query(spark, folder).toArrow()
            took = time.time() - start
            problem = difference(rows, oracle(folder, sql[name])) if name in sql else "no SQL"
        except Exception as error:  # report and go on with the next query
            rows, took, problem = [], time.time() - start, f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem not in (None, "no SQL")
        print(f"{name:32s} {len(rows):7d} rows {took:6.1f}s  {problem or 'equal'}", flush=True)
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(main())
