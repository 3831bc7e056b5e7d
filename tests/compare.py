"""Run registered queries beside their SQL twins.

``python tests/compare.py [sf_dir] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
        )
    return connection


def rows_of(records, columns: list[str]) -> tuple[list[str], list[tuple]]:
    """Rows with columns in name order, sorted."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = [tuple(r[i] for i in order) for r in records]
    return [columns[i] for i in order], sorted(rows, key=repr)


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return rows_of(df.collect(), df.columns)


def duck_rows(connection, sql: str) -> tuple[list[str], list[tuple]]:
    result = connection.execute(sql)
    return rows_of(result.fetchall(), [c[0] for c in result.description])


def main(argv: list[str]) -> None:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from bench import session

    import __spark_entry__ as contract

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark, connection = session(), duck(sf_dir)
    failed = 0
    for name, run in contract.queries().items():
        if argv[1:] and name not in argv[1:]:
            continue
        started = time.time()
        try:
            got = spark_rows(run(spark, sf_dir))
            seconds = time.time() - started
            want = duck_rows(connection, contract.oracle_sql()[name])
            same = got == want
            note = f"{len(got[1])} rows"
            if not same:
                extra = [r for r in got[1] if r not in set(want[1])][:2]
                lacking = [r for r in want[1] if r not in set(got[1])][:2]
                note = f"{got[0]} {want[0]} {len(got[1])}/{len(want[1])} +{extra} -{lacking}"
        except Exception as error:  # report every query, then fail
            same, note, seconds = False, str(error)[:1500], time.time() - started
        failed += not same
        print(f"{'ok  ' if same else 'DIFF'} {name} {seconds:.2f}s {note}", flush=True)
    sys.exit(1 if failed else 0)


if __name__ == "__main__":
    main(sys.argv[1:])
