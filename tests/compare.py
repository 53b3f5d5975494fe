"""Run registered queries and their SQL side by side: ``python tests/compare.py [folder] [query ...]``."""

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as contract  # noqa: E402
from parcelflow.session import build_session  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def database(folder):
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return connection


def normal(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def difference(spark, connection, folder, name):
    """None if query and SQL agree in column names, value types and all rows."""
    df = contract.queries()[name](spark, folder)
    got, names = df.collect(), df.columns
    sql = contract.oracle_sql().get(name)
    if sql is None:
        return None if got else "no rows"
    cursor = connection.execute(sql)
    wanted_names = [column[0] for column in cursor.description]
    wanted = cursor.fetchall()
    if sorted(names) != sorted(wanted_names):
        return f"columns {sorted(names)} and {sorted(wanted_names)}"
    left, right = normal(got, names), normal(wanted, wanted_names)
    if len(left) != len(right):
        return f"{len(left)} and {len(right)} rows"
    for mine, theirs in zip(left, right, strict=True):
        if mine != theirs or [type(v) for v in mine] != [type(v) for v in theirs]:
            return f"{mine} and {theirs}"
    return None if got else "no rows"


if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(contract.queries())
    conf = {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": "8"}
    spark = build_session("compare", "local[8]", **conf, **{"spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    connection, failed = database(folder), 0
    for name in chosen:
        begun = time.time()
        try:
            problem = difference(spark, connection, folder, name)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:400]}"
        failed += problem is not None
        checked = "" if name in contract.oracle_sql() else " (rows only)"
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - begun:.1f}s{checked} {problem or ''}", flush=True)
    print(f"{len(chosen) - failed} of {len(chosen)} agree")
