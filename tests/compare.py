"""Run the registered queries and their SQL side by side and report differences."""

from __future__ import annotations

import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def difference(spark, con, query, sql: str, sf_dir: str) -> str | None:
    got = query(spark, sf_dir)
    mine = rows_of(got.columns, [tuple(r) for r in got.collect()])
    cursor = con.execute(sql)
    columns = [c[0] for c in cursor.description]
    theirs = rows_of(columns, cursor.fetchall())
    if sorted(got.columns) != sorted(columns):
        return f"columns {sorted(got.columns)} / {sorted(columns)}"
    if mine != theirs:
        odd = [(a, b) for a, b in zip(mine, theirs) if a != b][:1]
        return f"rows {len(mine)} / {len(theirs)}, first difference {str(odd)[:700]}"
    return None


if __name__ == "__main__":
    sys.path.insert(0, __file__.rsplit("/", 2)[0])
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir, only = sys.argv[1], sys.argv[2:]
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, failed = connect(sf_dir), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            problem = difference(spark, con, query, sql[name], sf_dir)
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        print(f"{name}: {problem or 'ok'} ({time.time() - start:.1f}s)", flush=True)
    print("failed:", failed)
