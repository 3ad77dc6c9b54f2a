"""Compares registered queries with their SQL on one folder of given tables.

    python -m bindings.check /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()
# DuckDB types as the names Spark gives them.
TYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}


def local_session(cpus: int | str = 8, app: str = "loyaltide") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def mismatch(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs between a DataFrame and an SQL result, or None."""
    relation = con.sql(sql)
    wanted_types = {c: TYPES.get(str(t), str(t)) for c, t in zip(relation.columns, relation.types)}
    if dict(df.dtypes) != wanted_types:
        return f"types: spark {sorted(dict(df.dtypes).items() - wanted_types.items())}, " \
               f"sql {sorted(wanted_types.items() - dict(df.dtypes).items())}"
    columns = sorted(df.columns)
    found = sorted((_row(r) for r in df.select(*[f"`{c}`" for c in columns]).collect()), key=repr)
    wanted = sorted((_row(r) for r in relation.select(*[f'"{c}"' for c in columns]).fetchall()), key=repr)
    if found == wanted:
        return None
    missing, extra = set(wanted) - set(found), set(found) - set(wanted)
    return (f"rows: spark {len(found)}, sql {len(wanted)}; {len(extra)} only in spark, {len(missing)} only in sql\n"
            f"   columns {columns}\n   spark {sorted(extra, key=repr)[:2]}\n   sql   {sorted(missing, key=repr)[:2]}")


def _row(row) -> tuple:
    return tuple(0.0 if isinstance(v, float) and v == 0 else None if isinstance(v, float) and pd.isna(v) else v
                 for v in row)


def main(folder: str, names: list[str]) -> int:
    from bindings import load

    queries, oracles = load()
    spark, con = local_session(), database(folder)
    failed = []
    for name in names or queries:
        start = time.time()
        try:
            df = queries[name](spark, folder)
            if name in oracles:
                problem = mismatch(df, con, oracles[name])
                note = "ok" if problem is None else f"MISMATCH {problem}"
            else:
                problem, note = None, f"rows only: {len(df.collect())}"
        except Exception as error:  # report and go on with the next query
            problem = note = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        if problem:
            failed.append(name)
        print(f"{name:28s} {time.time() - start:6.1f}s  {note}", flush=True)
    print(f"{len(names or queries)} queries, {len(failed)} failed: {failed}")
    return bool(failed)


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
