"""Runs named queries and their SQL side by side: python -m tests.compare DIR [NAME...]"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def normal(x):
    if isinstance(x, float):
        return None if math.isnan(x) else round(x, 6) + 0.0
    return x


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(normal(r[i]) for i in order) for r in data), key=lambda r: tuple((x is None, str(x)) for x in r))


def differences(spark, sf_dir: str, name: str, query, sql: str) -> str:
    """Empty if rows, columns and kinds of types agree."""
    df = query(spark, sf_dir)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    con.execute("SET TimeZone='UTC'")
    cur = con.execute(sql)
    names, kinds = [d[0] for d in cur.description], {d[0]: str(d[1]) for d in cur.description}
    want = rows(names, cur.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    kind = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN", "int": "INTEGER"}
    if odd := [(c, t, kinds[c]) for c, t in df.dtypes if kind.get(t) != kinds[c]]:
        return f"types {odd}"
    if got != want:
        bad = [(a, b) for a, b in zip(got, want) if a != b][:3]
        return f"{len(got)} and {len(want)} rows; first differences {bad}"
    return "" if got else "no rows"


def main() -> None:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    spark = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    spark.sparkContext.setLogLevel("OFF")
    sqls = entry.oracle_sql()
    for name in sys.argv[2:] or list(sqls):
        t = time.time()
        try:
            said = differences(spark, sys.argv[1], name, entry.queries()[name], sqls[name])
        except Exception as e:  # noqa: BLE001
            said = f"{type(e).__name__}: {str(e)[:400]}"
        print(name, "ok" if not said else f"DIFFERS {said}"[:900], round(time.time() - t, 1), flush=True)


if __name__ == "__main__":
    main()
