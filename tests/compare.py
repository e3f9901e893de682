"""Row-by-row comparison of a Spark result with a DuckDB result, ignoring row order."""

from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def oracle(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _tag(value):
    """A value with its kind, so that 1, 1.0, true and '1' stay apart."""
    return (type(value).__name__, repr(value))


def spark_rows(df):
    names = sorted(df.columns)
    return names, Counter(tuple(_tag(row[n]) for n in names) for row in df.select(*names).collect())


def duck_rows(con, sql):
    cursor = con.execute(sql)
    described = [d[0] for d in cursor.description]
    order = sorted(range(len(described)), key=lambda i: described[i])
    rows = cursor.fetchall()
    return [described[i] for i in order], Counter(tuple(_tag(row[i]) for i in order) for row in rows)


def assert_same(df, con, sql):
    spark_names, spark_side = spark_rows(df)
    duck_names, duck_side = duck_rows(con, sql)
    assert spark_names == duck_names
    only_spark = list((spark_side - duck_side).items())
    only_duck = list((duck_side - spark_side).items())
    assert not only_spark and not only_duck, (
        f"{sum(spark_side.values())} Spark rows, {sum(duck_side.values())} SQL rows; columns {spark_names}\n"
        f"only Spark: {only_spark[:3]}\nonly SQL: {only_duck[:3]}"
    )
    return sum(spark_side.values())
