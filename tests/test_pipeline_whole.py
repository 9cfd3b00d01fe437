"""The query over all silver tables takes every row of its tables."""

from pyspark.sql import functions as F

from suite import streams

KINDS = ("click", "error", "purchase", "signup", "view", None)


def written(spark, root):
    """Six events of each kind, ten orders, and connections by hand, three of which have no destination."""
    n = F.col("id")
    time = F.timestamp_seconds(1_704_067_200 + n * 7200).cast("timestamp_ntz")
    kind = F.get(F.array(*[F.lit(k) for k in KINDS]), (n % 6).cast("int"))
    spark.range(36).select(
        n.alias("event_id"), time.alias("ts"), (n % 5).alias("user_id"), kind.alias("event_type"),
        F.concat(F.lit('{"k": '), (n % 11).cast("string"), F.lit("}")).alias("props"),
    ).write.parquet(f"{root}/events.parquet")
    spark.range(10).select(
        n.alias("o_orderkey"), n.alias("o_custkey"), F.lit("F").alias("o_orderstatus"), time.alias("o_orderdate"),
        F.lit("1-URGENT").alias("o_orderpriority"),
    ).write.parquet(f"{root}/orders.parquet")
    line = lambda day, part, number, discount, tax: (part, 7, number, discount, tax, f"2024-01-0{day} 10:00:00")
    spark.createDataFrame(
        [
            line(1, 300, 1, 0.1, 0.0), line(1, 301, 4, 0.0, 0.1), line(2, 302, 5, 0.1, 0.1), line(3, 302, 5, 0.1, 0.1),
            line(3, 303, 1, 0.0, 0.0), line(3, None, 1, 0.1, 0.1), line(4, 304, 1, None, None),
        ],
        "l_partkey long, l_suppkey long, l_linenumber int, l_discount double, l_tax double, day string",
    ).select("*", F.col("day").cast("timestamp_ntz").alias("l_shipdate")).write.parquet(f"{root}/lineitem.parquet")


def test_every_row_of_the_tables_is_taken(spark, root):
    written(spark, root)
    rows = {r.table_name: r for r in streams.stream_pipeline_all(spark, root).collect()}
    assert {name: r.n for name, r in rows.items()} == {
        "okta_auth": 36, "windows_auth": 30, "cloudtrail": 10, "sysmon_process": 36,
        "sysmon_network": 4, "sysmon_registry": 36,
    }
    assert rows["sysmon_network"].days == 3 and rows["sysmon_registry"].days == 3


def test_every_silver_table_of_the_pipeline_is_counted():
    assert set(streams.PIPED) == {table for s in streams.pipeline.SOURCES.values() for table, _ in s.silver}


def test_sql_takes_every_row(spark, root):
    import duckdb

    written(spark, root)
    con = duckdb.connect()
    for name in ("events", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{root.removeprefix('file://')}/{name}.parquet/*.parquet'")
    want = sorted(con.execute(streams.STREAM_PIPELINE_ALL).fetchall())
    got = streams.stream_pipeline_all(spark, root).select("table_name", "n", "checksum", "days").collect()
    assert sorted(map(tuple, got)) == want
