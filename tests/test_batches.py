"""Tables by micro-batch number: restarts, repeated batches, hot days."""

from datetime import datetime

from pyspark.sql import functions as F

from sparkwatch import schemas
from sparkwatch.streaming.batches import NumberedTable

SCHEMA = schemas.flat("id long, event_time timestamp, event_date date")
RAW = "id long, event_time timestamp"
RULES = {"has_time": "event_time IS NOT NULL"}


def table(root):
    return NumberedTable(f"{root}/t", SCHEMA, ("event_date",), RULES, keep="event_date IS NOT NULL")


def rows(spark, n, first=0):
    at = F.when(F.col("id") % 10 > 0, F.lit(datetime(2025, 11, 3))).otherwise(
        F.lit(datetime(2025, 1, 1)) + F.make_dt_interval(days=(F.col("id") % 300).cast("int"))
    )
    at = F.when(F.col("id") % 7 > 0, at)
    return spark.range(first, first + n).select("id", at.alias("event_time"), F.to_date(at).alias("event_date"))


def counts(spark, t):
    return {r.metric: r.value for r in t.counts(spark).collect()}


def test_counts_survive_a_restart(spark, root):
    t = table(root)
    assert t.read(spark).count() == 0 and counts(spark, t) == {}
    for start in (0, 100, 200):
        rows(spark, 100, start).drop("event_date").coalesce(1).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(RAW).parquet(f"{root}/in").withColumn("event_date", F.to_date("event_time"))
        t.start(stream, f"{root}/cp", "numbered", available_now=True).awaitTermination()
        bad = sum(i % 7 == 0 for i in range(start + 100))
        assert counts(spark, t) == {"total_rows": start + 100, "failed_has_time": bad}
        assert t.read(spark).count() == start + 100 - bad
    assert t.read(spark).columns == SCHEMA.names and t.read(spark).distinct().count() == t.read(spark).count()


def test_a_repeated_and_an_unfinished_batch(spark, root):
    t = table(root)
    for number in (0, 1, 1):
        t.write(rows(spark, 50, 50 * number), number)
    want = t.read(spark).count()
    assert want == sum(i % 7 > 0 for i in range(100)) and counts(spark, t)["total_rows"] == 100
    # A batch without commit, as after a failure on the way, is not seen.
    rows(spark, 50, 100).where("event_date IS NOT NULL").write.partitionBy("event_date").parquet(f"{root}/t/batch_id=2")
    assert t.read(spark).count() == want
    t.write(rows(spark, 50, 100), 2)
    assert t.read(spark).count() == sum(i % 7 > 0 for i in range(150))


def test_batches_without_rows(spark, root):
    t = table(root)
    t.write(rows(spark, 0), 0)
    t.write(rows(spark, 10).limit(0), 1)
    t.write(rows(spark, 7), 2)
    t.write(rows(spark, 1).repartition(3), 3)  # nothing is left of it, and it is counted
    assert t.read(spark).count() == 6 and counts(spark, t) == {"total_rows": 8, "failed_has_time": 2}


def test_a_hot_day_is_written_by_several_tasks(spark, root):
    t = table(root)
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "64k")
    try:
        t.write(rows(spark, 200_000).repartition(8), 0)
    finally:
        spark.conf.set(size, before)
    hot = t.read(spark).where(F.col("event_date") == F.lit(datetime(2025, 11, 3).date()))
    assert len(hot.inputFiles()) > 2 and hot.count() > 0.85 * t.read(spark).count()
    plan = hot._jdf.queryExecution().executedPlan().toString()
    assert "event_date" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_a_batch_without_rules_is_computed_once(spark, root):
    seen = spark.sparkContext.accumulator(0)

    def run(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    table = NumberedTable(f"{root}/plain", schemas.flat("id long"))
    table.write(spark.range(70).mapInArrow(run, "id long"), 0)
    table.write(spark.range(0).mapInArrow(run, "id long"), 1)
    assert seen.value == 70 and table.read(spark).count() == 70
    assert [tuple(r) for r in table.counts(spark).collect()] == [("total_rows", 70)]
