"""XML of computed text: made once, and parsed by many tasks."""

from pyspark.sql import functions as F

from sparkwatch.operators import normalize as N
from suite import ingest


def test_computed_text_is_made_once(spark):
    event = "</EventID><TimeCreated SystemTime=\"2025-11-03T10:30:00Z\"/></System></Event>"
    made = F.concat(F.lit("<Event><System><EventID>"), F.soundex(F.col("id").cast("string")), F.lit(event))
    rows = spark.range(3).select(F.when(F.col("id") < 2, made).otherwise(F.lit("{}")).alias("value"))
    for convert in (N.convert_windows_xml, N.convert_sysmon_xml):
        out = convert(rows)
        assert out._jdf.queryExecution().optimizedPlan().toString().count("soundex(") == 1
        assert out.count() == 2


def test_rows_of_one_file_are_dealt_to_many_tasks(spark):
    for xml in (ingest.windows_xml, ingest.sysmon_xml):
        rows = xml(spark, "/root/testdata/sf0.001")
        tasks = rows.select(F.spark_partition_id().alias("p")).distinct().count()
        assert tasks == int(spark.conf.get("spark.sql.shuffle.partitions"))
