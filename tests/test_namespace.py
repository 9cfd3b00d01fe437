"""Tables of a namespace."""

from sparkwatch.sources import tables


def test_temporary_views_are_no_tables_of_a_namespace(spark):
    before = spark.catalog.currentDatabase()
    spark.range(1).createOrReplaceTempView("passing")
    try:
        found = tables.use_namespace(spark, "watch_views")
        spark.range(1).write.saveAsTable("kept")
        found = tables.use_namespace(spark, "watch_views")
        assert [r["tableName"] for r in found.collect()] == ["kept"]
    finally:
        spark.catalog.setCurrentDatabase(before)
        spark.catalog.dropTempView("passing")
