"""Raw files that the pipeline queries make."""

from glob import glob

from suite import streams


def test_raw_files_are_compressed(spark):
    streams.stream_pipeline(spark, "/root/testdata/sf0.001")
    base = spark.conf.get("spark.checkpoint.dir").removeprefix("file://")
    for name in ("okta", "sysmon"):
        files = glob(f"{base}/sparkwatch/stream-pipeline-*/{name}/part-*")
        assert files and all(f.endswith(".json.gz") for f in files)


def test_rows_of_a_file_are_bounded(spark, root):
    streams.delivered(spark.range(450_000).coalesce(1), f"{root}/raw")
    assert spark.read.json(f"{root}/raw").count() == 450_000
    assert len(glob(f"{root.removeprefix('file://')}/raw/part-*.json.gz")) == 3


def test_raw_files_of_all_sources_are_compressed(spark):
    streams.written_pipeline(spark, "/root/testdata/sf0.001")
    base = spark.conf.get("spark.checkpoint.dir").removeprefix("file://")
    for name in ("okta", "windows", "cloudtrail", "sysmon"):
        files = glob(f"{base}/sparkwatch/stream-all-*/{name}/part-*")
        assert files and all(f.endswith(".json.gz") for f in files)


def test_event_xml_is_compressed(spark):
    streams.stream_normalize(spark, "/root/testdata/sf0.001")
    base = spark.conf.get("spark.checkpoint.dir").removeprefix("file://")
    files = glob(f"{base}/sparkwatch/stream-xml-*/in/part-*")
    assert files and all(f.endswith(".txt.gz") for f in files)
