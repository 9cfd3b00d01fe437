"""Raw records to canonical and silver tables."""

import json
import random
from datetime import datetime

import pytest

from sparkwatch import schemas
from sparkwatch.operators import normalize as N
from sparkwatch.operators import silver
from sparkwatch.plans import pipeline
from sparkwatch.sources import files, tables

PROLOG = '<?xml version="1.0" encoding="utf-8"?>\n'


def event(body, event_id="<EventID>1</EventID>", extra=""):
    return (
        f'<Event xmlns="http://schemas.example/event">\n<System>{event_id}'
        '<TimeCreated SystemTime="2025-11-03T10:30:00.123Z"/><Computer>PC1</Computer>'
        f"{extra}</System>\n<EventData>{body}</EventData></Event>"
    )


def text(spark, *rows):
    return spark.createDataFrame([(r,) for r in rows], "value string")


def test_xml_variants(spark):
    rows = N.normalize_sysmon_raw(
        text(
            spark,
            event('<Data Name="User">a &amp; b</Data><Data Name="ProcessId">0x10</Data><Data Name="Image"/><Data>loose</Data>'),
            event('<Data Name="User">one</Data><Data Name="User">two</Data>', '<EventID Qualifiers="0">3</EventID>'),
            event('<Data Name="User">cut</Data>')[:90],
            "not an event",
        )
    ).collect()
    assert len(rows) == 2
    first, second = sorted(rows, key=lambda r: r["EventID"])
    assert (first["User"], first["ProcessId"], first["Image"], first["Computer"]) == ("a & b", 16, "", "PC1")
    assert first["EventTime"] == datetime(2025, 11, 3, 10, 30, 0, 123000)
    assert first["source_system"] == "sysmon" and '"ProcessId":"0x10"' in first["RawEventData"]
    assert (second["EventID"], second["User"]) == (3, "two")


def test_event_without_data(spark):
    row = N.normalize_sysmon_raw(text(spark, event(""))).first()
    assert row["EventID"] == 1 and row["User"] is None and row["RawEventData"] == "{}"


def test_json_line(spark):
    line = '{"EventID": 3, "EventTime": "2025-11-03T10:30:00", "DestinationPort": 443.0, "User": "u", "Unknown": 1}'
    row = N.normalize_sysmon_raw(text(spark, line)).first()
    assert (row["EventID"], row["DestinationPort"], row["User"]) == (3, 443, "u")
    assert row["EventTime"] == datetime(2025, 11, 3, 10, 30)


def test_unparsed_keeps_the_evidence(spark):
    good, cut, odd = event(""), event("")[:60], "free text"
    got = {r["value"] for r in N.unparsed(text(spark, good, cut, odd, '{"a": 1}', '{"a": ')).collect()}
    assert got == {cut, odd, '{"a": '}


def test_windows_fallbacks(spark):
    body = (
        '<Data Name="SubjectUserName"></Data><Data Name="TargetUserName">bob</Data><Data Name="SubjectDomainName">DOM</Data>'
        '<Data Name="ProcessId">0x1f4</Data><Data Name="IpPort">-</Data><Data Name="LogonType">10</Data>'
    )
    df = N.normalize_windows_raw(text(spark, event(body, "<EventID>4625</EventID>")))
    row = df.first()
    assert (row["AccountName"], row["AccountDomain"], row["ProcessID"], row["IpPort"]) == ("bob", "DOM", 500, None)
    auth = silver.windows_auth(N.windows_to_raw(df)).first()
    assert (auth["logon_classification"], auth["logon_type_name"], auth["logon_success"]) == ("failed_logon", "RemoteInteractive", False)


@pytest.mark.parametrize("stream", [False, True])
def test_event_files(spark, root, stream):
    body = "\n".join(PROLOG + event(f'<Data Name="User">u{i}</Data>') for i in range(3))
    spark.createDataFrame([(body,)], "value string").coalesce(1).write.text(f"{root}/in/a")
    wrapped = "<Events>" + event('<Data Name="User">w</Data>') + "</Events>"
    spark.createDataFrame([(wrapped,)], "value string").coalesce(1).write.text(f"{root}/in/b")
    rows = files.read_event_xml(spark, f"{root}/in/*", stream=stream, glob="*.txt")
    out = N.normalize_sysmon_raw(rows)
    if stream:
        q = out.writeStream.format("memory").queryName("event_files").trigger(availableNow=True).start()
        q.awaitTermination()
        out = spark.table("event_files")
    assert sorted(r["User"] for r in out.collect()) == ["u0", "u1", "u2", "w"]


def test_silver_process_labels(spark):
    rows = [
        (1, "procdump.exe", "x"), (1, "a.exe", "run -NOP"), (1, "PowerShell.exe", "IEX y"), (1, "a.exe", None), (3, "mimikatz", ""),
    ]
    raw = spark.createDataFrame(
        [(i, "2025-11-03T10:00:00", "h", p, 1.0, c, "u", "p", 2.0, "s", None, None, None) for i, p, c in rows], schemas.RAW_SYSMON
    )
    out = silver.sysmon_process(raw)
    assert [f.name for f in out.schema] == [f.name for f in schemas.SILVER["sysmon_process"]]
    assert [r["threat_indicator"] for r in out.collect()] == ["suspicious_process", "suspicious_commandline", "powershell_download", "normal"]


def test_bad_values_become_null(spark):
    raw = spark.createDataFrame([(3, "not a time", "h", "p", None, None, "u", None, None, None, "1.1.1.1", 443.0, None)], schemas.RAW_SYSMON)
    row = silver.sysmon_network(raw).first()
    assert row["event_time"] is None and row["destination_port"] == 443 and row["port_classification"] == "normal"


def test_okta_without_target(spark):
    lines = text(
        spark,
        '{"uuid":"1","published":"2025-11-03T10:00:00","eventType":"user.mfa.x","outcome":{"result":"SUCCESS"},"target":[]}',
        '{"uuid":"2","outcome":{"result":"FAILURE"},"target":[{"displayName":"App"}]}',
    )
    from pyspark.sql import functions as F

    raw = lines.select(F.from_json("value", schemas.RAW_OKTA).alias("r")).select("r.*")
    got = {(r["event_id"], r["risk_indicator"], r["target_application"]) for r in silver.okta_auth(raw).collect()}
    assert got == {("1", "privileged_action", None), ("2", "failed_auth", "App")}


def test_registry_branch(spark):
    row = N.normalize_sysmon_raw(
        text(spark, event(r'<Data Name="TargetObject">HKLM\Software\CurrentVersion\Run\x</Data><Data Name="Image">C:\a.exe</Data>', "<EventID>13</EventID>"))
    )
    out = silver.sysmon_registry(row).first()
    assert out["registry_path"].endswith(r"\CurrentVersion\Run\x") and out["process_name"] == "a.exe"


def test_saved_schema_is_kept(spark, root):
    spark.range(2).write.json(f"{root}/a")
    first = files.saved_schema(spark, f"{root}/a", f"{root}/schema")
    spark.sql("SELECT 'x' AS id, 1 AS more").write.json(f"{root}/b")
    assert files.saved_schema(spark, f"{root}/b", f"{root}/schema") == first


def test_api_array_files(spark, root):
    body = '[\n {"uuid": "1", "client": {"userAgent": {"os": "Linux"}}},\n {"uuid": "2"}\n]'
    spark.createDataFrame([(body,)], "value string").coalesce(1).write.text(root)
    out = N.normalize_okta_api(files.read_json(spark, root, schemas.RAW_OKTA_API, multi_line=True))
    got = {(r["uuid"], r["client_userAgent_os"], r["target"]) for r in out.collect()}
    assert got == {("1", "Linux", "[]"), ("2", None, "[]")}


def test_batch_pipeline_equals_stream_pipeline(spark, root):
    rows = [
        '{"EventID":3,"EventTime":"2025-11-03T10:00:00","DestinationIP":"1.1.1.1","DestinationPort":22}',
        '{"EventID":3,"EventTime":"2025-11-03T10:00:01"}',
        '{"EventID":1,"EventTime":"2025-11-03T10:00:02","ProcessName":"a.exe"}',
    ]
    spark.createDataFrame([(r,) for r in rows], "value string").write.text(f"{root}/raw")
    from sparkwatch.streaming.manage import ObservedTotals

    with ObservedTotals(spark) as totals:
        queries = pipeline.run_pipeline(spark, {"sysmon": f"{root}/raw"}, f"{root}/tables")
        counts = totals.of(queries["sysmon_network"], "sysmon_network")
    assert counts == {"total_rows": 2, "failed_valid_timestamp": 0, "failed_valid_destination": 1}
    batch = pipeline.silver_batch(spark, {"sysmon": f"{root}/raw"})
    for name in ("sysmon_process", "sysmon_network"):
        stored = spark.read.parquet(f"{root}/tables/{name}").drop("processed_timestamp", "event_date")
        assert stored.collect() == batch[name].drop("processed_timestamp").collect()
    bronze = spark.read.parquet(f"{root}/tables/bronze_sysmon")
    assert bronze.where("source_file LIKE '%raw%'").count() == 3


def test_namespace_and_preview(spark):
    before = spark.catalog.currentDatabase()
    try:
        tables.use_namespace(spark, "watch_test")
        spark.range(5).write.mode("overwrite").saveAsTable("numbers")
        assert "numbers" in {r["tableName"] for r in tables.use_namespace(spark, "watch_test").collect()}
        assert tables.preview(spark.table("numbers"), 2).count() == 2
    finally:
        spark.sql("DROP TABLE IF EXISTS watch_test.numbers")
        spark.catalog.setCurrentDatabase(before)


def named(pairs):
    def entry(name, value):
        inside = "" if value is None else value
        return f'<Data Name="{name}">{inside}</Data>' if name is not None else f"<Data>{inside}</Data>"

    return (
        "<Event><System><EventID>7</EventID></System><EventData>"
        + "".join(entry(*p) for p in pairs)
        + "</EventData></Event>"
    )


def test_last_of_repeated_names_in_order(spark):
    """Against a dict that forgets a name before it takes it again."""
    draw = random.Random(5)
    lists = [
        [(draw.choice(["User", "Image", "CommandLine", "b", "a", None]), draw.choice([None, "x", "y", "z"])) for _ in range(n)]
        for n in (0, 1, 2, 3, 5, 8, 13, 40) for _ in range(6)
    ]
    want = []
    for pairs in lists:
        found = {}
        for name, value in pairs:
            if name is not None:
                found.pop(name, None)
                found[name] = value or ""
        want.append(found)
    df = spark.createDataFrame([(i, named(p)) for i, p in enumerate(lists)], "i int, value string")
    rows = N.parse_event_xml(df, ["User", "Image"]).select("i", "data_json", "data").collect()
    got = {r.i: list(json.loads(r.data_json).items()) for r in rows}
    assert got == {i: list(w.items()) for i, w in enumerate(want)}
    assert {r.i: (r.data.User, r.data.Image) for r in rows} == {i: (w.get("User"), w.get("Image")) for i, w in enumerate(want)}


def test_event_with_very_many_repeats(spark):
    pairs = [(f"n{i % 5000}", str(i)) for i in range(20_000)]
    df = spark.createDataFrame([(named(pairs),)], "value string")
    found = json.loads(N.parse_event_xml(df, ["n1"]).first().data_json)
    assert found == {f"n{i}": str(15_000 + i) for i in range(5000)}


def test_both_formats_in_one_pass(spark):
    rows = [
        named([("User", "x"), ("User", "y")]),
        '{"EventID": 8, "User": "j", "User": "k", "RawEventData": {"a": [1]}}',
        "{'EventID': 9}", '{"EventID": 9', '{"EventID": NaN}', "{EventID: 9}", "[9]", "", None, "text",
        "<Event><System>", "<Event><EventData/></Event>",
    ]
    df = spark.createDataFrame([(r,) for r in rows], "value string")
    out = N.normalize_sysmon_raw(df)
    got = {(r.EventID, r.User, r.RawEventData) for r in out.collect()}
    assert got == {(7, "y", '{"User":"y"}'), (8, "k", '{"a":[1]}')}
    assert sorted(map(repr, [r.value for r in N.unparsed(df).collect()])) == sorted(map(repr, rows[2:]))
    assert N.conversion_rate(df, "s").first()[1:3] == (12, 2)
    plan = N.normalize_sysmon_raw(spark.read.text(__file__))._jdf.queryExecution().executedPlan().toString()
    assert [plan.count(x) for x in ("FileScan", "from_xml", "from_json", "Union")] == [1, 1, 1, 0]
    assert out.limit(0).count() == 0
