"""Bronze that rescues and a schema log that learns: new fields, other types, restarts, repeated batches."""

import json

from hypothesis import given, settings, strategies as st
from pyspark.sql.types import (
    ArrayType, BooleanType, DoubleType, LongType, MapType, NullType, StringType, StructType,
)

from sparkwatch import schemas
from sparkwatch.plans import pipeline
from sparkwatch.sources.schema_log import SchemaLog, rescue_typed, variant_type, widen

BASE = StructType([
    *schemas.flat("id long, name string").fields,
    schemas.StructField("place", schemas.flat("city string")),
    schemas.StructField("tags", ArrayType(StringType())),
])


def rescued(spark, *lines):
    df = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "n int, value string")
    return rescue_typed(df, BASE).orderBy("n").collect()


def test_what_fits_is_not_rescued_and_the_rest_keeps_its_json_types(spark):
    rows = rescued(
        spark,
        '{"id":1,"name":"a","place":{"city":"x"},"tags":["p","q"]}',
        '{"id":2,"place":{"city":null},"tags":[],"name":null}',
        '{"id":"3","code":"007","n":7,"deep":{"a":[1,null]}}',
        '{"id":4,"place":{"city":"x","zip":9}}',
        '{"id":5.5,"name":5,"tags":"p"}',
        "{broken", "[1]", "", None, "{}",
    )
    got = [None if r.rescued is None else json.loads(r.rescued) for r in rows]
    assert got == [
        None, None, {"id": "3", "code": "007", "n": 7, "deep": {"a": [1, None]}}, {"place": {"city": "x", "zip": 9}},
        {"id": 5.5, "tags": "p"}, {"_line": "{broken"}, {"_line": "[1]"}, None, None, None,
    ]
    assert rows[4].name == "5" and rows[3].place.city == "x" and rows[0].tags == ["p", "q"]


def test_types_of_variants(spark):
    assert variant_type("OBJECT<a: BIGINT, `OBJECT<VARIANT`: DECIMAL(2,1), c: ARRAY<VOID>, VARIANT: VARIANT, e: OBJECT<>>") == (
        StructType.fromDDL("a bigint, `OBJECT<VARIANT` double, c array<void>, VARIANT string, e map<string,string>")
    )
    assert variant_type("DECIMAL(24,1)") == StringType()


TYPES = st.recursive(
    st.sampled_from([NullType(), LongType(), DoubleType(), StringType(), BooleanType()]),
    lambda t: t.map(ArrayType) | t.map(lambda v: MapType(StringType(), v)) | st.dictionaries(st.sampled_from("aAbc"), t).map(
        lambda d: StructType([schemas.StructField(n, v) for n, v in d.items()]) if len({n.lower() for n in d}) == len(d)
        else StringType()
    ),
    max_leaves=6,
)


@settings(max_examples=200, deadline=None)
@given(TYPES, TYPES)
def test_widening_takes_both_and_is_stable(a, b):
    both = widen(a, b)
    assert widen(both, a) == both and widen(both, b) == both and widen(a, a) == a
    assert {type(widen(b, a))} == {type(both)}


def test_versions_over_batches_and_a_repeated_batch(spark, root):
    log = SchemaLog(f"{root}/log", BASE)
    batch = lambda *texts: spark.createDataFrame([(t,) for t in texts], "rescued string")
    assert log.at(spark) == BASE
    log.evolve(batch(None, '{"_line":"{"}', '{"v":null}'), 0)
    assert log.at(spark) == BASE
    log.evolve(batch('{"v":1,"ID":5,"source_file":"x"}', '{"v":null}'), 1)
    log.evolve(batch('{"v":1}'), 2)
    log.evolve(batch('{"v":1.5,"w":{"a":null}}', '{"id":"x"}'), 3)
    log.evolve(batch('{"w":{"a":true}}', '{"place":{"city":"x","zip":9}}'), 4)
    before = log.versions(spark)
    for number, texts in ((1, ['{"v":1,"ID":5,"source_file":"x"}']), (4, ['{"w":{"a":true}}', '{"place":{"zip":9}}'])):
        log.evolve(batch(*texts), number)
    assert log.versions(spark) == before and [since for since, _ in before] == [0, 2, 4, 5]
    assert log.at(spark, 2).names == [*BASE.names, "v"] and log.at(spark, 3)["v"].dataType == LongType()
    last = {f.name: f.dataType.simpleString() for f in log.at(spark).fields}
    assert last == {
        "id": "string", "name": "string", "place": "struct<city:string,zip:bigint>", "tags": "array<string>",
        "v": "double", "w": "struct<a:boolean>",
    }


def test_more_fields_than_columns_stay_rescued(spark, root):
    log = SchemaLog(f"{root}/log", StructType.fromDDL("id bigint"), most_fields=3)
    lines = [json.dumps({"id": i, "often": i, f"k{i % 40}": i}) for i in range(400)]
    rows = rescue_typed(spark.createDataFrame([(x,) for x in lines], "value string"), log.base)
    log.evolve(rows, 0)
    assert log.at(spark).names == ["id", "often", "k0"]
    out = log.typed(rows).collect()
    assert [r.often for r in out] == list(range(400))
    for r in out:
        assert {"k0": r.k0} if r.id % 40 == 0 else json.loads(r.rescued) == {f"k{r.id % 40}": r.id}


def test_pipeline_rereads_old_rows_in_the_latest_schema(spark, root):
    days = [
        ['{"uuid":"a","published":"2025-01-01T00:00:00","actor":{"alternateId":"x"}}'],
        ['{"uuid":"b","published":"2025-01-02T00:00:00","actor":{"alternateId":"y","rank":3},"risk":7,"os":{"v":1}}', "{no"],
        ['{"uuid":"c","published":"2025-01-03T00:00:00","risk":0.5,"os":"mac","severity":{"level":2}}'],
    ]
    for lines in days:
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(f"{root}/raw")
        pipeline.run_pipeline(spark, {"okta": f"{root}/raw"}, f"{root}/t", rescue=True)
    rows = {r.uuid: r for r in pipeline.read_bronze(spark, f"{root}/t", "okta").collect()}
    assert {u: (r.risk, r.os, r.severity, r.rescued) for u, r in rows.items()} == {
        "a": (None, None, None, None), "b": (7.0, '{"v":1}', None, None),
        "c": (0.5, "mac", '{"level":2}', None), None: (None, None, None, '{"_line":"{no"}'),
    }
    assert rows["b"].actor.rank == 3 and rows["a"].actor.alternateId == "x" and rows["a"].actor.rank is None
    assert rows["c"].source_file and len(pipeline.schema_log(f"{root}/t", "okta").versions(spark)) == 3
    auth = pipeline.read_silver(spark, f"{root}/t", ["okta"])["okta_auth"]
    assert sorted((r.event_id or "-", str(r.event_date)) for r in auth.collect()) == [
        ("-", "None"), ("a", "2025-01-01"), ("b", "2025-01-02"), ("c", "2025-01-03")
    ]


def test_lost_fields_are_found_once_for_a_row(spark):
    lines = spark.createDataFrame([('{"id":1,"place":{"city":"x","zip":9},"tags":["p"],"n":7}',)], "value string")
    rows = rescue_typed(lines, BASE)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("isVariantNull") == len(BASE.fields)
    assert json.loads(rows.first().rescued) == {"place": {"city": "x", "zip": 9}, "n": 7}
