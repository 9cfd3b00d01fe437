"""STR-08: raw folders to bronze to silver tables, as streams or in batch."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from sparkwatch import schemas
from sparkwatch.operators import silver
from sparkwatch.operators.quality import SILVER_RULES, expect
from sparkwatch.sources.files import read_json, read_lines, with_origin
from sparkwatch.sources.schema_log import SchemaLog, rescue_typed
from sparkwatch.sources.tables import table_stream
from sparkwatch.streaming.batches import NumberedTable
from sparkwatch.streaming.manage import finish, write_stream


@dataclass(frozen=True)
class Source:
    """A raw source: its schema and the silver tables made from it."""

    schema: StructType
    silver: tuple[tuple[str, Callable[[DataFrame], DataFrame]], ...]


def _network(raw: DataFrame) -> DataFrame:
    return silver.sysmon_network(raw, keep_incomplete=True)


# Silver rows to keep once the expectations have seen all of them.
KEEP = {"sysmon_network": "destination_ip IS NOT NULL"}

SOURCES: Mapping[str, Source] = {
    "sysmon": Source(
        schemas.RAW_SYSMON,
        (
            ("sysmon_process", silver.sysmon_process),
            ("sysmon_network", _network),
            ("sysmon_registry", silver.sysmon_registry),
        ),
    ),
    "okta": Source(schemas.RAW_OKTA, (("okta_auth", silver.okta_auth),)),
    "windows": Source(schemas.RAW_WINDOWS, (("windows_auth", silver.windows_auth),)),
    "cloudtrail": Source(schemas.RAW_CLOUDTRAIL, (("cloudtrail", silver.cloudtrail),)),
}


def bronze_schema(source: Source) -> StructType:
    extra = schemas.flat("ingestion_timestamp timestamp, source_file string")
    return StructType([*source.schema.fields, *extra.fields])


def schema_log(root: str, source: str) -> SchemaLog:
    """What ``run_pipeline(rescue=True)`` has learnt about the fields of a source."""
    return SchemaLog(f"{root}/_schemas/{source}", SOURCES[source].schema)


def _rescuing(spark: SparkSession, path: str, source: Source, **options) -> DataFrame:
    rows = rescue_typed(with_origin(read_lines(spark, path, stream=True, **options)), source.schema)
    return rows.select(*bronze_schema(source).names, "rescued")


def read_bronze(spark: SparkSession, root: str, source: str) -> DataFrame:
    """A bronze table of ``run_pipeline(rescue=True)`` in all the fields that are known by now."""
    schema = StructType([*bronze_schema(SOURCES[source]).fields, *schemas.flat("rescued string").fields])
    return schema_log(root, source).typed(spark.read.schema(schema).parquet(f"{root}/bronze_{source}"))


def silver_batch(spark: SparkSession, raw: Mapping[str, str]) -> dict[str, DataFrame]:
    """Silver tables straight from raw folders, unwritten."""
    out = {}
    for name, path in raw.items():
        source = SOURCES[name]
        rows = with_origin(read_json(spark, path, source.schema))
        for table, make in source.silver:
            out[table] = make(rows).where(KEEP.get(table, "true"))
    return out


def silver_table(root: str, table: str) -> NumberedTable:
    """A silver table of ``run_pipeline(numbered=True)``, by event date."""
    schema = StructType([*schemas.SILVER[table].fields, *schemas.flat("event_date date").fields])
    return NumberedTable(f"{root}/{table}", schema, ("event_date",), SILVER_RULES[table], KEEP.get(table, "true"))


def run_pipeline(
    spark: SparkSession, raw: Mapping[str, str], root: str, available_now: bool = True, every: str = "30 seconds",
    numbered: bool = False, max_files: int | None = None, rescue: bool = False,
) -> dict:
    """Start bronze and silver streams for the given raw folders below ``root``.

    With ``available_now`` each layer is finished before the next one starts
    and the call returns when all rows have passed; otherwise all streams run
    on. Silver streams carry their expectations as observed metrics and write
    one partition per event date, which the rules prune on. Each micro-batch
    is dealt by date before the write, so that a day gets one file of it and
    a backfill over years does not write a file per day and task. Returns the
    queries by table name.

    With ``numbered`` silver tables are ``NumberedTable``s, which part a hot day over several tasks, keep
    the counts of expectations over restarts and are read with ``read_silver(numbered=True)``.
    ``max_files`` bounds the files of a micro-batch, so that a backfill comes in many batches of bounded size.

    With ``rescue`` bronze tables have the column ``rescued``, with all that the source's schema does not hold,
    and a stream over that column keeps the source's ``schema_log``. ``read_bronze`` then gives
    old and new rows in the latest schema. Silver tables are made from the declared fields as before.
    """
    queries = {}
    rate = {"maxFilesPerTrigger": max_files} if max_files else {}
    for name, path in raw.items():
        if rescue:
            df = _rescuing(spark, path, SOURCES[name], **rate)
        else:
            df = with_origin(read_json(spark, path, SOURCES[name].schema, stream=True, **rate))
        table = f"bronze_{name}"
        queries[table] = write_stream(
            df, table, f"{root}/{table}", f"{root}/_checkpoints/{table}", "parquet", every, available_now
        )
    if available_now:
        finish(queries)
    for name in raw:
        source = SOURCES[name]
        if rescue:
            found = table_stream(spark, f"{root}/bronze_{name}", schemas.flat("rescued string"))
            queries[f"schema_{name}"] = schema_log(root, name).start(
                found, f"{root}/_checkpoints/schema_{name}", f"schema_{name}", every, available_now
            )
        for table, make in source.silver:
            bronze = table_stream(spark, f"{root}/bronze_{name}", bronze_schema(source))
            if numbered:
                rows = make(bronze).withColumn("event_date", F.to_date("event_time"))
                queries[table] = silver_table(root, table).start(
                    rows, f"{root}/_checkpoints/{table}", table, every, available_now
                )
                continue
            df, _ = expect(make(bronze), SILVER_RULES[table], name=table)
            df = df.where(KEEP.get(table, "true")).withColumn("event_date", F.to_date("event_time"))
            df = df.repartition("event_date")
            queries[table] = write_stream(
                df, table, f"{root}/{table}", f"{root}/_checkpoints/{table}", "parquet", every, available_now,
                ("event_date",),
            )
    if available_now:
        finish(queries)
    return queries


def read_silver(
    spark: SparkSession, root: str, sources: Sequence[str] = tuple(SOURCES), numbered: bool = False
) -> dict[str, DataFrame]:
    """The tables written by ``run_pipeline`` for the given sources, for the rules.

    Silver tables have their partition column. ``windows_raw`` is the bronze table of Windows
    events, since a cleared log is no logon and so in no silver table.
    """
    day = schemas.flat("event_date date").fields
    out = {
        table: silver_table(root, table).read(spark)
        if numbered
        else spark.read.schema(StructType([*schemas.SILVER[table].fields, *day])).parquet(f"{root}/{table}")
        for name in sources
        for table, _ in SOURCES[name].silver
    }
    if "windows" in sources:
        out["windows_raw"] = spark.read.schema(bronze_schema(SOURCES["windows"])).parquet(f"{root}/bronze_windows")
    return out
