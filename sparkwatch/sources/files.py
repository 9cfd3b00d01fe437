"""SRC-01 to SRC-07, SRC-11: raw log files as DataFrames.

Every reader takes ``stream=True`` to discover new files incrementally; the
rows and columns are the same either way, so one transformation serves both
(STR-04). Directories are read with explicit schemas, which spares the schema
inference pass over the data.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def _reader(spark: SparkSession, stream: bool, options: dict):
    reader = spark.readStream if stream else spark.read
    return reader.options(**{k: v for k, v in options.items() if v is not None})


def read_lines(
    spark: SparkSession, path: str, stream: bool = False, glob: str | None = None, **options
) -> DataFrame:
    """SRC-01, SRC-04: text files, one row per line in ``value``."""
    return _reader(spark, stream, {"pathGlobFilter": glob, **options}).format("text").load(path)


def read_event_xml(
    spark: SparkSession, path: str, stream: bool = False, glob: str | None = "*.xml", **options
) -> DataFrame:
    """SRC-06: files of ``<Event>`` documents, one row per event in ``value``.

    The closing tag is the record separator. Splitting on it lets Spark cut
    large files into tasks and keeps multi-line events, prologs between events
    and a wrapping root element harmless.
    """
    chunks = read_lines(spark, path, stream, glob, lineSep="</Event>", **options)
    start = F.regexp_extract("value", r"(?s)(<Event[\s>].*)$", 1)
    return chunks.select(start.alias("value")).where(F.col("value") != "").select(
        F.concat("value", F.lit("</Event>")).alias("value")
    )


def read_event_text(spark: SparkSession, path: str, stream: bool = False, **options) -> DataFrame:
    """A folder that mixes event XML (``*.xml``) and JSON lines (``*.json``)."""
    return read_event_xml(spark, path, stream, "*.xml", **options).unionByName(
        read_lines(spark, path, stream, "*.json", **options)
    )


def read_json(
    spark: SparkSession,
    path: str,
    schema: StructType,
    stream: bool = False,
    recursive: bool = False,
    multi_line: bool = False,
    **options,
) -> DataFrame:
    """SRC-02, SRC-03, SRC-05, SRC-07: JSON lines, nested JSON, JSON arrays.

    Gzip files are read as they are but cannot be split, see ``spread``.
    """
    extra = {
        "recursiveFileLookup": "true" if recursive else None,
        "multiLine": "true" if multi_line else None,
    }
    return _reader(spark, stream, {**extra, **options}).schema(schema).json(path)


def saved_schema(spark: SparkSession, sample_path: str, schema_path: str) -> StructType:
    """Infer a JSON schema once from a sample and keep it beside the checkpoint.

    Later starts read the stored copy, so a stream keeps its types for life.
    """
    try:
        text = spark.read.text(schema_path, wholetext=True).first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        text = None
    if text is not None:
        return StructType.fromJson(json.loads(text["value"]))
    schema = spark.read.json(sample_path).schema
    spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.text(schema_path)
    return schema


def with_origin(df: DataFrame) -> DataFrame:
    """NRM-06, SRC-11: bronze columns, load time and source file."""
    return df.withColumns(
        {
            "ingestion_timestamp": F.current_timestamp(),
            "source_file": F.col("_metadata.file_path"),
        }
    )


def spread(df: DataFrame, partitions: int) -> DataFrame:
    """Distribute rows read from files that cannot be split."""
    return df.repartition(partitions)


def read_json_rescued(
    spark: SparkSession, path: str, schema: StructType, stream: bool = False, rescued: str = "rescued", **options
) -> DataFrame:
    """SRC-02: JSON lines in the types of ``schema``, and what does not fit them as JSON text.

    ``rescued`` is null where a record fits. Otherwise it is an object of the top-level fields that
    the schema does not know and of those whose value was lost in their type; a line that
    is no JSON object is kept whole as ``{"_line": ...}``. So no field of a later format vanishes.
    """
    lines = read_lines(spark, path, stream, **options)
    return rescue_json(lines, schema, rescued)


def rescue_json(lines: DataFrame, schema: StructType, rescued: str = "rescued", text: str = "value") -> DataFrame:
    """``read_json_rescued`` over a column of JSON text; other columns stay."""
    line = F.col(text)
    typed = F.from_json(line, schema)
    raw = F.from_json(line, "map<string,string>")
    one = F.array(F.struct(typed.alias("t"), raw.alias("m"), F.coalesce(F.json_object_keys(line), F.array()).alias("k")))
    rows = lines.select("*", F.explode(one).alias("_r"))
    known = {f.name: F.col("_r.t")[f.name] for f in schema.fields}
    names = F.array(*[F.lit(n) for n in known])
    gone = F.array_compact(
        F.array(*[
            F.when(value.isNull() & F.try_element_at("_r.m", F.lit(name)).isNotNull(), F.lit(name))
            for name, value in known.items()
        ])
    )
    extra = F.array_union(F.array_except("_r.k", names), gone)
    kept = F.map_filter("_r.m", lambda k, _: F.array_contains(extra, k))
    whole = F.to_json(F.struct(line.alias("_line")))
    is_object = F.col("_r.m").isNotNull() & F.json_object_keys(line).isNotNull()
    rest = F.when(line.isNull() | (F.trim(line) == ""), None).when(~is_object, whole).when(F.size(extra) > 0, F.to_json(kept))
    others = [c for c in lines.columns if c != text]
    return rows.select(*others, *[v.alias(n) for n, v in known.items()], rest.alias(rescued))


def unexpected_keys(lines: DataFrame, schema: StructType) -> DataFrame:
    """Top-level JSON keys that the schema does not know, with their counts."""
    known = F.array(*[F.lit(f.name) for f in schema.fields])
    return (
        lines.select(F.explode(F.array_except(F.json_object_keys("value"), known)).alias("key"))
        .groupBy("key")
        .agg(F.count("*").alias("rows"))
    )


def source_report(spark: SparkSession, paths: dict[str, tuple[str, StructType]]) -> DataFrame:
    """K-30: events per source; a source without a folder shows null."""
    parts = []
    for name, (path, schema) in paths.items():
        try:
            part = spark.read.schema(schema).json(path).agg(F.count("*").alias("events"))
        except AnalysisException as error:  # a missing folder is part of the report
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            part = spark.range(1).select(F.lit(None).cast("long").alias("events"))
        parts.append(part.select(F.lit(name).alias("source"), "events"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.withColumn("available", F.col("events").isNotNull())
