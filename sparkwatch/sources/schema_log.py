"""SRC-02, NRM-06: formats that grow. Bronze rescues what its schema misses, a log learns its types."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import (
    ArrayType, DataType, DoubleType, IntegerType, LongType, MapType, NullType, StringType, StructField, StructType,
)

_OBJECT = "map<string,variant>"
_NUMBERS = (IntegerType(), LongType(), DoubleType())


def _without_nulls(text: Column) -> Column:
    """JSON text without its null fields; whatever else the pattern meets, it meets on both sides of a comparison."""
    return F.regexp_replace(F.regexp_replace(text, r'"[^"\\]*":null,?', ""), r",\}", "}")


def _lost(value: Column, field: StructField, raw: Column, text: Column) -> Column:
    """Whether the typed ``value`` does not hold what the JSON field ``raw``, a variant, says; ``text`` is its text.

    A nested value that is written as it came is whole. Only others are compared as variants, whose texts are dear.
    """
    given = raw.isNotNull() & ~F.is_variant_null(raw)
    if not isinstance(field.dataType, (StructType, ArrayType, MapType)):
        return given & value.isNull()
    shown = F.to_json(value)
    back = F.to_json(F.try_parse_json(shown))
    changed = F.coalesce(shown != text, F.lit(True))
    return given & (value.isNull() | (changed & (_without_nulls(back) != _without_nulls(F.to_json(raw)))))


def rescue_typed(lines: DataFrame, schema: StructType, rescued: str = "rescued", text: str = "value") -> DataFrame:
    """JSON text in the types of ``schema``; fields that do not fit stay in ``rescued`` with their JSON types.

    ``rescued`` is null where a line fits. Otherwise it is a JSON object of the fields that the schema
    does not know, of those that are null in their type, and of nested ones that their type would not give back
    whole. A line that is no JSON object is ``{"_line": ...}``; null and blank lines have nothing to keep.
    A text column takes any JSON value as its text. Other columns stay.
    """
    line = F.col(text)
    one = F.array(F.struct(
        F.from_json(line, schema).alias("t"), F.from_json(line, _OBJECT).alias("m"),
        F.from_json(line, "map<string,string>").alias("s"),
    ))
    rows = lines.select("*", F.explode(one).alias("_r"))
    known = {f.name: F.col("_r.t").getField(f.name) for f in schema.fields}
    raw = {name: F.try_element_at("_r.m", F.lit(name)) for name in known}
    texts = {name: F.try_element_at("_r.s", F.lit(name)) for name in known}
    gone = F.array_compact(F.array(*[
        F.when(_lost(known[f.name], f, raw[f.name], texts[f.name]), F.lit(f.name)) for f in schema.fields
    ]))
    names = F.array(*[F.lit(n) for n in known]).cast("array<string>")
    # Bound one after the other, so that the lost fields are found once for a row and not for each of its fields.
    kept = F.transform(
        F.array(gone.cast("array<string>")),
        lambda lost: F.map_filter("_r.m", lambda name, _: ~F.array_contains(names, name) | F.array_contains(lost, name)),
    )
    shown = F.transform(kept, lambda fields: F.when(F.size(fields) > 0, F.to_json(fields)))
    rest = (
        F.when(line.isNull() | (F.trim(line) == ""), None)
        .when(F.col("_r.m").isNull(), F.to_json(F.struct(line.alias("_line"))))
        .otherwise(F.get(shown, F.lit(0)))
    )
    others = [F.col(f"`{c}`") for c in lines.columns if c != text]
    return rows.select(*others, *[v.alias(n) for n, v in known.items()], rest.alias(rescued))


def variant_type(text: str) -> DataType:
    """The type for what ``schema_of_variant`` says: mixed values and long decimals become text."""
    parts = re.split(r"(`(?:[^`]|``)*`)", text)
    for i in range(0, len(parts), 2):  # the others are quoted names
        part = re.sub(r"\bOBJECT<>", "MAP<STRING, STRING>", parts[i])
        part = re.sub(r"\bOBJECT<", "STRUCT<", part)
        part = re.sub(r"\bVARIANT\b(?!:)", "STRING", part)
        parts[i] = re.sub(
            r"\bDECIMAL\((\d+),\s*\d+\)", lambda m: "DOUBLE" if int(m.group(1)) <= 15 else "STRING", part
        )
    return DataType.fromDDL("".join(parts))


def widen(a: DataType, b: DataType) -> DataType:
    """The narrowest type for the values of both: numbers grow, structures merge, all else becomes text.

    A double holds longs beyond 2^53 rounded. Structures whose fields differ only in case become text.
    """
    if a == b or isinstance(b, NullType):
        return a
    if isinstance(a, NullType):
        return b
    if a in _NUMBERS and b in _NUMBERS:
        return max(a, b, key=_NUMBERS.index)
    if isinstance(a, ArrayType) and isinstance(b, ArrayType):
        return ArrayType(widen(a.elementType, b.elementType))
    if isinstance(a, MapType) and isinstance(b, MapType):
        return MapType(a.keyType, widen(a.valueType, b.valueType))
    if isinstance(a, StructType) and isinstance(b, StructType):
        merged = {f.name: f.dataType for f in a.fields}
        for f in b.fields:
            merged[f.name] = widen(merged.get(f.name, NullType()), f.dataType)
        if len({name.lower() for name in merged}) == len(merged):
            return StructType([StructField(n, t) for n, t in merged.items()])
    return StringType()


def _readable(t: DataType) -> DataType:
    """The type with text where only nulls were seen so far."""
    if isinstance(t, NullType):
        return StringType()
    if isinstance(t, ArrayType):
        return ArrayType(_readable(t.elementType))
    if isinstance(t, MapType):
        return MapType(t.keyType, _readable(t.valueType))
    if isinstance(t, StructType):
        return StructType([StructField(f.name, _readable(f.dataType)) for f in t.fields])
    return t


def _cast(value: Column, old: DataType, new: DataType) -> Column:
    """A value of an earlier type in the type that it was widened to."""
    if old == new:
        return value
    if isinstance(old, StructType) and isinstance(new, StructType):
        held = {f.name: f.dataType for f in old.fields}
        fields = [
            (_cast(value.getField(f.name), held[f.name], f.dataType) if f.name in held else F.lit(None).cast(f.dataType))
            .alias(f.name)
            for f in new.fields
        ]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(old, ArrayType) and isinstance(new, ArrayType):
        return F.transform(value, lambda x: _cast(x, old.elementType, new.elementType))
    if isinstance(old, MapType) and isinstance(new, MapType):
        return F.transform_values(value, lambda _, x: _cast(x, old.valueType, new.valueType))
    return F.to_json(value) if isinstance(old, (StructType, ArrayType, MapType)) else value.cast(new)


@dataclass(frozen=True)
class SchemaLog:
    """The versions of a bronze table's schema, learnt from what the table rescued.

    The table itself keeps the types of ``base`` for life, so neither its files nor the streams that read it
    ever meet another type. ``<path>/since=<n>`` holds the schema that is known from micro-batch n on. A batch
    looks at the schema of its own number and writes the next one, so a batch that is repeated writes
    the same version again. Types only widen (``widen``). ``typed`` reads the table in the latest version:
    rows of every age give the fields that are known by now, taken out of ``rescued``.

    Only top-level fields become columns, at most ``most_fields`` of them, known ones and then the most frequent
    ones first; others, and names that differ from a column only in case, stay in ``rescued``.
    """

    path: str
    base: StructType
    reserved: Sequence[str] = ("rescued", "ingestion_timestamp", "source_file", "_line")
    most_fields: int = 1000

    def versions(self, spark: SparkSession) -> list[tuple[int, StructType]]:
        """The versions by the micro-batch that each holds from; the first one is ``base``."""
        try:
            stored = spark.read.schema("schema string, since long").parquet(self.path).orderBy("since").collect()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            stored = []
        return [(0, self.base)] + [(r.since, StructType.fromJson(json.loads(r.schema))) for r in stored]

    def at(self, spark: SparkSession, number: int | None = None) -> StructType:
        """The schema for a micro-batch, or the latest one."""
        return [s for since, s in self.versions(spark) if number is None or since <= number][-1]

    def evolve(self, batch: DataFrame, number: int) -> None:
        """Learn the fields in ``rescued`` of a micro-batch; its types are merged where the rows are."""
        spark = batch.sparkSession
        known = self.at(spark, number)
        seen = batch.where("rescued IS NOT NULL").select(F.explode(F.from_json("rescued", _OBJECT)).alias("name", "value"))
        columns = F.array(*[F.lit(n) for n in known.names]).cast("array<string>")
        found = (
            seen.groupBy("name")
            .agg(F.schema_of_variant_agg("value").alias("type"), F.count("*").alias("rows"))
            .where("type <> 'VOID'")
            .orderBy(F.array_contains(columns, F.col("name")).desc(), F.desc("rows"), "name")
            .limit(self.most_fields)
        )
        fields = {f.name: f.dataType for f in known.fields}
        taken = {n.lower() for n in (*fields, *self.reserved)}
        for row in found.collect():
            if row.name in fields:
                fields[row.name] = widen(fields[row.name], variant_type(row.type))
            elif row.name.lower() not in taken and len(fields) < max(self.most_fields, len(self.base)):
                # Through widen, so that fields that differ only in case become text.
                fields[row.name] = widen(NullType(), variant_type(row.type))
                taken.add(row.name.lower())
        grown = StructType([StructField(n, t) for n, t in fields.items()])
        if grown != StructType([StructField(f.name, f.dataType) for f in known.fields]):
            version = spark.range(1).select(F.lit(grown.json()).alias("schema"))
            version.write.mode("overwrite").parquet(f"{self.path}/since={number + 1}")

    def start(
        self, bronze: DataFrame, checkpoint: str, name: str, every: str = "30 seconds", available_now: bool = False
    ) -> StreamingQuery:
        """Learn from a stream over the bronze table, of which only ``rescued`` is read."""
        trigger = {"availableNow": True} if available_now else {"processingTime": every}
        return (
            bronze.select("rescued").writeStream.queryName(name)
            .option("checkpointLocation", checkpoint)
            .foreachBatch(self.evolve)
            .trigger(**trigger)
            .start()
        )

    def typed(self, bronze: DataFrame) -> DataFrame:
        """The bronze rows in the latest schema; ``rescued`` keeps what no column holds.

        A field of ``base`` that came in other types has its widened type in all rows.
        """
        latest = self.at(bronze.sparkSession)
        base = {f.name: f.dataType for f in self.base.fields}
        learnt = [StructField(f.name, _readable(f.dataType)) for f in latest.fields if base.get(f.name) != f.dataType]
        if not learnt:
            return bronze
        kept = [F.col(f"`{c}`") for c in bronze.columns if c != "rescued"]
        rows = rescue_typed(bronze.select(F.struct(*kept).alias("_b"), "rescued"), StructType(learnt), text="rescued")
        values = {c: F.col("_b").getField(c) for c in bronze.columns if c != "rescued"}
        for f in learnt:
            again = F.col(f"`{f.name}`")
            values[f.name] = F.coalesce(again, _cast(values[f.name], base[f.name], f.dataType)) if f.name in base else again
        return rows.select(*[v.alias(n) for n, v in values.items()], "rescued")
