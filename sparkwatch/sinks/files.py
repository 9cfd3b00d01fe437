"""SNK-02, SNK-03, SNK-12 to SNK-14: JSON and CSV output, written by the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

JSON_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def write_json(
    df: DataFrame, path: str, mode: str = "overwrite", partition_by: tuple[str, ...] = ()
) -> None:
    """JSON lines with ISO times."""
    df.write.mode(mode).partitionBy(*partition_by).option("timestampFormat", JSON_TIME).json(path)


def flat_columns(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, for formats that cannot nest."""
    nested = (ArrayType, MapType, StructType)
    return df.select(
        *[
            F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header; texts keep quotes and line breaks."""
    flat_columns(df).write.mode(mode).options(
        header=True, escape='"', quote='"', timestampFormat=JSON_TIME
    ).csv(path)
