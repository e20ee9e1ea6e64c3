"""Batch readers with declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DateType, StructType

from tidemill import schemas


def source_table(spark: SparkSession, root: str, layer: str, name: str) -> DataFrame:
    """Scan a table of a layer; a declared table is read with its schema, any other with its file schema."""
    path = f"{root}/{layer}/{name}"
    declared = schemas.LAYERS.get(layer, {}).get(name)
    if declared is None:
        return spark.read.parquet(path)
    return spark.read.schema(stored_schema(layer, name)).parquet(path)


def stored_schema(layer: str, name: str) -> StructType:
    """Declared columns plus the derived partition column, all nullable as files are."""
    schema, partition, _ = schemas.LAYERS[layer][name]
    stored = StructType()
    for field in schema.fields:
        stored = stored.add(field.name, field.dataType, True)
    if partition and partition not in schema.names:
        stored = stored.add(partition, DateType(), True)
    return stored


def source_events_file(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Event files: one JSON object per line, or with ``multiline`` one JSON array per file."""
    return spark.read.schema(schemas.EVENT_MESSAGE).json(path, multiLine=multiline)
