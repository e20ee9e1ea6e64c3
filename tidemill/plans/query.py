"""A registered query: the Spark callable and, where SQL can say it, the statement that checks it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.plans.oracle_tables import with_tables
from tidemill.session import prepare

DIGITS = 4
# Keeps an exact tie at the last digit from being rounded differently by the two engines.
NUDGE = "1e-9"


def comparable(df: DataFrame) -> DataFrame:
    """Plain types both engines share: bigint, rounded double, timestamp without zone."""
    columns = []
    for field in df.schema.fields:
        col, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)):
            col = F.round(col.cast("double") + F.lit(float(NUDGE)), DIGITS)
        elif isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
            col = col.cast("bigint")
        elif isinstance(kind, T.TimestampType):
            col = col.cast("timestamp_ntz")
        elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            col = F.to_json(col, {"ignoreNullFields": "false"})
        columns.append(col.alias(field.name))
    return df.select(*columns)


@dataclass(frozen=True)
class Query:
    key: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None
    floats: str = ""
    ints: str = ""

    def spark(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(self.run(prepare(spark), sf_dir))

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        casts = [f"round(CAST({c} AS DOUBLE) + {NUDGE}, {DIGITS}) AS {c}" for c in self.floats.split()]
        casts += [f"CAST({c} AS BIGINT) AS {c}" for c in self.ints.split()]
        body = self.sql
        if casts:
            body = f"SELECT * REPLACE ({', '.join(casts)}) FROM ({with_tables(body)}) AS q"
            return body
        return with_tables(body)


def div(a: str, b: str) -> str:
    return f"CAST({a} AS DOUBLE) / nullif({b}, 0)"


def pc(a: str, b: str) -> str:
    return f"100.0 * CAST({a} AS DOUBLE) / nullif({b}, 0)"
