"""Layered tables under one root folder: raw, staging, mart, monitoring."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemill import schemas
from tidemill.functions.exprs import Day, day
from tidemill.functions.keyed import first_per_key
from tidemill.session import shared_folder
from tidemill.sources.tables import source_table, stored_schema

MODES = {"truncate": "overwrite", "append": "append", "empty": "errorifexists"}


@dataclass(frozen=True)
class Lake:
    spark: SparkSession
    root: str
    # width of a date folder of declared tables: day, month or year
    date_unit: str = "day"

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def read(self, layer: str, name: str) -> DataFrame:
        return source_table(self.spark, self.root, layer, name)

    # ---- writing

    def _writer(self, df: DataFrame, partition_by: str | None, cluster_by: Sequence[str]):
        """Rows of a partition value end up in few, evenly sized, sorted files.

        The rebalance hint lets adaptive execution split a value that holds much of the data over several tasks
        and merge the small ones, which hashing on the partition column alone would not.
        """
        order = [c for c in (partition_by, *cluster_by) if c]
        if partition_by:
            df = df.hint("rebalance", partition_by)
        if order:
            df = df.sortWithinPartitions(*order)
        writer = df.write
        return writer.partitionBy(partition_by) if partition_by else writer

    def ctas_replace(
        self,
        df: DataFrame,
        layer: str,
        name: str,
        partition_by: str | None = None,
        cluster_by: Sequence[str] = (),
    ) -> DataFrame:
        """Full refresh: replace the table by the frame."""
        writer = self._writer(df, partition_by, cluster_by)
        writer.mode("overwrite").option("partitionOverwriteMode", "static").parquet(self.path(layer, name))
        return self.read(layer, name)

    def partition_overwrite(
        self, df: DataFrame, layer: str, name: str, partition_by: str, cluster_by: Sequence[str] = ()
    ) -> DataFrame:
        """Replace only the partitions the frame has rows for."""
        writer = self._writer(df, partition_by, cluster_by)
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(self.path(layer, name))
        return self.read(layer, name)

    def append(self, df: DataFrame, layer: str, name: str, partition_by: str | None = None) -> None:
        self._writer(df, partition_by, ()).mode("append").parquet(self.path(layer, name))

    def store(self, df: DataFrame, layer: str, name: str) -> DataFrame:
        """Full refresh of a declared table, in its declared columns and layout."""
        _, partition, cluster = schemas.LAYERS[layer][name]
        return self.ctas_replace(self.shaped(df, layer, name), layer, name, partition, cluster)

    def shaped(self, df: DataFrame, layer: str, name: str) -> DataFrame:
        """The declared columns of a table and its partition column."""
        schema, partition, _ = schemas.LAYERS[layer][name]
        out = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
        if partition and partition not in schema.names:
            out = out.withColumn(partition, F.to_date(F.date_trunc(self.date_unit, _PARTITION_SOURCE[partition])))
        return out

    def merge(
        self, new: DataFrame, layer: str, name: str, keys: Sequence[str], order: Sequence[str], stored: bool = False
    ) -> DataFrame:
        """Put new rows in the place of stored rows with the same keys, where they come later in ``order``.

        Only partitions are rewritten that hold a new row or a stored row with its keys. The merged rows are stored aside
        before they replace what they were read from. So are the new rows unless they are ``stored`` already: they are read
        several times. Nothing of that is left when the merge ends.
        """
        with self.passing() as aside:
            new = self.shaped(new, layer, name)
            return self._merge(new if stored else aside(new, f"{name}-new"), layer, name, keys, order, aside)

    def _merge(
        self,
        new: DataFrame,
        layer: str,
        name: str,
        keys: Sequence[str],
        order: Sequence[str],
        aside: Callable[[DataFrame, str], DataFrame],
    ) -> DataFrame:
        _, partition, cluster = schemas.LAYERS[layer][name]
        old = self.read(layer, name)
        touched = None
        if partition:
            moved = old.join(new.select(*keys), [*keys], "left_semi").select(partition)
            touched = aside(new.select(partition).unionByName(moved).distinct(), f"{name}-touched")
            # one row per date; nulls are a partition of their own
            base = old.join(touched.withColumnRenamed(partition, "_p"), F.col(partition).eqNullSafe(F.col("_p")), "left_semi")
        else:
            base = old
        both = base.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
        merged = first_per_key(both, keys, [*[F.desc(c) for c in order], F.desc("_new")]).drop("_new")
        merged = aside(merged, f"{name}-merged")
        if not partition:
            return self.ctas_replace(merged, layer, name, None, cluster)
        result = self.partition_overwrite(merged, layer, name, partition, cluster)
        for row in touched.join(merged.select(partition), partition, "left_anti").filter(F.col(partition).isNotNull()).collect():
            fs, path = self._fs(f"{self.path(layer, name)}/{partition}={row[0]}")  # dates that lost their last row
            fs.delete(path, True)
        return result

    def replace_dates(self, rows: DataFrame, layer: str, name: str, column: str, dates: DataFrame) -> DataFrame:
        """Full refresh of a small table by date: stored rows of other dates stay, those of ``dates`` give way to ``rows``."""
        named = dates.select(F.col(dates.columns[0]).alias("_d")).distinct()
        kept = self.read(layer, name).join(named, F.col(column).eqNullSafe(F.col("_d")), "left_anti")
        with self.passing() as aside:
            return self.store(aside(kept.unionByName(rows.select(*kept.columns)), f"{name}-merged"), layer, name)

    def aside(self, df: DataFrame, purpose: str) -> DataFrame:
        """Rows stored in the shared folder, for a table that is about to be replaced by what was read from it."""
        return self._aside(df, shared_folder(self.spark, purpose))

    @contextmanager
    def passing(self) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
        """``aside`` for rows that nothing reads once the block has ended: there they are removed, also after an error."""
        folders = []

        def aside(df: DataFrame, purpose: str) -> DataFrame:
            folders.append(shared_folder(self.spark, purpose))
            return self._aside(df, folders[-1])

        try:
            yield aside
        finally:
            for folder in folders:
                fs, path = self._fs(folder)
                fs.delete(path, True)

    def _aside(self, df: DataFrame, folder: str) -> DataFrame:
        df.write.option("compression", "zstd").parquet(f"{folder}/rows")
        return self.spark.read.schema(df.schema).parquet(f"{folder}/rows")

    def run_query_to_table(
        self, sql: str, layer: str, name: str, args: Mapping[str, object] | None = None, disposition: str = "truncate"
    ) -> tuple[int, float, int]:
        """Run SQL with named parameters into a table; returns the rows written, the seconds it took and the bytes added."""
        seen = Observation()
        df = self.spark.sql(sql, args=dict(args or {})).observe(seen, F.count(F.lit(1)).alias("rows"))
        before = self.stored_bytes(layer, name) if disposition == "append" else 0
        started = time.perf_counter()
        writer = df.write.mode(MODES[disposition]).option("partitionOverwriteMode", "static")
        writer.parquet(self.path(layer, name))
        return int(seen.get["rows"]), time.perf_counter() - started, self.stored_bytes(layer, name) - before

    def stored_bytes(self, layer: str, name: str) -> int:
        """Size of a table's files as the file system sums it up; 0 where there is no table."""
        fs, path = self._fs(self.path(layer, name))
        return fs.getContentSummary(path).getLength() if fs.exists(path) else 0

    def materialize_model(
        self,
        df: DataFrame,
        name: str,
        kind: str,
        partition_by: str | None = None,
        cluster_by: Sequence[str] = (),
        layer: str = "mart",
    ) -> DataFrame:
        """``ephemeral``: the frame itself; ``view``: also a view of that name; ``table``: written and read back."""
        if kind == "ephemeral":
            return df
        if kind == "view":
            df.createOrReplaceTempView(name)
            return self.spark.table(name)
        if kind == "table":
            return self.ctas_replace(df, layer, name, partition_by, cluster_by)
        raise ValueError(f"unknown materialization {kind}")

    def sink_quality_results(self, checks: DataFrame) -> None:
        """Append check records to the monitoring table."""
        shaped = checks.withColumn("checked_date", F.to_date("checked_at"))
        self.append(shaped, "monitoring", "data_quality_checks", "checked_date")

    # ---- upkeep

    def _fs(self, path: str):
        jvm = self.spark._jvm
        hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
        return hadoop_path.getFileSystem(self.spark._jsc.hadoopConfiguration()), hadoop_path

    def exists(self, layer: str, name: str) -> bool:
        fs, path = self._fs(self.path(layer, name))
        return fs.exists(path)

    def bootstrap_layers(self) -> DataFrame:
        """Create every declared table that does not exist yet; returns what was created."""
        created = []
        for layer, tables in schemas.LAYERS.items():
            for name, (_, partition, _) in tables.items():
                if self.exists(layer, name):
                    continue
                writer = self.spark.createDataFrame([], stored_schema(layer, name)).write
                (writer.partitionBy(partition) if partition else writer).parquet(self.path(layer, name))
                created.append((layer, name))
        return self.spark.createDataFrame(created, "layer string, table_name string")

    def expire_raw_partitions(
        self, name: str, as_of: Day, days: int = 90, layer: str = "raw", unit: str | None = None
    ) -> DataFrame:
        """Drop rows older than ``days`` before ``as_of``; returns the dropped date folders.

        A folder goes when its last day is before the cutoff; ``unit`` is its width (default: this lake's). One folder per
        parent can hold the cutoff itself: its older rows are removed by rewriting that folder beside, under a name that no
        reader sees, and swapping it in by renames. A swap that was interrupted is finished or undone by the next run.
        Date folders are found at any depth, so a table split by another column first is expired too. Otherwise only folder
        names are looked at.
        """
        unit = unit or self.date_unit
        cutoff = day(as_of) - timedelta(days=days)
        dropped = []
        self._finish_cuts(self.path(layer, name))
        for fs, path, column, first in list(self._date_folders(self.path(layer, name))):
            if _last_day(first, unit) < cutoff:
                fs.delete(path, True)
                dropped.append((name, column, first))
            elif first < cutoff:
                self._cut_folder(fs, path, column, cutoff)
        return self.spark.createDataFrame(dropped, "table_name string, partition_column string, partition_date date")

    def _date_folders(self, location: str):
        fs, path = self._fs(location)
        for status in fs.listStatus(path):
            column, _, value = status.getPath().getName().partition("=")
            if column.startswith("."):
                continue
            if status.isDirectory() and value[:4].isdigit() and value[4:5] == "-":
                yield fs, status.getPath(), column, day(value)
            elif status.isDirectory() and value:
                yield from self._date_folders(status.getPath().toString())

    def _cut_folder(self, fs, path, column: str, cutoff) -> None:
        rows = self.spark.read.parquet(path.toString())
        source = _PARTITION_SOURCE.get(column, column)
        if source not in rows.columns:
            return
        time = F.to_date(F.col(source))
        for _ in self._cut_steps(fs, path, rows.filter(time.isNull() | (time >= F.lit(cutoff)))):
            pass

    def _cut_steps(self, fs, path, kept: DataFrame):
        """Puts ``kept`` in the place of a folder; yields after every step. Readers pass over names that begin with a dot."""
        new, old = _beside(path, _KEPT), _beside(path, _OLD)
        kept.write.mode("overwrite").parquet(new.toString())
        yield
        fs.rename(path, old)
        yield
        fs.rename(new, path)
        yield
        fs.delete(old, True)
        yield

    def _finish_cuts(self, location: str) -> None:
        """A folder that was moved away is replaced by its kept rows; kept rows beside a folder in place are dropped."""
        fs, root = self._fs(location)
        statuses = [s.getPath() for s in fs.listStatus(root) if s.isDirectory()] if fs.exists(root) else []
        for old in [p for p in statuses if p.getName().startswith(_OLD)]:
            path = old.getParent().suffix("/" + old.getName()[len(_OLD) :])
            new = _beside(path, _KEPT)
            if fs.exists(new) and not fs.exists(path):
                fs.rename(new, path)
            elif fs.exists(new):  # rows came for that date since
                for status in fs.listStatus(new):
                    if status.getPath().getName().startswith("part-"):
                        fs.rename(status.getPath(), path.suffix("/" + status.getPath().getName()))
            fs.delete(old, True)
        for path in statuses:
            if path.getName().startswith(_KEPT):
                fs.delete(path, True)
            elif "=" in path.getName() and not path.getName().startswith(_OLD):
                self._finish_cuts(path.toString())


_KEPT, _OLD = ".kept-", ".old-"


def _beside(path, prefix: str):
    return path.getParent().suffix("/" + prefix + path.getName())


def _last_day(first, unit: str):
    if unit == "day":
        return first
    after = first.replace(day=1) + timedelta(days=32) if unit == "month" else first.replace(month=12, day=31) + timedelta(days=1)
    return after.replace(day=1) - timedelta(days=1)


# partition column -> timestamp it is derived from
_PARTITION_SOURCE = {
    "event_date": "event_timestamp",
    "ordered_date": "ordered_at",
    "created_date": "created_at",
    "cdc_date": "cdc_timestamp",
    "checked_date": "checked_at",
}
