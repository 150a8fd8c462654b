"""Stored tables: Parquet, partitioned by period (month unless said otherwise), merged by key.

Parquet has no MERGE. A merge reads only the periods the source touches, writes
the merged rows next to the table, and then moves just those periods to their place.
If the driver dies while periods are being replaced, those not moved yet are still
there and the next merge (or ``recover``) moves them first. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from barline.schemas import conform
from barline.session import scratch_folder

PERIOD = "period"


def stage(df: DataFrame, purpose: str) -> DataFrame:
    """Written to the shared scratch folder and read back: computed once, lineage cut."""
    spark = df.sparkSession
    path = scratch_folder(spark, purpose)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(staged: DataFrame) -> None:
    """Delete what ``stage`` wrote; nothing may read ``staged`` afterwards."""
    spark = staged.sparkSession
    files = staged.inputFiles()
    if files:
        folder = spark._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@dataclass(frozen=True)
class KeyedTable:
    path: str
    schema: T.StructType
    keys: list[str]
    period_of: str  # column that names the partition
    grain: str = "yyyy-MM"  # its date format, or "hash <n>" for n parts by the column's hash

    def read(self, spark: SparkSession, periods: list[str] | None = None) -> DataFrame:
        """The table, or only some of its periods (pruned before the scan)."""
        if not self._exists(spark, self.path):
            # The filter makes it an empty relation to the optimizer: no join with it is run.
            return spark.createDataFrame([], self.schema).filter(F.lit(False))
        # A stored file may lack columns added later: they read as NULL.
        stored = spark.read.schema(self._stored_schema()).parquet(self.path)
        if periods is not None:
            stored = stored.filter(F.col(PERIOD).isin(periods))
        return conform(stored, self.schema)

    def merge(
        self, source: DataFrame, combine: Callable[[DataFrame, DataFrame, list[str]], DataFrame]
    ) -> None:
        """``combine(target, source, keys)`` on the touched periods, then replace them.

        ``source`` is read twice; pass a stored or cached frame.
        """
        spark = source.sparkSession
        self.recover(spark)
        periods = self.periods(source)
        if not periods:
            return
        merged = combine(self.read(spark, periods), source, self.keys)
        self._write(conform(merged, self.schema), self._pending)
        self.recover(spark)

    def recover(self, spark: SparkSession) -> None:
        """Replace the periods of a merged copy that is complete, if there is one.

        Its folders are renamed, not written again.
        """
        if not self._exists(spark, f"{self._pending}/_SUCCESS"):
            return
        new_path = spark._jvm.org.apache.hadoop.fs.Path
        pending, table = new_path(self._pending), new_path(self.path)
        fs = pending.getFileSystem(spark._jsc.hadoopConfiguration())
        fs.mkdirs(table)
        for found in fs.listStatus(pending):
            name = found.getPath().getName()
            if name.startswith(f"{PERIOD}="):
                fs.delete(new_path(table, name), True)
                if not fs.rename(found.getPath(), new_path(table, name)):
                    raise OSError(f"{found.getPath()} could not be moved to {self.path}")
        fs.delete(pending, True)

    @property
    def _pending(self) -> str:
        return f"{self.path.rstrip('/')}__pending"

    def _write(self, df: DataFrame, path: str) -> None:
        # `rebalance` sizes the files by data: small periods share a task, a
        # large one is split over several.
        rows = df.withColumn(PERIOD, self._period()).hint("rebalance", PERIOD)
        rows.write.mode("overwrite").partitionBy(PERIOD).parquet(path)

    def periods(self, dates: DataFrame) -> list[str]:
        """The periods of the rows of ``dates``, which has the column that names them: one value per period."""
        return [r[0] for r in dates.select(self._period()).distinct().collect()]

    def _period(self):
        if self.grain.startswith("hash "):
            part = F.pmod(F.xxhash64(self.period_of), F.lit(int(self.grain[5:])))
            return F.format_string("part-%04d", part)
        return F.coalesce(F.date_format(self.period_of, self.grain), F.lit("none"))

    def _stored_schema(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField(PERIOD, T.StringType())])

    def _exists(self, spark: SparkSession, name: str) -> bool:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
