"""Reading source tables: window scans, missing tables, empty-source policy, JSON rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.functions.times import ts_literal


ROW_NUMBER = "_row_number"


def load_table(
    spark: SparkSession, table: str | None = None, path: str | None = None, fmt: str = "parquet"
) -> DataFrame | None:
    """A catalog table or a path; None where it does not exist. Any other error is raised."""
    if table is not None:
        return spark.table(table) if spark.catalog.tableExists(table) else None
    try:
        return spark.read.format(fmt).load(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


@dataclass(frozen=True)
class Source:
    """One input table: where it is, its key and its update time.

    `row_id` names further columns that, with the key, tell rows of the table apart; by default the
    update time. Sampling after a join uses them.
    """

    key: str
    ts: str
    table: str | None = None
    path: str | None = None
    frame: DataFrame | None = None
    fmt: str = "parquet"
    row_id: tuple[str, ...] = ()

    def ids(self) -> tuple[str, ...]:
        return self.row_id or (self.ts,)

    def number(self, df: DataFrame) -> DataFrame:
        """Number the rows of a scan, for joins to spread copies of a row by.

        Read straight from files, a lost task's rows get the same numbers when it is run again. That
        does not hold behind a shuffle, as a view or a frame of the caller's may have one.
        """
        if self.frame is not None:
            return df
        stored = ("MANAGED", "EXTERNAL")
        if self.table is not None and df.sparkSession.catalog.getTable(self.table).tableType not in stored:
            return df
        return df.withColumn(ROW_NUMBER, F.monotonically_increasing_id())

    def load(self, spark: SparkSession) -> DataFrame | None:
        if self.frame is not None:
            return self.frame
        return load_table(spark, self.table, self.path, self.fmt)


def check_same_key(sources: Sequence[Source]) -> None:
    keys = {source.key for source in sources}
    if len(keys) > 1:
        raise ValueError(f"all sources must use the same key column, found {sorted(keys)}")


def scan_window(df: DataFrame, ts: str, cutoff: datetime | None) -> DataFrame:
    """Rows updated at or after the cut-off. Rows without an update time never qualify."""
    if cutoff is None:
        return df.filter(F.col(ts).isNotNull())
    return df.filter(F.col(ts) >= ts_literal(cutoff, df.schema[ts].dataType))


def relative_cutoff(df: DataFrame, ts: str, hours: int) -> datetime | None:
    """`hours` before the newest row. Resolved once, to a constant the scan can push down; the
    aggregate reads one column and returns one row."""
    newest = F.max(ts).cast("timestamp_ntz") - F.make_interval(hours=F.lit(hours))
    return df.agg(newest.alias("cutoff")).first()["cutoff"]


def read_sources(
    spark: SparkSession, sources: Sequence[Source], cutoff: datetime | None, warm: bool
) -> list[tuple[Source, DataFrame]]:
    """Window scans of all sources, by the rule for empty and missing ones.

    With nothing processed yet (`warm` false) such sources are left out and the rest go on; once
    there is state, one of them empties the whole read. Judged before the incremental filter.
    """
    check_same_key(sources)
    alive = []
    for source in sources:
        df = source.load(spark)
        if df is not None:
            df = scan_window(df, source.ts, cutoff)
            if not df.isEmpty():
                alive.append((source, df))
                continue
        if warm:
            return []
    return alive


def read_json_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A JSON file holding a list of objects."""
    return spark.read.schema(schema).json(path, multiLine=True)
