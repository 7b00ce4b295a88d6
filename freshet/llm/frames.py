"""What the corpus operators share: shared scratch tables, row numbers, words, connected components."""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.session import ensure_checkpoint_dir, scratch_dir
from freshet.sinks.target import empty_folder
from freshet.sources.scan import load_table

# A word, as the data contracts define it. `bytes.split()` cuts at the same six characters.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


_WRITTEN: list[str] = []


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write the frame below the shared checkpoint folder and read it back: the lineage is cut, and
    no executor's loss can change or take away what later steps read."""
    path = scratch_dir(df.sparkSession, name)
    _WRITTEN.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clean(spark: SparkSession) -> int:
    """Empty the scratch tables that this driver has written so far, and say how many there were. For when the
    results made of them are written: they are read from these tables until then."""
    emptied = 0
    while _WRITTEN:
        path = _WRITTEN.pop()
        if load_table(spark, path=path) is not None:
            empty_folder(spark, path)
            emptied += 1
    return emptied


def numbered(df: DataFrame, name: str = "_row") -> DataFrame:
    """Rows numbered by where they lie in their files: a task run again numbers them the same, and
    so does a second scan. It tells rows apart that agree in everything else. The frame is to be a scan
    of files, or cheap and certain to come out in the same order; `materialise` any other first."""
    return df.withColumn(name, F.monotonically_increasing_id())


def keep_rows(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """The documents whose number (by `numbered`) is in the column `_row` of `rows`."""
    return numbered(docs, "_kept_row").join(rows.select(F.col("_row").alias("_kept_row")), "_kept_row", "left_semi").drop(
        "_kept_row"
    )


def crc_fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def unsigned_hex(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def connected(links: DataFrame, seed: int = 7) -> DataFrame:
    """Connected components of the undirected links (a, b), two longs: one row (node, root) per node.

    Rounds of contraction: every node joins the smallest of its neighbours and itself, in an order
    drawn anew each round by a bit mask, links are renamed and those within a node drop out. The
    number of nodes with links shrinks by a constant factor a round in expectation, whatever the
    shape, so the rounds grow with the logarithm of the largest component. Minima are combined before
    the shuffle, so a node with very many neighbours is no burden; nothing is gathered in one task.
    """
    ensure_checkpoint_dir(links.sparkSession)
    draw = random.Random(seed)

    def tidy(pairs: DataFrame) -> DataFrame:
        return pairs.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    left, names = tidy(links).checkpoint(), None
    while not left.isEmpty():
        mask = F.lit(draw.getrandbits(63) - draw.getrandbits(1) * 2**63)
        both = left.select(F.col("a").alias("node"), F.col("b").alias("other")).union(left.select("b", "a"))
        smallest = F.least(F.min(F.col("other").bitwiseXOR(mask)), F.col("node").bitwiseXOR(mask))
        joined = both.groupBy("node").agg(smallest.bitwiseXOR(mask).alias("root")).checkpoint()
        names = (
            joined
            if names is None
            else names.join(joined.toDF("root", "_next"), "root", "left")
            .select("node", F.coalesce("_next", "root").alias("root"))
            .checkpoint()
        )
        left = tidy(
            left.join(joined.toDF("a", "_a"), "a")
            .join(joined.toDF("b", "_b"), "b")
            .select(F.col("_a").alias("a"), F.col("_b").alias("b"))
        ).checkpoint()
    return left.toDF("node", "root") if names is None else names

