"""A corpus made ready for training: toxic documents go, copies and near copies go, sources are mixed to
their target weights and the mix is packed into sequences.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame that is written as Parquet and read
again as the next one's documents; all but the last give the columns of `documents`.

In every stage a null text counts as an empty one, texts are taken whole, rows without an id or repeated under
one are documents of their own, no rows give no rows, and columns beyond those a stage reads pass through it as
they are, whatever their names.
"""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

import freshet
from freshet.llm import exact_dedup, mixing, packing, simhash, toxicity
from freshet.llm.frames import materialise, read

# The executors need not have the package.
cloudpickle.register_pickle_by_value(freshet)


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Fitted on the labels of documents that are still here; what it predicts toxic, with a score of 0.5 or
    more, goes. A document without words gets the share of toxic ones and stays unless most are."""
    return toxicity.drop_toxic(docs, toxicity.train(docs, read(spark, sf_dir, "labels")))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that differ in white space alone, the longest stays, of equally long ones that of the smallest id
    (a null id after all others), of rows repeated in full the first in the files."""
    return exact_dedup.deduplicate(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose fingerprints hang together by links of 4 bits or fewer, one stays, that of the smallest
    id. Documents without words have one fingerprint and are a group like any other."""
    return simhash.deduplicate(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; one taken in part is cut to those words. Documents without words
    are not in a mix of words; a null source is a source like any other, the last."""
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document, with its sequence and place; a document taken twice is packed twice."""
    return packing.pack(docs).drop("_row")


STAGES = [
    ("toxicity", without_toxic),
    ("exact_dedup", without_copies),
    ("simhash_dedup", without_near_copies),
    ("mixing", mixed),
    ("packing", packed),
]

# A learned model and 64-bit hashes that SQL engines do not share; tests hold the stages against
# brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
