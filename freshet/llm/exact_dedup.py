"""Exact duplicates by recipes of content-defined chunks.

A text without its white space is cut where the content says so: at the first sentence mark after
512 characters, at 4,096 at the latest. A document becomes the ordered list of its chunks'
identifiers, and two documents are copies if the lists are equal. Long texts are read once and never
shuffled; what moves are identifiers.

An identifier is the 64-bit hash of a chunk. It is verified against the chunk's SHA-256: the
dictionary of all distinct (hash, proof) pairs shows hashes with several proofs, and their chunks get
identifiers of their own before lists are compared.

Only column expressions. Groups of any size: the best row of a group is a combined minimum, and the
join back is split by AQE where one list has a large share of the rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.llm.frames import keep_rows, materialise, numbered

WHITE_SPACE = (" ", "\t", "\n", "\x0b", "\x0c", "\r")
CHUNK = r"(?s).{512,4095}?[.!?]|.{1,4096}"


def without_space(text: Column) -> Column:
    return reduce(lambda t, c: F.replace(t, F.lit(c), F.lit("")), WHITE_SPACE, F.coalesce(text, F.lit("")))


def recipes(docs: DataFrame, text: str = "text", id_col: str = "doc_id", bits: int = 64) -> DataFrame:
    """Per row: its number, id, code points, SHA-256 of the bare text and its chunks in order, each
    with the lowest `bits` bits of its hash and its proof. Null text counts as empty: no chunks."""
    rows = numbered(docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")))
    bare = rows.select("_row", "doc_id", F.length(F.coalesce("text", F.lit(""))).alias("_length"), without_space(F.col("text")).alias("_bare"))
    pieces = F.regexp_extract_all("_bare", F.lit(CHUNK), F.lit(0))
    # The lowest bits, moved up and down again: all 64 leave the hash as it is.
    short = lambda h: F.shiftright(F.shiftleft(h, 64 - bits), 64 - bits)
    chunk = lambda c: F.struct(short(F.xxhash64(c)).alias("id"), F.unhex(F.sha2(c, 256)).alias("proof"))
    return bare.select(
        "_row",
        "doc_id",
        F.col("_length").cast("long").alias("_length"),
        F.sha2("_bare", 256).alias("text_sha256"),
        F.transform(pieces, chunk).alias("chunks"),
    )


def verified(rows: DataFrame) -> DataFrame:
    """The rows with `recipe`, the ordered list of verified identifiers, in place of `chunks`.

    An identifier is (hash, 0); of several chunks that share a hash, each is (hash, its rank by proof).
    """
    dictionary = rows.select(F.explode("chunks").alias("c")).select("c.id", "c.proof").distinct()
    clashes = materialise(
        dictionary.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list("proof")).alias("proofs"))
        .filter("n > 1").drop("n"),
        "clashes",
    )
    plain = rows.withColumn("recipe", F.transform("chunks", lambda c: F.struct(c["id"], F.lit(0).alias("rank"))))
    if clashes.isEmpty():
        return plain.drop("chunks")
    ranked = (
        rows.select("_row", F.posexplode("chunks").alias("at", "c"))
        .select("_row", "at", "c.id", "c.proof")
        .join(clashes, "id", "left")
        .select("_row", "at", "id", F.coalesce(F.array_position("proofs", F.col("proof")) - 1, F.lit(0)).cast("int").alias("rank"))
        .groupBy("_row")
        .agg(F.sort_array(F.collect_list(F.struct("at", "id", "rank"))).alias("_list"))
        .select("_row", F.transform("_list", lambda c: F.struct(c["id"], c["rank"])).alias("_ranked"))
    )
    return (
        plain.join(ranked, "_row", "left")
        .withColumn("recipe", F.coalesce("_ranked", "recipe"))
        .drop("chunks", "_ranked")
    )


def duplicates(docs: DataFrame, text: str = "text", id_col: str = "doc_id", bits: int = 64) -> DataFrame:
    """One row per row of `docs`: `_row`, `doc_id`, `keep_id`, `group_size`, `kept`, `text_sha256`.

    Of equal texts the row with the most code points stays, then the smallest id (null last), then
    the first in the files; so of repeated rows one stays. Null and empty texts, and those of white
    space alone, are copies of each other. No rows in, no rows out; other columns are not looked at.
    """
    rows = materialise(verified(materialise(recipes(docs, text, id_col, bits), "recipes")), "lists")
    best = F.min(F.struct((-F.col("_length")).alias("less"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "_row"))
    groups = materialise(
        rows.groupBy("recipe").agg(F.count(F.lit(1)).alias("group_size"), best.alias("best"))
        .select("recipe", "group_size", F.col("best.doc_id").alias("keep_id"), F.col("best._row").alias("_keep_row")),
        "groups",
    )
    return rows.join(groups, "recipe").select(
        "_row", "doc_id", "keep_id", "group_size", (F.col("_row") == F.col("_keep_row")).alias("kept"), "text_sha256"
    )


def deduplicate(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The documents that stay, with all their columns."""
    return keep_rows(docs, duplicates(docs, text, id_col).filter("kept"))
