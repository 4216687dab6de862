"""Exact duplicates with a split of heavy hitters.

Two texts are equal if they agree after all blanks are deleted. A digest held by a large part of the rows would
send that part to one task if all rows were shuffled by digest. So a Misra-Gries summary (Spark's mergeable
frequent-items sketch, bounded state per task) names the digests that may be frequent; their groups are counted
exactly with map-side partial aggregates, and the verified winners, at most `heavy` rows, are broadcast to the
rows. Only the other digests, each below a known share of the rows, are shuffled.

Results by case: a null text counts as empty, and all empty texts are one group; of rows with equal text, length
and id (repeated rows, null ids last) each keeps its own row and `kept` is true for one of them; an empty table
gives an empty frame; further columns of the input are not touched by the work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodewatch.llm.text import keep_rows, row_key, without_blanks
from lodewatch.session import stored

HEAVY = 256  # digests whose groups are broadcast at most
TRACKED = 8192  # counters of the summary: a digest with more than 1/6000 of all rows is named surely


def normalised(text: Column) -> Column:
    """The text without blanks; empty for null."""
    return F.coalesce(without_blanks(text.cast("string")), F.lit(""))


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, row, digest, chars), written once: the later steps read these narrow rows and not the texts."""
    text = F.col(f"`{text_col}`")
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        F.unhex(F.sha2(normalised(text).cast("binary"), 256)).alias("digest"),
        F.coalesce(F.char_length(text.cast("string")), F.lit(0)).cast("bigint").alias("chars"),
    )
    return stored(rows.withColumn("row", F.monotonically_increasing_id()), "digests")


def heavy_digests(rows: DataFrame, heavy: int = HEAVY, tracked: int = TRACKED) -> DataFrame:
    """At most `heavy` digests: all that the summary of the column names with two rows or more, most frequent first."""
    summary = rows.agg(F.expr(f"approx_top_k(hex(digest), {heavy}, {tracked})").alias("top"))
    return summary.select(F.explode("top").alias("t")).where("t.count > 1").select(F.unhex("t.item").alias("digest"))


def _best() -> Column:
    """Orders the rows of a group: most characters, smallest id (null last), first row."""
    return F.struct((-F.col("chars")).alias("c"), F.col("id").isNull().alias("n"), F.col("id").alias("i"), F.col("row").alias("r"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", heavy: int = HEAVY) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, digest (binary SHA-256 of the normalised text)."""
    rows = digests(docs, id_col, text_col)
    named = heavy_digests(rows, heavy)
    # exact counts and winners of the named digests: at most `heavy` rows, one partial row per task and digest
    winners = stored(
        rows.join(F.broadcast(named), "digest", "left_semi").groupBy("digest")
        .agg(F.count(F.lit(1)).alias("size"), F.min(_best()).alias("best")),
        "heavy-winners",
    )
    tagged = rows.join(F.broadcast(winners), "digest", "left")
    out = ["id", F.col("best.i").alias("keep_id"), F.col("size").alias("group_size"), (F.col("row") == F.col("best.r")).alias("kept"), "digest"]
    common = tagged.where("size is not null").select(*out)
    group = Window.partitionBy("digest")
    rare = tagged.where("size is null").drop("size", "best")
    rare = rare.withColumn("best", F.min(_best()).over(group)).withColumn("size", F.count(F.lit(1)).over(group)).select(*out)
    return common.unionByName(rare)


def keep_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", heavy: int = HEAVY) -> DataFrame:
    """The documents that stay, with all their columns; of rows that repeat an id and a text one stays."""
    groups = exact_groups(docs, id_col, text_col, heavy)
    kept = groups.where("kept").select(row_key(F.col("id"), F.col("digest")).alias("row_key_"))
    digest = F.unhex(F.sha2(normalised(F.col(f"`{text_col}`")).cast("binary"), 256))
    return keep_rows(docs, kept, F.col(f"`{id_col}`"), digest)
