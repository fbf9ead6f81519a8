"""Repeated lines across documents, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pelagia.llm.common import text_of

#: White space that is stripped at both ends of a line.
SPACE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: A character outside ASCII that is no lower-case letter: full lower-casing might change it.
NOT_PLAIN = r"[[^\x00-\x7F]&&[^\p{Ll}]]"


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _key(line: Column) -> Column:
    """The line stripped, with A-Z lower-cased.

    lower() is several times as fast as translate() but lowers É too, so lines with such
    characters take translate().
    """
    bare = F.trim(line, F.lit(SPACE))
    return F.when(bare.rlike(NOT_PLAIN), F.translate(bare, UPPER, UPPER.lower())).otherwise(F.lower(bare))


def drop_repeated_lines(docs: DataFrame, min_chars: int = 10, min_docs: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_lines, n_dropped, kept_text.

    A line's key is the line stripped of white space with A-Z lower-cased.  Keys of at
    least `min_chars` code points that at least `min_docs` documents hold lose all their
    lines except in the document with the smallest id; the other lines stay, in their
    order, joined by a line feed.  Documents per key are counted by a 128-bit hash of the
    key: first distinct (hash, document), then per hash, both combined on the map side,
    so a line that every document holds is no hot key.  Texts are shuffled once, to meet
    the positions that they lose.

    Edge cases: a null or empty text is one empty line; rows that share an id are one
    document; a missing id is a document of its own that never comes first; repeated rows
    lose the same lines; an empty table gives no rows; other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    rows = rows.withColumn("row_key", F.md5("text"))
    keyed = rows.select("doc_id", "row_key", F.posexplode(_lines(F.col("text"))).alias("pos", "line")).select(
        "doc_id", "row_key", "pos", _key(F.col("line")).alias("key")
    )
    lines = keyed.where(F.length("key") >= min_chars).select("doc_id", "row_key", "pos", F.unhex(F.md5("key")).alias("h"))
    repeated = (
        lines.groupBy("h", "doc_id").agg(F.lit(1).alias("one")).groupBy("h").agg(F.count(F.lit(1)).alias("docs"), F.min("doc_id").alias("first_id")).where(F.col("docs") >= min_docs)
    )
    dropped = (
        lines.join(repeated, "h")
        .where(~F.col("doc_id").eqNullSafe(F.col("first_id")))
        .groupBy("doc_id", "row_key")
        .agg(F.collect_set("pos").alias("gone"))
        .select(F.col("doc_id").alias("d"), F.col("row_key").alias("k"), "gone")
    )
    both = rows.join(dropped, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("row_key") == F.col("k")), "left")
    gone = F.coalesce("gone", F.array().cast("array<int>"))

    def without(lines):
        """The lines at the places that stay, found as a set difference by hash: linear in the lines, however many are dropped."""
        stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
        return F.array_join(F.transform(stay, lambda pos: F.get(lines, pos)), "\n")

    # A lambda's argument is split once; a column inside the lambda would be split for each line.
    kept = F.transform(F.array(_lines(F.col("text"))), without)[0]
    return both.select(
        "doc_id",
        F.size(_lines(F.col("text"))).cast("long").alias("n_lines"),
        F.size(gone).cast("long").alias("n_dropped"),
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept).alias("kept_text"),
    )
