"""Exact duplicates: groups by a 128-bit content hash, with the bytes compared inside each group."""

from __future__ import annotations

import string
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pelagia.llm.common import LOWEST, text_of, written


def _lowered(text: Column) -> Column:
    """A text with A-Z lower-cased, all else as it is; `lower` changes nothing else in a text of ASCII alone."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def _content(norm: Column, content_hash: Callable[[bytes], bytes] | None) -> Column:
    """16 bytes of MD5 by Spark, or another hash of the bytes by Arrow batches."""
    if content_hash is None:
        return F.unhex(F.md5(norm))

    @F.arrow_udf("binary")
    def other(text: pa.Array) -> pa.Array:
        return pa.array([content_hash(t.encode()) for t in text.to_pylist()], pa.binary())

    return other(norm)


def _id(name: str) -> Column:
    return F.coalesce(F.col(name).cast("long"), F.lit(LOWEST))


def _texts(docs: DataFrame, keep: str, content_hash, id_col: str, text_col: str) -> DataFrame:
    """One row per (hash, text): the id that stays and the number of rows."""
    signed = docs.select(_id(id_col).alias("id"), _lowered(text_of(text_col)).alias("norm")).select("id", _content(F.col("norm"), content_hash).alias("h"), "norm")
    best = F.max if keep == "max" else F.min
    return signed.groupBy("h", "norm").agg(best("id").alias("k"), F.count(F.lit(1)).alias("size"))


def _groups(docs: DataFrame, keep: str, content_hash, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame | None]:
    """(h, k, size of hashes with one text; h, sha, k, size of the texts of collided hashes, or None without collisions).

    The texts stay behind here: what follows joins by hash.  A hash that holds more than
    one text is a collision, and only then its texts are looked at again.
    """
    args = (docs, keep, content_hash, id_col, text_col)
    per_hash = written(
        _texts(*args).groupBy("h").agg(F.count(F.lit(1)).alias("texts"), F.first("k").alias("k"), F.first("size").alias("size")), "hashes"
    )
    clash = per_hash.where("texts > 1").select("h")
    single = per_hash.where("texts = 1").select("h", "k", "size")
    if clash.isEmpty():
        return single, None
    return single, _texts(*args).join(clash, "h", "left_semi").select("h", F.sha2("norm", 256).alias("sha"), "k", "size")


def duplicate_groups(
    docs: DataFrame, keep: str = "min", content_hash: Callable[[bytes], bytes] | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z only.  Of equal texts the row
    with the smallest (keep="min") or largest (keep="max") id stays.  Grouping is by
    `content_hash` (MD5, 16 bytes; by Spark, so that no Python worker holds texts) and, inside a hash, by the bytes themselves, so texts whose
    hashes collide are never joined.  The grouping combines on the map side: a text with
    very many copies reaches the shuffle as one row per task.

    Edge cases: a null text equals the empty text; a missing id counts as smaller than all
    others; of repeated rows (same id, same text) one is kept; an empty table gives no
    rows; other columns are not read.
    """
    single, collided = _groups(docs, keep, content_hash, id_col, text_col)
    signed = docs.select(_id(id_col).alias("id"), _lowered(text_of(text_col)).alias("norm"))
    signed = signed.select("id", _content(F.col("norm"), content_hash).alias("h"), F.sha2("norm", 256).alias("sha"))
    rows = signed.groupBy("id", "h", "sha").agg(F.count(F.lit(1)).alias("n"))
    names = ["id", "sha", "n", "k", "size"]
    found = rows.join(single, "h").select(names)
    if collided is not None:
        found = found.unionByName(rows.join(collided, ["h", "sha"]).select(names))
    each = found.select("*", F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("copy"))
    return each.select(
        F.when(F.col("id") != LOWEST, F.col("id")).alias("doc_id"),
        F.when(F.col("k") != LOWEST, F.col("k")).alias("keep_id"),
        F.col("size").alias("group_size"),
        ((F.col("id") == F.col("k")) & (F.col("copy") == 1)).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def keep_one(
    docs: DataFrame, keep: str = "min", content_hash: Callable[[bytes], bytes] | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of `docs` that stay, with all their columns: one row per group of equal texts.

    The same grouping and edge cases as `duplicate_groups`; of repeated rows one stays.
    """
    single, collided = _groups(docs, keep, content_hash, id_col, text_col)
    winners = single.select(F.col("k").alias("id"), "h", F.lit(None).cast("string").alias("w_sha"))
    if collided is not None:
        winners = winners.union(collided.select(F.col("k").alias("id"), "h", F.col("sha").alias("w_sha")))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    signed = docs.select(row, _id(id_col).alias("id"), _lowered(text_of(text_col)).alias("norm"))
    signed = signed.select("row", "id", _content(F.col("norm"), content_hash).alias("h"), F.sha2("norm", 256).alias("sha")).alias("d")
    winners = winners.alias("w")
    same = (F.col("d.id") == F.col("w.id")) & (F.col("d.h") == F.col("w.h")) & (F.col("w_sha").isNull() | (F.col("w_sha") == F.col("sha")))
    w = Window.partitionBy("id", "h").orderBy("sha")
    ranked = signed.join(winners, same, "left_semi").withColumn("r", F.row_number().over(w)).withColumn("before", F.lag("sha").over(w))
    return ranked.where((F.col("r") == 1) | (F.col("before") != F.col("sha"))).select("row.*")
