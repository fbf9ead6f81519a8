"""What the training-data operators share: scratch tables, null rules, connected components."""

from __future__ import annotations

import contextlib
import ctypes

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pelagia.sources.scratch import delete_path, save, scratch_path

#: Sorts before every real id; stands for a missing id where an order is needed.
LOWEST = -(2**63)
#: Nodes whose smallest neighbours are broadcast, 16 bytes each; beyond that many they are joined by shuffles.
BROADCAST_NODES = 200_000


def text_of(name: str = "text") -> Column:
    """The text column, a missing text read as the empty one."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def trim() -> None:
    """Gives freed memory back to the system; Spark keeps Python workers, which else hold it while idle."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # a C library without it
        ctypes.CDLL(None).malloc_trim(0)


def slices(batches, rows: int = 512):
    """Arrow batches cut into pieces of at most `rows` rows, which bounds what a task holds as Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def text_chunks(batches, *keys: str, size: int, column: str = "text"):
    """(values of each key..., texts in UTF-8) of consecutive rows that have about `size` bytes of text, one row at least."""
    for batch in batches:
        texts = batch.column(column).cast(pa.binary())
        columns = [batch.column(k) for k in keys]
        ends = np.cumsum(pa.compute.binary_length(texts).to_numpy(zero_copy_only=False))
        at = 0
        while at < len(ends):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, "right")))
            yield *[c.slice(at, to - at).to_pylist() for c in columns], texts.slice(at, to - at).to_pylist()
            at = to


def written(df: DataFrame, name: str, used: list[str] | None = None) -> DataFrame:
    """The rows written to the shared folder and read again: cuts lineage and survives lost executors.

    The folder's path is added to `used`, for the caller to delete when nothing reads it any more.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    save(df, path)
    if used is not None:
        used.append(path)
    return spark.read.schema(df.schema).parquet(path)


def components(edges: DataFrame, src: str = "a", dst: str = "b", used: list[str] | None = None) -> DataFrame:
    """Connected components of an edge list: (node, root), root the smallest node of the component.

    Alternates large-star and small-star rounds until the edges are stars around their
    smallest nodes, each round two groupings that combine on the map side and two joins over
    the edges only; isolated nodes have no row.  Each round begins with every node's smallest
    neighbour, which tells whether all are stars, so no round is run to see that nothing
    changes.  These are broadcast up to BROADCAST_NODES, else joined by shuffles.  Rounds grow
    with the logarithm of the longest chain, and each round's edges are written to the shared
    folder.  The folder that holds the result is added to `used`.
    """
    spark = edges.sparkSession
    ends = edges.select(F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v"))
    current = written(ends.where("u > v").distinct(), "edges", old := [])
    while True:
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count(F.lit(1)).alias("n"))
        low = written(low, "roots", kept := [])
        # In a star, what has a smaller neighbour has no other.
        nodes, astray = low.agg(F.count(F.lit(1)), F.count_if(F.expr("m < u and n > 1"))).first()
        if not astray:
            break
        met = F.broadcast if nodes <= BROADCAST_NODES else lambda df: df
        large = current.join(met(low.select(F.col("u").alias("v"), "m")), "v").select("u", F.col("m").alias("v"))
        joined = large.join(met(large.groupBy("u").agg(F.min("v").alias("m"))), "u")
        each = joined.select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e"))
        current = written(each.select("e.u", F.col("e.m").alias("v")).where("u > v").distinct(), "edges", new := [])
        for path in old + kept:
            delete_path(spark, path)
        old = new
    for path in old:
        delete_path(spark, path)
    if used is not None:
        used += kept
    return low.select(F.col("u").alias("node"), F.col("m").alias("root"))


def forest_roots(parents: DataFrame, node: str, parent: str) -> DataFrame:
    """(node, root) of every node that has a parent, in a forest (each node has one parent at most, no cycles).

    Pointers are doubled: each round a node takes over what its present root points to, so
    rounds grow with the logarithm of the depth.  A node that has reached its root leaves
    the rounds, so short trees aren't moved along with deep ones.
    """
    spark = parents.sparkSession
    active, reached = parents.select(F.col(node).alias("node"), F.col(parent).alias("root"), F.lit(False).alias("done")), None
    while True:
        known = active if reached is None else reached.union(active)
        up = known.select(F.col("node").alias("root"), F.col("root").alias("above"), F.col("done").alias("above_done"))
        step = active.join(up, "root", "left").select("node", F.coalesce("above", "root").alias("root"), F.coalesce("above_done", F.lit(True)).alias("done"))
        after = written(step, "roots")
        done, active = after.where("done"), after.where("not done")
        reached = done if reached is None else reached.union(done)
        if active.isEmpty():
            return reached.select("node", "root")


#: Bits of the filter that tasks hold, at least and at most: 16 per hash or more between these bounds.
FILTER_BITS, MOST_FILTER_BITS = 1 << 16, 1 << 24
#: Words whose hashes a worker keeps; beyond that many it starts anew.
CACHE_WORDS = 150_000


def mix64(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hasher:
    """64-bit hashes of words, remembered."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        from xxhash import xxh64_intdigest

        known = self.known
        if len(known) > CACHE_WORDS:
            known.clear()
        got = list(map(known.get, words))
        if None in got:
            for w in [w for w, g in zip(words, got) if g is None]:
                known[w] = xxh64_intdigest(w)
            got = list(map(known.__getitem__, words))
        return np.array(got, np.uint64)


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """The first n powers of a base modulo 2^64, kept for the next call."""
    if len(_POWERS.get(base, ())) < n:
        out = np.full(n, base, np.uint64)
        out[:1] = 1
        _POWERS[base] = np.cumprod(out, dtype=np.uint64)
    return _POWERS[base][:n]


#: Odd bases of polynomial hashes modulo 2^64: fixed values without meaning.
BASES = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F


def span_hashes(x: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = BASES[0]) -> np.ndarray:
    """64-bit hashes of the spans of an array, by running sums: in time that does not depend on their lengths."""
    sums = np.zeros(len(x) + 1, np.uint64)
    np.cumsum(x * powers(base, len(x)), dtype=np.uint64, out=sums[1:])
    back = powers(pow(base, -1, 1 << 64), len(x) + 1)[starts]
    return mix64((sums[ends] - sums[starts]) * back + (ends - starts).astype(np.uint64))


def word_spans(data: np.ndarray, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the runs of bytes that `letters` (256 flags) has."""
    edge = np.diff(letters[data].astype(np.int8), prepend=0, append=0)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


class Filter:
    """A Bloom filter with two bits per hash; its size is a power of two."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.mask = np.uint64(64 * len(words) - 1)

    def holds(self, h: np.ndarray) -> np.ndarray:
        a, b, one = h & self.mask, (h >> np.uint64(32)) & self.mask, np.uint64(1)
        hit = (self.words[(a >> np.uint64(6)).astype(np.int64)] >> (a & np.uint64(63))) & one
        return (hit & (self.words[(b >> np.uint64(6)).astype(np.int64)] >> (b & np.uint64(63)))) == one


def filter_of(df: DataFrame, column: str, most: int = MOST_FILTER_BITS) -> Filter:
    """The filter of all 64-bit hashes in a column, sized by their number up to `most` bits.

    Bits are combined by Spark; at most `most` / 64 numbers reach the driver.  A
    filter of that size that is overfull lets more pass, and never drops a hash it was given.
    """
    bits = min(most, max(FILTER_BITS, 1 << (16 * df.count()).bit_length()))
    h = F.col(column)
    bit = F.explode(F.array(h.bitwiseAND(F.lit(bits - 1)), F.shiftrightunsigned(h, 32).bitwiseAND(F.lit(bits - 1))))
    rows = (
        df.select(bit.alias("bit"))
        .groupBy(F.shiftright("bit", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits"))
        .toArrow()
    )
    words = np.zeros(bits // 64, np.int64)
    words[rows["word"].to_numpy()] = rows["bits"].to_numpy()
    return Filter(words.view(np.uint64))
