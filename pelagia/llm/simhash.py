"""Near duplicates by fingerprints: an inverted index of byte positions with count filtering."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pelagia.llm.common import components, slices, text_of, written

#: Bytes of a 64-bit fingerprint.
BYTES = 8
#: Fingerprints of a posting that meet all others in one task; larger postings are dealt to several.
BLOCK = 512


def shingle_hashes(text: str, words: int) -> np.ndarray:
    """XXH64 (seed 42) of each run of `words` words, repeats included; words are lower-cased in A-Z."""
    import xxhash

    found = text.encode().lower().split()  # both are ASCII-only on bytes
    if not found:
        return np.zeros(0, np.uint64)
    if len(found) <= words:
        return np.array([xxhash.xxh64_intdigest(b" ".join(found), 42)], np.uint64)
    joined, digest = b" ".join(found), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1)
    starts = np.concatenate(([0], ends[:-1]))[: len(found) - words + 1]
    stops = ends[words - 1 :] - 1
    return np.array([digest(joined[a:b], 42) for a, b in zip(starts.tolist(), stops.tolist())], np.uint64)


def simhash(hashes: np.ndarray) -> int:
    """A bit is 1 if it is set in over half of the hashes; zero for none.  As a signed 64-bit number."""
    n = len(hashes)
    if not n:
        return 0
    ones = np.zeros(64, np.int64)
    big = hashes.astype(">u8").view(np.uint8).reshape(-1, BYTES)
    for a in range(0, n, 100_000):
        ones += np.unpackbits(big[a : a + 100_000], axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp long) of every row.

    Edge cases: a text without words (null, empty, white space) has fingerprint zero; one
    with fewer words than a shingle is one shingle; a missing id stays missing and
    repeated rows get equal results; an empty table gives no rows; other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))

    def run(batches):
        for batch in slices(batches):
            fps = [simhash(shingle_hashes(t, words)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())], names=["doc_id", "fp"])

    return rows.mapInArrow(run, "doc_id long, fp long")


def posting_positions(max_bits: int) -> list[list[int]]:
    """The byte positions of each posting: the eight positions dealt into max_bits + 2 groups, a posting for any two groups.

    Positions that differ spoil at most `max_bits` groups, so two groups stay whole and a
    linked pair meets in their posting.
    """
    groups = [list(range(BYTES))[k :: max_bits + 2] for k in range(max_bits + 2)]
    return [sorted(a + b) for a, b in combinations(groups, 2)]


def _only(positions: list[int]) -> int:
    """The mask of some byte positions, as a signed number."""
    bits = sum(255 << (8 * i) for i in positions)
    return bits - 2**64 if bits >= 2**63 else bits


def met(fps: DataFrame, max_bits: int = 2) -> DataFrame:
    """(a, b, tally) of the pairs of distinct fingerprints that meet in a posting, a < b, each once, with the number of byte positions they share."""
    postings = posting_positions(max_bits)
    keys = ["posting", "bytes"]
    one = fps.select("fp").distinct()
    index = one.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(_only(p))) for p in postings])).alias(*keys))
    sizes = index.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    index = index.join(sizes, keys).select("fp", *keys, blocks.alias("blocks"))
    left = index.select(F.col("fp").alias("a"), *keys, F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int").alias("block"))
    right = index.select(F.col("fp").alias("b"), *keys, F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    differ = F.col("a").bitwiseXOR(F.col("b"))
    same = [differ.bitwiseAND(F.lit(_only([i]))) == 0 for i in range(BYTES)]
    tally = sum((s.cast("int") for s in same[1:]), same[0].cast("int"))
    first = F.lit(-1)
    for k in reversed(range(len(postings))):
        first = F.when(differ.bitwiseAND(F.lit(_only(postings[k]))) == 0, F.lit(k)).otherwise(first)
    pairs = left.join(right, [*keys, "block"]).where("a < b")
    return pairs.where(F.col("posting") == first).select("a", "b", tally.alias("tally"))


def links(fps: DataFrame, max_bits: int = 2) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints, a < b, that differ in at most `max_bits` bits: all of them.

    Bits that differ spoil at most `max_bits` of the eight byte positions, so a linked pair
    shares at least 8 - max_bits positional bytes: the guaranteed minimum.  A posting of the
    inverted index holds the fingerprints with the same bytes at some four positions (for
    two bits), which every linked pair does somewhere.  The shared bytes of each pair that
    meets are tallied, pairs below the minimum go, and the rest are verified bit by bit.  A
    pair that meets in several postings is taken from the first.  Postings hold distinct
    fingerprints only, so copies don't make them grow; those with one member are dropped
    before the join, and large ones are dealt to several tasks.

    Edge cases: repeated fingerprints count once; a single one, or none, gives no pairs.
    """
    if not 0 <= max_bits <= BYTES - 2:
        raise ValueError("max_bits must leave two shared byte positions or more")
    pairs = met(fps, max_bits).where(F.col("tally") >= BYTES - max_bits)
    return pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits).select("a", "b")


def simhash_components(docs: DataFrame, words: int = 3, max_bits: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id.

    Fingerprints link at `max_bits` or fewer differing bits; a component's id is the
    smallest doc_id that can be reached.  Linking runs over distinct fingerprints, so any
    number of copies counts as one.

    Edge cases: a text without words (null, empty, white space) has fingerprint zero and
    links like any other; one with fewer words than a shingle is one shingle; a missing id
    never names a component unless it has no other (then null); repeated rows get the same
    answer; an empty table gives no rows; other columns are not read.
    """
    rows = written(fingerprints(docs, words, id_col, text_col), "fingerprints")
    pairs = components(links(rows, max_bits))
    smallest = rows.groupBy("fp").agg(F.min("doc_id").alias("low"))
    rooted = smallest.join(pairs, F.col("fp") == F.col("node"), "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    per_root = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    by_fp = rooted.join(per_root, "root").select("fp", "component_id")
    return rows.join(by_fp, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
