"""Near copies by fingerprints, then by word shingles: inverted indexes of positions with count filtering.

First the fingerprints of `simhash` are linked by their byte positions, and texts whose
fingerprints link are verified on their shingles (`fingerprint_pairs`).  That index
guarantees shared byte positions only below a few differing bits; texts at a Jaccard
similarity of 0.8 differ in about ten of 64, which may spoil all eight positions, so no
minimum holds for them.  For these the positions are the first places of each text's
shingles in one order of all shingles, as many as guarantee that a linked pair shares
some; index, tally of what a pair shares, guaranteed minimum and verification stay, and no
link is lost.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pelagia.llm import simhash
from pelagia.llm.common import Hasher, components, filter_of, mix64, slices, text_of, trim, written
from pelagia.sources.scratch import delete_path

#: Counters of the table that puts frequent shingles last; a fixed size, whatever the corpus.
COUNTERS = 1 << 16
#: Members of a posting that meet in one task; larger postings are dealt to several.
BLOCK = 256
#: Members of a posting's largest group that each text apart from it meets in a round.
REPRESENTATIVES = 8
#: Rounds end when the links of one are no more than this share of the texts in groups.
SETTLED = 0.05
#: Words of 64 bits in a set's parities; the more, the fewer pairs of large sets are verified in vain.
PARITIES = 16
_ODD = mix64(np.arange(1, 65, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def shingles(text: str, words: int, hasher: Hasher) -> np.ndarray:
    """64-bit hashes of the runs of `words` words, repeats included; words are lower-cased in A-Z, a shorter text is one run."""
    found = text.encode().lower().split()  # both are ASCII-only on bytes
    if not found:
        return np.zeros(0, np.uint64)
    h, size = hasher(found), min(words, len(found))
    out = np.full(len(h) - size + 1, size, np.uint64)
    for k in range(size):
        out += h[k : k + len(out)] * _ODD[k % len(_ODD)]
    return mix64(out)


def indexed(n: int, similarity: float) -> int:
    """How many of n ordered shingles are indexed: so many that those left out alone never reach the overlap with a linked text."""
    return n - int(np.ceil(similarity * n - 1e-9)) + 1


def needed_overlap(n: Column, m: Column, similarity: float) -> Column:
    """Shingles that sets of n and m at the similarity have in common at least."""
    return F.ceil((n + m) * F.lit(similarity / (1 + similarity)) - F.lit(1e-6))


def parities(h: np.ndarray) -> np.ndarray:
    """PARITIES words of bits, each the parity of how many of a set's hashes fall into its class; two sets differ in no fewer members than bits."""
    odd = np.bincount((h % np.uint64(64 * PARITIES - 1)).astype(np.int64), minlength=64 * PARITIES) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def differing(a: str, b: str) -> Column:
    """How many bits of two columns of parities differ."""
    bits = F.lit(0)
    for k in range(PARITIES):
        bits += F.bit_count(F.get(a, F.lit(k)).bitwiseXOR(F.get(b, F.lit(k))))
    return bits


@F.arrow_udf(T.DoubleType())
def _jaccard(a: pa.Array, b: pa.Array) -> pa.Array:
    out = []
    for x, y in zip(a, b):
        x, y = x.values.to_numpy(), y.values.to_numpy()
        both = len(np.intersect1d(x, y, assume_unique=True))
        out.append(both / (len(x) + len(y) - both))
    return pa.array(out, pa.float64())


def _frequency(rows: DataFrame, words: int) -> np.ndarray:
    """How often the shingles of each of COUNTERS classes occur in all texts."""

    def run(batches):
        counts, hasher = np.zeros(COUNTERS, np.int64), Hasher()
        for batch in slices(batches):
            for t in batch.column(0).to_pylist():
                counts += np.bincount((shingles(t, words, hasher) & np.uint64(COUNTERS - 1)).astype(np.int64), minlength=COUNTERS)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(counts[at], pa.int64())], names=["class", "n"])
        hasher.known.clear()
        trim()

    out = np.zeros(COUNTERS, np.int64)
    for r in rows.select("text").mapInArrow(run, "class long, n long").groupBy("class").agg(F.sum("n").alias("n")).collect():  # at most COUNTERS rows
        out[r["class"]] = r["n"]
    return out


def fingerprint_pairs(rows: DataFrame, max_bits: int = 2, used: list[str] | None = None) -> DataFrame:
    """Pairs (a, b) of ids of `rows` (id, text) whose SimHash fingerprints differ in `max_bits` bits at most, by one id of each fingerprint.

    Fingerprints link by `simhash.links`: postings of byte positions, tally of shared bytes,
    guaranteed minimum, verification bit by bit.  Of the ids with one fingerprint each is
    paired with the smallest, and the smallest ids of linked fingerprints with each other,
    so copies are never expanded into pairs.
    """
    prints = written(simhash.fingerprints(rows.where(F.col("text").rlike(r"[^ \t-\r]")), 3, "id", "text"), "fingerprints", used)
    low = prints.groupBy("fp").agg(F.min("doc_id").alias("low"))
    same = prints.join(low, "fp").where("doc_id > low").select(F.col("low").alias("a"), F.col("doc_id").alias("b"))
    left, right = low.select(F.col("fp").alias("a"), F.col("low").alias("low_a")), low.select(F.col("fp").alias("b"), F.col("low").alias("low_b"))
    other = simhash.links(prints, max_bits).join(left, "a").join(right, "b").select(F.col("low_a").alias("a"), F.col("low_b").alias("b"))
    return same.union(other)


def near_groups(docs: DataFrame, words: int = 5, similarity: float = 0.8, rounds: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, root) of the documents that belong to a group of near copies; root is the group's smallest id.

    Two documents link if the Jaccard similarity of their sets of `words`-word shingles is
    `similarity` or more; groups are the connected components.

    Texts whose fingerprints link (`fingerprint_pairs`) are verified on their sets first and
    join groups, whose members no longer meet; the rest are texts that fingerprints can't
    link for certain.  For these all shingles have one order: by how often their class occurs, then by hash.  A text is
    indexed by its first shingles in that order, as many as are needed for every linked
    pair to share one (`indexed`), so a passage that many texts hold stands last and makes
    no posting.  A pair that meets in a posting is kept if lengths and places allow the
    similarity (`possible`) and if the tally of indexed shingles that it shares reaches its
    minimum, and if the parities of the two sets (`parities`) differ in no more bits than
    linked sets may in shingles; what is kept is verified on the whole sets.

    Within a posting all members are first compared with one of them, chosen anew in each
    of `rounds` rounds, which joins a large group in time linear in its size.  Then those
    apart from the posting's largest group meet REPRESENTATIVES of its members, others in
    each round, until a round finds few links (SETTLED).  Last, what is apart still is
    compared with all those it isn't joined with, so that no link is lost.  Each link found
    joins two groups, so the rounds end.  Large groups are never expanded into pairs; a
    posting of many texts that share rare shingles but are no near copies still costs the
    pairs of those texts.

    Edge cases: texts without words (null, empty, white space) link to nothing; a text
    shorter than a shingle is one shingle; rows with a missing id are not compared; rows
    that share an id are one document, which links by any of its texts; an empty table
    gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    used: list[str] = []
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text")).where("id is not null")
    order = spark.sparkContext.broadcast(_frequency(rows, words))

    def first(batches):
        hasher = Hasher()
        for batch in slices(batches):
            ids, sizes, heads = [], [], []
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                h = np.unique(shingles(t, words, hasher))
                if len(h):
                    often = order.value[(h & np.uint64(COUNTERS - 1)).astype(np.int64)]
                    ids.append(i)
                    sizes.append(len(h))
                    heads.append(h[np.argsort(often, kind="stable")[: indexed(len(h), similarity)]].view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(heads, pa.list_(pa.int64()))], names=["id", "n", "heads"])
        hasher.known.clear()
        trim()

    heads = written(rows.mapInArrow(first, "id long, n long, heads array<long>"), "heads", used)
    shared = written(heads.select(F.explode("heads").alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("members")).where("members > 1"), "shared", used)
    met = spark.sparkContext.broadcast(filter_of(shared, "h"))

    def entries(batches):
        for batch in batches:
            lists, ids, sizes = batch.column(2), batch.column(0).to_numpy(), batch.column(1).to_numpy()
            count = np.diff(lists.offsets.to_numpy())
            h = lists.flatten().to_numpy()
            place = np.arange(len(h)) - np.repeat(np.cumsum(count) - count, count)
            keep = met.value.holds(h.view(np.uint64))
            columns = np.repeat(ids, count)[keep], np.repeat(sizes, count)[keep], place[keep], h[keep]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["id", "n", "place", "h"])

    # The filter lets a few entries pass that no other text has; the join drops them.
    found = written(heads.mapInArrow(entries, "id long, n long, place long, h long").join(shared.select("h"), "h"), "entries", used)
    # Texts that link have lengths of one class or of neighbours; those without such a partner in any posting are done with.
    length = F.floor(F.log("n") / F.lit(-np.log(similarity) * (1 + 1e-6) + 1e-12))
    keyed = found.select("id", "n", F.explode(F.array(F.xxhash64("h", length), F.xxhash64("h", length + 1))).alias("key"))
    many = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1").select("key")
    near = written(keyed.join(many, "key", "left_semi").select("id", "n").distinct(), "near", used)
    mine = found.join(near, ["id", "n"], "left_semi")
    sizes = mine.groupBy("h").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    postings = mine.join(sizes, "h").select("id", "n", "place", "h", blocks.alias("blocks"), F.pmod(F.xxhash64("id"), blocks).cast("int").alias("block"))
    postings = written(postings, "postings", held := [])
    allowed = spark.sparkContext.broadcast(filter_of(near.select(F.xxhash64("id").alias("h")), "h"))
    for path in used:
        delete_path(spark, path)
    used = held

    def sets(batches):
        hasher = Hasher()
        for batch in slices(batches):
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            keep = allowed.value.holds(np.array(batch.column(2).to_numpy(), np.int64).view(np.uint64)) if len(ids) else []
            out = [(i, np.unique(h)) for i, t, k in zip(ids, texts, keep) if k and len(h := shingles(t, words, hasher))]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([i for i, _ in out], pa.int64()),
                    pa.array([len(h) for _, h in out], pa.int64()),
                    pa.array([parities(h) for _, h in out], pa.list_(pa.int64())),
                    pa.array([h.view(np.int64) for _, h in out], pa.list_(pa.int64())),
                ],
                names=["id", "n", "bits", "shingles"],
            )
        hasher.known.clear()
        trim()

    whole = written(rows.select("id", "text", F.xxhash64("id").alias("x")).mapInArrow(sets, "id long, n long, bits array<long>, shingles array<long>"), "shingles", used)
    index = postings.groupBy("id", "n").agg(F.collect_set("h").alias("heads")).join(whole.select("id", "n", "bits"), ["id", "n"])
    index = written(index, "index", used)
    whole = whole.select("id", "shingles")

    def possible(n: str, m: str, place: str, there: str) -> Column:
        """Whether texts of n and m shingles can link if this is the first entry that they share: enough of both must follow."""
        least = needed_overlap(F.col(n), F.col(m), similarity)
        return (F.least(n, m) >= F.greatest(n, m) * F.lit(similarity) - F.lit(1e-6)) & (F.col(place) + least <= F.col(n)) & (F.col(there) + least <= F.col(m))

    def verified(pairs: DataFrame) -> DataFrame:
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()
        by = lambda t, c: t.select(*[F.col(x).alias(c if x == "id" else f"{x}_{c}") for x in t.columns])
        left_out = lambda c: F.ceil(F.col(f"n_{c}") * F.lit(similarity) - F.lit(1e-6)) - 1
        minimum = needed_overlap(F.col("n_a"), F.col("n_b"), similarity) - F.greatest(left_out("a"), left_out("b"))
        tally = F.size(F.array_intersect("heads_a", "heads_b"))
        # Sets at the similarity differ in no more shingles than this, so what differs in more parities is no link.
        apart = F.col("n_a") + F.col("n_b") - 2 * needed_overlap(F.col("n_a"), F.col("n_b"), similarity)
        near = pairs.join(by(index, "a"), "a").join(by(index, "b"), "b")
        near = near.where((differing("bits_a", "bits_b") <= apart) & (tally >= minimum)).select("a", "b").distinct()
        both = near.join(by(whole, "a"), "a").join(by(whole, "b"), "b")
        return both.where(_jaccard("shingles_a", "shingles_b") >= similarity).select("a", "b")

    def dealt(ones: DataFrame) -> DataFrame:
        """Once for each block of the posting, to meet its members there."""
        return ones.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")

    def met_by(texts: DataFrame, ones: DataFrame) -> DataFrame:
        can = possible("n", "m", "place", "there")
        return texts.join(dealt(ones), ["h", "block"]).where((F.col("root") != F.col("other")) & can).select(F.col("id").alias("a"), "b")

    other = [F.col("id").alias("b"), F.col("n").alias("m"), F.col("place").alias("there"), F.col("root").alias("other"), F.col("blocks")]
    links = written(verified(fingerprint_pairs(rows, used=used)), "links", used)
    groups = components(links, used=(kept := []))
    used += kept
    k, settled = 0, False
    while True:
        members = postings.join(groups.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
        if k < rounds:
            # One for all postings at first, so that few pairs are verified; then one for each, so that a text meets many of its group.
            by = F.xxhash64("id") if not k else F.xxhash64("id", "h", F.lit(k))
            pairs = met_by(members, members.groupBy("h").agg(F.min_by(F.struct(*other), by).alias("f")).select("h", "f.*"))
        else:
            sizes = members.groupBy("h", "root").agg(F.count(F.lit(1)).alias("size"))
            main = sizes.groupBy("h").agg(F.max_by("root", F.struct("size", "root")).alias("main"), F.count(F.lit(1)).alias("groups")).where("groups > 1").select("h", "main")
            parts = members.join(main, "h")
            apart = parts.where("root <> main").drop("main")
            if settled:
                pairs = met_by(members, apart.select("h", *other))
            else:
                by = F.xxhash64("id", "h", F.lit(k))
                some = parts.where("root = main").groupBy("h", F.pmod(by, F.lit(REPRESENTATIVES)).alias("part")).agg(F.min_by(F.struct(*other), by).alias("f"))
                pairs = met_by(apart, some.select("h", "f.*"))
        links = written(verified(pairs), "links", used)
        joined = links.count()
        if joined:  # what is joined already goes on as a star around its root
            groups = components(links.union(groups.select("node", "root")), used=(kept := []))
            used += kept
        if settled:
            break
        settled = k >= rounds and joined <= SETTLED * groups.count()
        k += 1
    for path in set(used) - set(kept):
        delete_path(spark, path)
    return groups.select(F.col("node").alias("doc_id"), "root")


def keep_one(docs: DataFrame, words: int = 5, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that stay, with all their columns: of each group of near copies the document with the smallest id.

    Edge cases: those of `near_groups`; rows with a missing id and texts without words all
    stay, and so do repeated rows of an id that stays.
    """
    gone = near_groups(docs, words, similarity, id_col=id_col, text_col=text_col).where("doc_id <> root").select(F.col("doc_id").alias("__gone"))
    return docs.join(gone, F.col(id_col).cast("long") == F.col("__gone"), "left_anti")
