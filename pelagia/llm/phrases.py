"""Phrase collocations: shards mined at a proportional support, what is frequent in any counted exactly in all."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pelagia.llm.common import BASES, filter_of, mix64, span_hashes, text_chunks, text_of, trim, word_spans, written
from pelagia.sources.scratch import delete_path

#: What ends a piece becomes a full stop, which no word holds afterwards; A-Z is lower-cased.
_ENDS = b".,;:!?\n\x0b\x0c\r"
_PLAIN = bytes.maketrans(_ENDS + bytes(range(65, 91)), b"." * len(_ENDS) + bytes(range(97, 123)))
_LETTERS = np.array([b not in b". \t" for b in range(256)])
#: Bits at most of the filter of candidates; it is overfull beyond a few million of them and then lets more pass.
FILTER_BITS = 1 << 26
#: Bytes of text that a task takes at once.
CHUNK = 1_500_000


def _chunks(batches, *keys: str):
    """Chunks of rows; a text beyond a chunk's size comes in parts that end where a piece does."""
    for *values, texts in text_chunks(batches, *keys, size=CHUNK):
        if len(texts) > 1 or len(texts[0]) <= CHUNK:
            yield *values, texts
            continue
        text, at = texts[0].translate(_PLAIN), 0
        while at < len(text):
            to = text.rfind(b".", at, at + CHUNK) + 1 or text.find(b".", at + CHUNK) + 1 or len(text)
            yield *values, [text[at:to]]
            at = to


class _Words:
    """The words of a chunk of texts in plain form: where they are, the piece and the text of each."""

    def __init__(self, texts: list[bytes]):
        self.joined = b"\n".join(texts).translate(_PLAIN)
        self.data = np.frombuffer(self.joined, np.uint8)
        self.starts, self.ends = word_spans(self.data, _LETTERS)
        self.piece = np.cumsum(self.data == ord("."))[self.starts]
        self.text = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), self.starts, "right")

    def runs(self, most: int, langs: list[str], base: int = BASES[0]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(length, first words, hashes) of the runs of 1 to `most` words of a piece; a hash is of words and language."""
        from xxhash import xxh64_intdigest

        h = span_hashes(self.data, self.starts, self.ends, base)
        salts = np.array([xxh64_intdigest(x.encode(), 7) for x in langs], np.uint64)[self.text]
        for n in range(1, most + 1):
            at = np.flatnonzero(self.piece[: len(h) - n + 1] == self.piece[n - 1 :]) if len(h) >= n else np.zeros(0, np.int64)
            yield n, at, mix64(span_hashes(h, at, at + n, base) ^ salts[at])

    def phrases(self, at: np.ndarray, n: int) -> list[bytes]:
        spans = [zip(self.starts[at + k].tolist(), self.ends[at + k].tolist()) for k in range(n)]
        return [b" ".join([self.joined[a:b] for a, b in words]) for words in zip(*spans)]


def phrase_counts(docs: DataFrame, min_count: int = 10, max_words: int = 3, shards: int = 3, text_col: str = "text", lang_col: str = "lang", used: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, words, f) of all phrases of 1 to `max_words` words that occur `min_count` times; (lang, n) all words).

    Texts are dealt to `shards` shards by hash.  A shard is mined completely: all its
    phrases are counted, by 62-bit hash, and those that reach the shard's share of
    `min_count` stay.  A phrase that is frequent in all is so in one shard at least,
    because shares add up to 1, and equal hashes only raise counts; so what stays in any
    shard holds every phrase that counts.  These candidates are counted in all texts by
    the words themselves.  A shard is spread over all tasks and its counts are combined
    by Spark, so no task holds one.
    """
    used = [] if used is None else used
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), text_of(text_col).alias("text"))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("text"), F.lit(shards)).cast("int"))
    bits = np.uint64((1 << max(1, (shards - 1).bit_length())) - 1)

    def mine(batches):
        for langs, shard, texts in _chunks(batches, "lang", "shard"):
            words = _Words(texts)
            part = np.array(shard, np.uint64)[words.text]
            for _, at, h in words.runs(max_words, langs):
                key, n = np.unique((h & ~bits) | part[at], return_counts=True)
                for a in range(0, len(key), 1 << 16):
                    yield pa.RecordBatch.from_arrays([pa.array(key[a : a + (1 << 16)].view(np.int64), pa.int64()), pa.array(n[a : a + (1 << 16)], pa.int64())], names=["key", "n"])
        trim()

    share = {r["shard"]: r["n"] for r in dealt.groupBy("shard").agg(F.sum(F.length("text") + 1).alias("n")).collect()}  # a number per shard
    whole = sum(share.values()) or 1
    least = F.element_at(F.array(*[F.lit(-(-min_count * share.get(s, 0) // whole) or 1).cast("long") for s in range(shards)]), (F.col("key").bitwiseAND(F.lit(int(bits))) + 1).cast("int"))
    # Each chunk's counts are combined already; nearly all keys are then rare, and combining them again before the shuffle would only spill.
    local = dealt.select("lang", "shard", "text").mapInArrow(mine, "key long, n long").repartition("key").groupBy("key").agg(F.sum("n").alias("n"))
    candidates = written(local.where(F.col("n") >= least).select(F.col("key").bitwiseAND(F.lit(~int(bits))).alias("h")), "candidates", used)
    some = docs.sparkSession.sparkContext.broadcast(filter_of(candidates, "h", FILTER_BITS))

    def counted_batch(names, lang, phrase, n, f):
        columns = pa.array(names, pa.string()).take(pa.array(lang, pa.int32())), pa.array(phrase, pa.binary()).cast(pa.string()), pa.array(np.full(len(f), n), pa.int32()), pa.array(f, pa.int64())
        return pa.RecordBatch.from_arrays(list(columns), names=["lang", "phrase", "words", "f"])

    def count(batches):
        for langs, _, texts in _chunks(batches, "lang", "lang"):
            words, names = _Words(texts), sorted(set(langs))
            lang = np.array([names.index(x) for x in langs], np.int64)[words.text]
            totals = np.bincount(lang, minlength=len(names))
            yield counted_batch(names, range(len(names)), [None] * len(names), 0, totals)
            for (n, at, h), (_, _, other) in zip(words.runs(max_words, langs), words.runs(max_words, langs, BASES[1])):
                keep = some.value.holds(h & ~bits)
                at, both = at[keep], np.stack([h[keep], other[keep]], axis=1)  # 128 bits tell the phrases of a chunk apart
                order = np.lexsort(both.T)
                new = np.flatnonzero(np.r_[True, (both[order[1:]] != both[order[:-1]]).any(axis=1)]) if len(at) else order
                first, times = order[new], np.diff(np.r_[new, len(at)])
                for a in range(0, len(first), 1 << 15):
                    places = at[first[a : a + (1 << 15)]]
                    yield counted_batch(names, lang[places], words.phrases(places, n), n, times[a : a + (1 << 15)])
        trim()

    counted = rows.mapInArrow(count, "lang string, phrase string, words int, f long").groupBy("lang", "phrase", "words").agg(F.sum("f").alias("f"))
    counted = written(counted.where((F.col("f") >= min_count) | F.col("phrase").isNull()), "counted", used)
    return counted.where("phrase is not null"), counted.where("phrase is null").select("lang", F.col("f").alias("n"))


def _scored(counts: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, phrase, words, a, l, r, n, score) by each phrase's weakest cut; parts of a frequent phrase are frequent, so they are all counted."""
    part = F.split("phrase", " ")
    cuts = counts.where("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.withColumns({"left": F.array_join(F.slice(part, F.lit(1), F.col("k")), " "), "right": F.array_join(F.slice(part, F.col("k") + 1, F.col("words") - F.col("k")), " ")})
    l = counts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    r = counts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    whole = lambda c: F.col(c).cast("decimal(15,0)")
    both = cuts.join(l, ["lang", "left"]).join(r, ["lang", "right"])
    # Products may pass 64 bits: decimals of 38 digits hold a million times the square of counts up to 10^15.
    square, product = (whole("a") * whole("a") * F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(38,0)"), (whole("l") * whole("r")).cast("decimal(38,0)")
    scores = both.withColumns({"square": square, "product": product}).withColumn("score", F.expr("cast(square div product as long)"))
    # One long orders cuts by score, then by k: scores are a million at most.
    cut = F.struct((F.col("score") * 64 + F.col("k")).alias("order"), "l", "r", "score")
    best = scores.groupBy("lang", "phrase", "words", "a").agg(F.min_by(cut, F.col("score") * 64 + F.col("k")).alias("c"))
    return best.join(totals, "lang").select("lang", "phrase", "words", "a", "c.l", "c.r", "n", "c.score")


def _within(counts: DataFrame, share: int) -> DataFrame:
    """(lang, phrase) of phrases of two words or more that a longer one holds at `share` percent of their count."""
    part, n = F.split("phrase", " "), F.col("words")
    inner = F.flatten(F.transform(F.sequence(F.lit(2), n - 1), lambda k: F.transform(F.sequence(F.lit(1), n - k + 1), lambda at: F.array_join(F.slice(part, at, k), " "))))
    held = counts.where("words > 2").select("lang", F.col("f").alias("longer"), F.explode(F.array_distinct(inner)).alias("phrase"))
    most = held.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    return most.join(counts.where("words > 1"), ["lang", "phrase"]).where(100 * F.col("longer") >= share * F.col("f")).select("lang", "phrase")


def collocations(docs: DataFrame, min_count: int = 10, max_words: int = 3, inside_share: int = 50, top: int = 2000, shards: int = 3, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Each language's first `top` phrases: lang, rank, phrase, a, l, r, n, score.

    Texts are split into pieces at `.,;:!?` and line ends and these into words at blanks
    and tabs, A-Z lower-cased.  a, l and r count a phrase and the two parts of the cut with
    the lowest score floor(10^6 a a / (l r)), the first of equal ones; n counts words.
    Phrases that lie in a longer one with `inside_share` percent of their count go.  The
    rest are ranked by score, then a, both descending, then by the phrase's bytes.

    Edge cases: a missing language is `und`; a null or empty text has no words; repeated
    rows count each time; a phrase never crosses pieces or texts; texts and pieces may be
    of any length; languages without phrases and empty tables give no rows; other columns
    are not read.
    """
    if not 2 <= max_words <= 8:
        raise ValueError("phrases have 2 to 8 words")
    used: list[str] = []
    counts, totals = phrase_counts(docs, min_count, max_words, shards, text_col, lang_col, used)
    scored = _scored(counts, totals)
    left = scored.join(_within(counts, inside_share), ["lang", "phrase"], "left_anti") if max_words > 2 else scored
    w = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    out = written(left.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"), "collocations")
    for path in used:
        delete_path(docs.sparkSession, path)
    return out
