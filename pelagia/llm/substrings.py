"""Repeated passages: recurring windows confirmed, compiled into sharded automata, located in all texts."""

from __future__ import annotations

from itertools import count

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pelagia.llm.common import Filter, filter_of, span_hashes, text_chunks, text_of, trim, word_spans, written
from pelagia.sources.scratch import delete_path

#: Windows of a shard's automaton on average; one that would hold twice as many is dealt to several.  Small ones are
#: fast: at its root an automaton compares a letter with all first letters.
SHARD_WINDOWS = 1000
#: Passages that a hit of one block is compared with at most.
SHARED = 8
#: Pieces of text that one automaton reads; a shard with more is copied to several tasks.
SHARD_PIECES = 20_000
#: Bytes of text that a task takes at once, and bits at most of the filters that tasks hold.
CHUNK, FILTER_BITS = 2_000_000, 1 << 26
#: Bits of a place in a chunk, beside which the rest of a hash decides which seed is least.
PLACE_BITS = 28
#: Bytes of words: all but white space of ASCII.
_LETTERS = np.array([b not in b" \t\n\x0b\x0c\r" for b in range(256)])


def runs_of(h: np.ndarray, size: int) -> np.ndarray:
    """64-bit hashes of the runs of `size` of the given hashes."""
    at = np.arange(max(0, len(h) - size + 1))
    return span_hashes(h, at, at + size)


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Minima of all runs of `width` values, by doubling."""
    size = 1
    while 2 * size <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[: len(x) - (width - size)], x[width - size :]) if size < width else x


def pieces_of(h: np.ndarray, counts: np.ndarray, window: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first window, last window, seed's hash, its places) of the pieces of texts of `counts` words whose hashes are `h`.

    A window's seed is the least of its runs of `seed` words, so equal windows have equal
    seeds wherever they are; a piece is a run of a text's windows with one seed.  Places
    tells one from several, which periodic texts have.
    """
    g = runs_of(h, seed)
    width = window - seed + 1
    if len(h) < window:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    mask, place = np.uint64((1 << PLACE_BITS) - 1), np.arange(len(g), dtype=np.uint64)
    left = (_least((g & ~mask) | place, width) & mask).astype(np.int64)
    right = (mask - (_least((g & ~mask) | (mask - place), width) & mask)).astype(np.int64)
    value = g[left]
    ends = np.repeat(np.cumsum(counts), counts)[: len(value)]
    fine = np.arange(len(value)) + window <= ends
    same = np.zeros(len(value), bool)
    same[1:] = fine[1:] & fine[:-1] & (value[1:] == value[:-1])
    first = np.flatnonzero(fine & ~same)
    closes = fine.copy()
    closes[:-1] &= ~same[1:]
    last = np.flatnonzero(closes)
    return first, last, value[first], 1 + (right[last] != left[first])


def _words(texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(the texts in one, its words' starts, ends and hashes, words of each text)."""
    joined = b"\n".join(texts)
    data = np.frombuffer(joined, np.uint8)
    starts, ends = word_spans(data, _LETTERS)
    begin = np.cumsum([0] + [len(t) + 1 for t in texts])
    return joined, starts, ends, span_hashes(data, starts, ends), np.diff(np.searchsorted(starts, begin))


def _in(found: Filter):
    """Whether 64-bit hashes may be in the filter's set."""

    @F.arrow_udf(T.BooleanType())
    def holds(h: pa.Array) -> pa.Array:
        return pa.array(found.holds(h.to_numpy(zero_copy_only=False).view(np.uint64)))

    return holds


def _seeds(rows: DataFrame, window: int, seed: int) -> DataFrame:
    """(h) of the seeds at more than one place of all texts."""

    def run(batches):
        for (texts,) in text_chunks(batches, size=CHUNK):
            *_, words, counts = _words(texts)
            _, _, value, places = pieces_of(words, counts, window, seed)
            h, at = np.unique(value, return_inverse=True)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64), pa.int64()), pa.array(np.bincount(at, places, len(h)).astype(np.int64), pa.int64())], names=["h", "n"])
        trim()

    return rows.select("text").mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where("n > 1").select("h")


def _pieces(rows: DataFrame, seeds: Filter, window: int, seed: int) -> DataFrame:
    """(key, start, seed, base, text) of the pieces whose seed recurs; base + k is the number of a piece's window k, unique in all."""
    seeds = rows.sparkSession.sparkContext.broadcast(seeds)

    def run(batches):
        base = TaskContext.get().partitionId() << 40
        for keys, texts in text_chunks(batches, "key", size=CHUNK):
            joined, starts, ends, words, counts = _words(texts)
            first, last, value, _ = pieces_of(words, counts, window, seed)
            keep = seeds.value.holds(value)
            first, last, value = first[keep], last[keep], value[keep]
            after = np.cumsum(counts)
            row = np.searchsorted(after, first, "right")
            size = last - first + 1
            number = base + np.cumsum(size) - size
            base += int(size.sum())
            out = [joined[a:b] for a, b in zip(starts[first].tolist(), ends[last + window - 1].tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([keys[r] for r in row.tolist()], pa.binary()), pa.array(first - (after - counts)[row], pa.int64()), pa.array(value.view(np.int64), pa.int64()), pa.array(number, pa.int64()), pa.array(out, pa.binary())],
                names=["key", "start", "seed", "base", "text"],
            )
        trim()

    return rows.select("key", "text").mapInArrow(run, "key binary, start long, seed long, base long, text binary")


def _recurring(pieces: DataFrame, window: int) -> DataFrame:
    """(base, place) of the first of each window that recurs, by its seed and hash; the search tells whether its words do."""

    def run(batches):
        for seeds, bases, texts in text_chunks(batches, "seed", "base", size=CHUNK):
            *_, words, counts = _words(texts)
            h = runs_of(words, window)
            size = np.maximum(counts - window + 1, 0)
            within = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            at = within + np.repeat(np.cumsum(counts) - counts, size)
            base = np.repeat(np.array(bases, np.int64), size)
            columns = np.repeat(np.array(seeds, np.int64), size), h[at].view(np.int64), base, base + within
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["seed", "w", "base", "place"])
        trim()

    found = pieces.select("seed", "base", "text").mapInArrow(run, "seed long, w long, base long, place long")
    # Pieces' numbers do not overlap, so the least place lies in the piece with the least base.
    return found.groupBy("seed", "w").agg(F.count(F.lit(1)).alias("n"), F.min("base").alias("base"), F.min("place").alias("place")).where("n > 1").select("base", "place")


def _common(a: str, b: str) -> int:
    """How many first letters two texts have in common."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return next(k for k, (x, y) in enumerate(zip(a, b)) if x != y)


class _Shard:
    """An automaton over passages of words, a character for each word, and where each passage was first.

    A window of the size w holds one of the blocks of (w + 1) // 2 words, side by side,
    into which its passage is cut, so the automaton is of blocks and a hit is extended to
    both sides.  A block that more than SHARED passages have is left to their windows
    around it, each a key of its own, so that a hit never stands for many passages.
    """

    def __init__(self, window: int):
        self.window, self.block, self.letters = window, (window + 1) // 2, {}
        self.code = (chr(c) for c in count(1) if not 0xD800 <= c < 0xE000)
        self.passages: list[tuple[bytes, int, int, str]] = []
        self.blocks: dict[str, list[tuple[int, int]]] = {}
        self.keys: list[tuple[int, list[tuple[int, int]]]] = []
        self.automaton, self.seen = None, {}

    def add(self, key: bytes, start: int, base: int, text: bytes, places: list[int]) -> None:
        """The passages of a piece that the windows with the numbers `places` make up."""
        letters = self.letters
        words = text.split()
        for w in words:
            if w not in letters:
                letters[w] = next(self.code)
        line = "".join(map(letters.__getitem__, words))
        places = sorted(places)
        cuts = [0, *[k for k in range(1, len(places)) if places[k] != places[k - 1] + 1], len(places)]
        for a, b in zip(cuts, cuts[1:]):
            first = places[a]
            passage = line[first - base : places[b - 1] - base + self.window]
            for at in range(0, len(passage) - self.block + 1, self.block):
                self.blocks.setdefault(passage[at : at + self.block], []).append((len(self.passages), at))
            self.passages.append((key, start + first - base, first, passage))

    def compile(self) -> None:
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        windows: dict[str, list[tuple[int, int]]] = {}
        for text, owners in self.blocks.items():
            if len(owners) <= SHARED:
                self.automaton.add_word(text, len(self.keys))
                self.keys.append((self.block, owners))
                continue
            for k, at in owners:
                passage = self.passages[k][3]
                for p in range(max(0, at + self.block - self.window), min(at, len(passage) - self.window) + 1):
                    windows.setdefault(passage[p : p + self.window], [(k, p)])  # a window is of one passage
        for text, owners in windows.items():
            self.automaton.add_word(text, len(self.keys))
            self.keys.append((self.window, owners))
        self.automaton.make_automaton()

    def search(self, start: int, base: int, text: bytes) -> list[tuple[int, int]]:
        """Spans of a piece's words that passages cover with a window or more, but for a passage where it was taken from."""
        if self.automaton is None:
            self.compile()
        known = self.letters.get
        line = "".join([known(w, "\0") for w in text.split()])
        spans, met = [], set()
        for end, number in self.automaton.iter(line):
            size, owners = self.keys[number]
            at = end - size + 1
            for k, p in owners:
                _, _, first, passage = self.passages[k]
                if base + at - p == first or size == self.block and (k, at - p) in met:
                    continue
                before = _common(passage[:p][::-1], line[:at][::-1]) if size == self.block else 0
                after = _common(passage[p + size :], line[end + 1 :]) if size == self.block else 0
                if before + size + after >= self.window:
                    met.add((k, at - p))
                    spans.append((start + at - before, start + end + 1 + after))
                    self.seen.setdefault(k, set()).add((p - before, p + size + after))
        return _joined(spans)

    def firsts(self):
        """(key, spans) of the passages, as far as they were found elsewhere, where they were taken from."""
        for k, spans in self.seen.items():
            key, start, _, _ = self.passages[k]
            yield key, [(start + a, start + b) for a, b in _joined(spans)]


def _joined(spans) -> list[tuple[int, int]]:
    """The union of spans."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _located(rows: DataFrame, window: int) -> DataFrame:
    """(key, a, b) spans of words: rows are sorted so that a shard's windows come before the pieces that it reads."""

    def run(batches):
        shard, name, out = None, None, []

        def rows_out(least: int):
            while len(out) > least:
                some, out[:] = out[: 1 << 15], out[1 << 15 :]
                yield pa.RecordBatch.from_arrays([pa.array([s[0] for s in some], pa.binary()), *[pa.array([s[k] for s in some], pa.int64()) for k in (1, 2)]], names=["key", "a", "b"])

        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                for *at_shard, key, start, base, text, places in zip(*[c.to_pylist() for c in batch.slice(at, 512).columns]):
                    if at_shard != name:
                        if shard is not None:
                            out += [(k, a, b) for k, spans in shard.firsts() for a, b in spans]
                        shard, name = _Shard(window), at_shard
                    if places is not None:
                        shard.add(key, start, base, text, places)
                    elif shard.passages:
                        out += [(key, a, b) for a, b in shard.search(start, base, text)]
                yield from rows_out(1 << 15)
        if shard is not None:
            out += [(key, a, b) for key, spans in shard.firsts() for a, b in spans]
        yield from rows_out(0)
        trim()

    return rows.mapInArrow(run, "key binary, a long, b long")


def repeated_spans(docs: DataFrame, window: int = 35, seed: int = 10, text_col: str = "text", id_col: str = "doc_id", used: list[str] | None = None) -> DataFrame:
    """(key, spans) of texts with repeated windows: spans of words [a, b) that such windows cover; key is `text_key`.

    Every window has a seed, the least of its runs of `seed` words, so texts are cut into
    pieces that are compared only where seeds are equal.  Seeds at one place alone can't
    recur, which leaves few pieces.  Of these, windows whose hash recurs are taken from
    their first place and compiled, by seed, into automata of bounded size; each piece is
    read by the automaton of its seed.  A match is of the words themselves, and a window
    counts only if it is found elsewhere than where it was taken from, so equal hashes of
    different windows do no harm.  Seeds that very many texts hold are read by several
    copies of their automaton, and many windows of one seed make several automata.
    """
    used = [] if used is None else used
    rows = docs.select(text_key(id_col, text_col).alias("key"), text_of(text_col).alias("text"))
    seeds = filter_of(written(_seeds(rows, window, seed), "seeds", used), "h", FILTER_BITS)
    pieces = written(_pieces(rows, seeds, window, seed), "pieces", used)
    firsts = written(_recurring(pieces, window).groupBy("base").agg(F.collect_list("place").alias("places")), "firsts", used)
    holds = _in(filter_of(firsts.select(F.xxhash64("base").alias("h")), "h", FILTER_BITS))
    shards = max(1, -(-(firsts.agg(F.sum(F.size("places"))).first()[0] or 0) // SHARD_WINDOWS))
    shard = F.pmod(F.xxhash64("seed"), F.lit(int(shards))).alias("shard")
    patterns = written(pieces.where(holds(F.xxhash64("base"))).join(firsts, "base").select(shard, "key", "start", "base", "text", "places"), "patterns", used)

    load = pieces.groupBy(shard).agg(F.ceil(F.count(F.lit(1)) / SHARD_PIECES).cast("int").alias("salts"))
    sizes = patterns.groupBy("shard").agg(F.ceil(F.sum(F.size("places")) / (2 * SHARD_WINDOWS)).cast("int").alias("subs"))
    load = written(load.join(sizes, "shard"), "load", used)
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    deal = lambda n: F.pmod(F.xxhash64("base"), F.col(n)).cast("int")
    columns = ["shard", "sub", "salt", "key", "start", "base", "text", "places"]
    compiled = patterns.join(load, "shard").withColumn("sub", deal("subs")).withColumn("salt", each("salts")).select(columns)
    read = pieces.select(shard, "key", "start", "base", "text").join(load, "shard").withColumn("sub", each("subs"))
    read = read.withColumns({"salt": deal("salts"), "places": F.lit(None).cast("array<long>")}).select(columns)
    dealt = compiled.union(read).repartition("shard", "sub", "salt").sortWithinPartitions("shard", "sub", "salt", F.col("places").isNull(), "base")
    return written(_located(dealt, window).groupBy("key").agg(F.collect_set(F.struct("a", "b")).alias("spans")), "spans", used)


def text_key(id_col: str, text_col: str) -> Column:
    """128 bits of a row's id and text; rows with both equal have the same spans."""
    return F.unhex(F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"), text_of(text_col))))


def _cut(rows: DataFrame, with_spans: bool) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text) of rows with the spans that they lose."""

    def run(batches):
        for ids, spans, texts in text_chunks(batches, "doc_id", "spans" if with_spans else "doc_id", size=CHUNK):
            sizes, gone, kept = [], [], []
            for found, t in zip(spans, texts):
                words = t.split()
                sizes.append(len(words))
                if with_spans:
                    keep = np.ones(len(words), bool)
                    for s in found:
                        keep[s["a"] : s["b"]] = False
                    words = [words[k] for k in np.flatnonzero(keep).tolist()]
                gone.append(sizes[-1] - len(words))
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "n_removed", "kept_text"])
        trim()

    return rows.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_text string")


def drop_repeated_passages(docs: DataFrame, window: int = 35, seed: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept_text.

    Words are what white space of ASCII separates, unchanged.  A word goes if any window of
    `window` words that covers it has a word sequence that also starts anywhere else, in
    the same text or another; the other words stay, joined by one space.  Windows are
    judged on the input (see `repeated_spans`).  Only texts with spans are shuffled to meet them.

    Edge cases: a null, empty or blank text has no words; texts of fewer words than a
    window lose none; every row is a text of its own, so repeated rows, rows that share an
    id and rows with a missing id lose what they share; an empty table gives no rows; other
    columns are not read.
    """
    if not 1 <= seed <= window or window < 2:
        raise ValueError("a seed has 1 to `window` words, a window 2 or more")
    spark, used = docs.sparkSession, []
    found = repeated_spans(docs, window, seed, text_col, id_col, used)
    holds = _in(filter_of(found.select(F.xxhash64("key").alias("h")), "h", FILTER_BITS))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_key(id_col, text_col).alias("key"), text_of(text_col).alias("text"))
    hit = holds(F.xxhash64("key"))
    touched = rows.where(hit).join(found, "key", "left").withColumn("spans", F.coalesce("spans", F.array().cast(found.schema["spans"].dataType)))
    out = written(_cut(rows.where(~hit).select("doc_id", "text"), False).unionByName(_cut(touched.select("doc_id", "text", "spans"), True)), "kept")
    for path in used:
        delete_path(spark, path)
    return out
