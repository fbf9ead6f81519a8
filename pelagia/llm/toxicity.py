"""Toxicity scores of text restored through a noisy channel.

Writers hide words by leetspeak, spacing and repetition.  A suspicious token is a lattice
of characters (what each symbol may stand for, what may be dropped); a character language
model counted over all documents and the channel's costs choose the likeliest reading by
Viterbi decoding, and the restored text is scored by a linear model on words and prefixes.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pelagia.llm.common import slices, text_of, trim, written

#: Stripped from the ends of tokens.
EDGES = ".,;:!?*$%&#|\"'()[]{}<>-_~=+/\\"
#: What a symbol may stand for.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "#": "h",
}
SEPARATORS = frozenset(" .-_*'/~,")
ALPHABET = "abcdefghijklmnopqrstuvwxyz"
START, STOP = "^", "$"
#: Log probabilities of the channel: a symbol for a letter, a dropped separator, a dropped repetition.
COST_LEET, COST_SEPARATOR, COST_REPEAT = math.log(0.3), math.log(0.5), math.log(0.3)
PREFIXES = (3, 4, 5, 6, 7)
_TRIPLE = re.compile(r"([^\W\d_])\1\1")
#: Distinct words that a task counts before it folds them into trigrams.
FOLD_WORDS = 100_000


def fold(word: str) -> str:
    """Letters without their accents."""
    return word if word.isascii() else "".join(c for c in unicodedata.normalize("NFD", word) if not unicodedata.combining(c))


def trigrams(words: Counter) -> Counter:
    """Counts of letter trigrams, with two start marks and a stop mark, of words with letters a-z only."""
    out: Counter = Counter()
    for word, n in words.items():
        word = fold(word)
        if word.isascii() and word.isalpha():
            s = START * 2 + word + STOP
            for i in range(len(s) - 2):
                out[s[i : i + 3]] += n
    return out


def count_trigrams(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(gram, n) over all documents.  At most 28 * 28 * 27 rows, whatever the corpus."""

    def run(batches):
        words, found = Counter(), Counter()
        for batch in slices(batches):
            for text in batch.column(0).to_pylist():
                words.update([w.strip(EDGES) for w in text.lower().split()])
                if len(words) > FOLD_WORDS:
                    found.update(trigrams(words))
                    words.clear()
        found.update(trigrams(words))
        words.clear()
        trim()
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], names=["gram", "n"])

    return docs.select(text_of(text_col)).mapInArrow(run, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))


@dataclass
class CharModel:
    """Interpolated trigram model of letters: log P(c | a, b)."""

    counts: dict[str, int]
    logp: dict[str, dict[str, float]] = field(default_factory=dict)

    def __post_init__(self):
        two, one, pair, total = Counter(), Counter(), Counter(), 0
        for g, n in self.counts.items():
            two[g[:2]] += n
            pair[g[1:]] += n
            one[g[2]] += n
            total += n
        before = Counter()
        for g, n in pair.items():
            before[g[0]] += n
        symbols = ALPHABET + STOP
        base = {c: (one[c] + 1) / (total + len(symbols)) for c in symbols}
        middle = {b: {c: (pair[b + c] + 5 * base[c]) / (before[b] + 5) for c in symbols} for b in START + ALPHABET}
        for a in START + ALPHABET:
            for b in START + ALPHABET:
                n = two[a + b]
                self.logp[a + b] = {c: math.log((self.counts.get(a + b + c, 0) + 5 * middle[b][c]) / (n + 5)) for c in symbols}

    def decode(self, token: str) -> str:
        """The likeliest reading of a token; the token itself if none is possible."""
        states: dict[str, tuple[float, str]] = {START * 2: (0.0, "")}
        last = ""
        for symbol in token:
            choices = [(symbol, 0.0)] if symbol in ALPHABET else [(c, COST_LEET) for c in LEET.get(symbol, "")]
            new: dict[str, tuple[float, str]] = {}
            for state, (score, text) in states.items():
                row = self.logp[state]
                for c, cost in choices:
                    s = score + cost + row[c]
                    key = state[1] + c
                    if key not in new or s > new[key][0]:
                        new[key] = (s, text + c)
                drop = COST_SEPARATOR if symbol in SEPARATORS else COST_REPEAT if symbol == last or symbol in ALPHABET and text[-1:] == symbol else None
                if drop is not None:
                    s = score + drop
                    if state not in new or s > new[state][0]:
                        new[state] = (s, text)
            if not new:
                return token
            states, last = new, symbol
        best = max(((s + self.logp[state][STOP], text) for state, (s, text) in states.items()), key=lambda x: x[0])
        return best[1] or token


def _letters(word: str) -> int:
    return sum(c.isalpha() for c in word)


def suspicious(words: list[str], text: str) -> set[str]:
    """Tokens that may hide a word: symbols among letters, a letter three times in a row, letters set apart."""
    # Symbols at the ends may be letters too ("$tupid"), so these tokens are looked at whole.
    out = set()
    for raw in set(words):
        bare = raw.strip(EDGES)
        if bare and not bare.isalpha() and not bare.isdigit() and _letters(bare):
            out.add(bare)
        if len(bare) > 2 and raw[0] in "$@!|(" and bare[0].isalpha() and raw[1:2].isalpha():
            out.add(raw.rstrip(EDGES))
    if _TRIPLE.search(text):
        out.update(w for w in {w.strip(EDGES) for w in words} if _TRIPLE.search(w))
    single = bytes([1 if len(w) == 1 else 0 for w in words])
    at = single.find(b"\x01\x01\x01\x01")
    while at >= 0:
        end = single.find(b"\x00", at)
        end = len(words) if end < 0 else end
        out.add(" ".join(words[at:end]))
        at = single.find(b"\x01\x01\x01\x01", end)
    return out


def tokens(text: str, model: CharModel | None) -> Counter:
    """The words of a text, those of its restored tokens and the accent-free forms of both, with their counts."""
    lower = text.lower()
    words = lower.split()
    found = Counter([w.strip(EDGES) for w in words])
    for w in [w for w in found if not w.isascii()]:
        found[fold(w)] += found[w]
    if model is not None:
        for token in suspicious(words, lower):
            found[model.decode(fold(token))] += 1
    del found[""]
    return found


def features(found: Counter) -> dict[str, float]:
    """Words, and beginnings of longer words marked by a dash, valued 1 + log(count)."""
    out = Counter(found)
    for k in PREFIXES:
        for w, n in found.items():
            if len(w) > k:
                out[w[:k] + "-"] += n
    return {f: 1 + math.log(n) for f, n in out.items()}


@dataclass
class ToxicModel:
    weights: dict[str, float]
    bias: float
    chars: CharModel

    def __post_init__(self):
        self.starts = {k: {f[:-1]: w for f, w in self.weights.items() if f[-1] == "-" and len(f) == k + 1} for k in PREFIXES}

    def score(self, text: str) -> float:
        found = tokens(text, self.chars)
        z, w = self.bias, self.weights
        for f in w.keys() & found.keys():
            z += w[f] * (1 + math.log(found[f]))
        for k, starts in self.starts.items():
            counts: dict[str, int] = {}
            for x in [x for x in found if x[:k] in starts and len(x) > k]:
                counts[x[:k]] = counts.get(x[:k], 0) + found[x]
            for p, n in counts.items():
                z += starts[p] * (1 + math.log(n))
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))


def _strength(n: np.ndarray, hits: np.ndarray, rows: int, positive: int) -> np.ndarray:
    """Log-likelihood ratio of each feature with the label; zero where it speaks for label 0."""

    def h(*parts):
        total = sum(parts)
        return sum(np.where(p > 0, p * np.log(np.maximum(p, 1e-12) / np.maximum(total, 1e-12)), 0.0) for p in parts)

    a, b, c, d = hits, n - hits, positive - hits, rows - n - (positive - hits)
    ratio = 2 * (h(a, b, c, d) - h(a + b, c + d) - h(a + c, b + d))
    return np.where(hits * rows > positive * n, ratio, 0.0)


def fit_weights(rows: list[tuple[list[int], list[float], int]], size: int, steps: int = 1500, l2: float = 1e-5) -> tuple[np.ndarray, float]:
    """Logistic regression on (feature, value) lists, by full-batch Adam steps."""
    y = np.array([t for _, _, t in rows], float)
    index = np.array([i for ids, _, _ in rows for i in ids], np.int64)
    value = np.array([x for _, values, _ in rows for x in values], float)
    row = np.repeat(np.arange(len(rows)), [len(ids) for ids, _, _ in rows])
    w, bias = np.zeros(size + 1), -2.0
    m, v = np.zeros(size + 1), np.zeros(size + 1)
    for k in range(1, steps + 1):
        z = bias + w[-1] + np.bincount(row, weights=w[index] * value, minlength=len(rows))
        e = (1 / (1 + np.exp(-np.clip(z, -500, 500))) - y) / len(rows)
        g = np.append(np.bincount(index, weights=e[row] * value, minlength=size)[:size] + l2 * w[:size], e.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.05 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-8)
    return w[:size], bias + w[-1]


def fit(
    docs: DataFrame, labels: DataFrame, max_rows: int = 8000, max_features: int = 2000, min_rows: int = 5, strength: float = 15.0,
    id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
) -> ToxicModel:
    """Fits the scorer on labelled rows that are not held out (crc32 of the id as text, mod 3, is not 1).

    The classifier is fitted on at most `max_rows` of them, those with the smallest id
    hashes, and keeps at most `max_features` words and prefixes, the ones that go with the
    label most strongly.  The character model is counted over all documents.  Without
    labels of both kinds the score is the share of label 1 everywhere.
    """
    spark = docs.sparkSession
    chars = CharModel({r["gram"]: r["n"] for r in count_trigrams(docs, text_col).collect()})
    ids = F.col(id_col).cast("long")
    chosen = (
        labels.select(ids.alias("__id"), F.col(label_col).cast("int").alias("__y"))
        .where(F.col("__id").isNotNull() & F.col("__y").isin(0, 1) & (F.crc32(F.col("__id").cast("string").cast("binary")) % 3 != 1))
        .groupBy("__id")
        .agg(F.max("__y").alias("__y"))
        .orderBy(F.xxhash64("__id"), "__id")
        .limit(max_rows)
    )
    # At most max_rows ids: a bound that holds for any input.
    sample = written(
        docs.select(ids.alias("__id"), text_of(text_col).alias("text")).join(F.broadcast(chosen), "__id").select("text", F.col("__y").alias("y")).repartition(16), "labelled"
    )
    shared = spark.sparkContext.broadcast(chars)

    def counted(batches):
        seen, hits = Counter(), Counter()

        def out():
            row = pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64()), pa.array([hits[f] for f in seen], pa.int64())], names=["f", "n", "hits"]
            )
            seen.clear()
            hits.clear()
            return row

        for batch in slices(batches):
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                f = features(tokens(text, shared.value)).keys()
                seen.update(f)
                if y:
                    hits.update(f)
                if len(seen) > FOLD_WORDS:
                    yield out()
        yield out()
        trim()

    total, positive = sample.agg(F.count(F.lit(1)), F.coalesce(F.sum("y"), F.lit(0))).first()
    if not 0 < positive < total:
        prior = positive / total if total else 0.0
        return ToxicModel({}, math.log((prior + 1e-9) / (1 - prior + 1e-9)), chars)
    stats = sample.mapInArrow(counted, "f string, n long, hits long").groupBy("f").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits")).where(F.col("hits") >= min_rows)
    # Only features of enough toxic rows reach the driver: at most max_rows * distinct words of them.
    rate = F.col("hits") / F.col("n")
    best = stats.where(rate > positive / total).orderBy((F.col("hits") * rate).desc(), "f").limit(5 * max_features).toPandas()
    best["s"] = _strength(best["n"].to_numpy(float), best["hits"].to_numpy(float), total, positive)
    best = best[best["s"] >= strength].sort_values(["s", "f"], ascending=[False, True]).head(max_features)
    index = {f: i for i, f in enumerate(best["f"])}
    shared_index = spark.sparkContext.broadcast(index)

    def present(batches):
        known = shared_index.value
        for batch in slices(batches):
            found = [sorted((known[f], x) for f, x in features(tokens(t, shared.value)).items() if f in known) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([[i for i, _ in x] for x in found], pa.list_(pa.int32())), pa.array([[v for _, v in x] for x in found], pa.list_(pa.float64())), batch.column(1)],
                names=["ids", "x", "y"],
            )

    rows = [(r["ids"], r["x"], r["y"]) for r in sample.mapInArrow(present, "ids array<int>, x array<double>, y int").collect()]
    weights, bias = fit_weights(rows, len(index))
    return ToxicModel({f: float(weights[i]) for f, i in index.items() if weights[i]}, float(bias), chars)


def scorer(docs: DataFrame, model: ToxicModel):
    """A column function: text -> score from 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(text: pa.Array) -> pa.Array:
        out = pa.array([shared.value.score(t.as_py()) for t in text], pa.float64())
        trim()
        return out

    return score


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, **settings) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted.

    Edge cases: a null or empty text is scored as a text without words; a missing id is
    not held out; repeated rows get equal scores; labels that repeat for an id count once,
    as 1 if any is 1; an empty table gives no rows; other columns are never read.
    """
    model = fit(docs, labels, **settings)
    score = scorer(docs, model)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    return (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), score(text_of()).alias("score"))
        .select("doc_id", held.alias("held_out"), "score")
        .withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, **settings) -> DataFrame:
    """The rows of `docs` whose score is below the threshold, with all their columns.

    Edge cases: null and empty texts are scored as empty ones; repeated rows, rows that
    share an id and rows with a missing id are each judged by their own text; an empty
    table gives no rows.
    """
    score = scorer(docs, fit(docs, labels, **settings))
    return docs.where(score(text_of()) < threshold)
