"""Personal data: fixed patterns, and a semi-Markov conditional random field that adds spans.

The field scores whole candidate segments of the text around digits and at-signs by
features of the span (shape, digit counts, checksum, octets, what stands before and
after) and chooses boundaries and kinds together by dynamic programming over segments of
bounded length.  It is trained here, on generated examples and on a bounded sample of the
corpus labelled by the fixed patterns.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import defaultdict, deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pelagia.llm.common import slices, text_of

KINDS = ("email", "ip", "card", "phone")
BASE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
#: The same as the patterns above, read in linear time: a run is entered at its start only, and given up as a whole.
_RUN_OF_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++){3}")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _valid(kind: str, span: str) -> bool:
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in span.split("."))
    if kind == "card":
        d = _NOT_DIGIT.sub("", span)
        return 12 <= len(d) <= 19 and luhn(d)
    if kind == "phone":
        return 9 <= len(_NOT_DIGIT.sub("", span)) <= 15
    return True


def _emails(text: str):
    """Spans of the email pattern: from each at-sign back over the local part, which may begin where the match before ended."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(done, at + 1))


def _matches(kind: str, text: str):
    if kind == "email":
        return _emails(text)
    return (m.span() for m in (_RUN_OF_IP if kind == "ip" else BASE[kind]).finditer(text))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns: leftmost and non-overlapping per kind, those that fail their check dropped."""
    kinds = []
    if "@" in text:
        kinds.append("email")
    if _DIGIT.search(text):
        kinds += ["ip", "card"]
        if "+" in text:
            kinds.append("phone")
    return [(a, b, k) for k in kinds for a, b in _matches(k, text) if _valid(k, text[a:b])]


#: Runs of tokens with digits or at-signs: where candidate segments are looked for.
REGION = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+(?:[ \t]++[^\s0-9@]*+[0-9@]\S*+)*+")
_PIECE = re.compile(r"[A-Za-z]+|[0-9]+|\s+|.", re.S)
#: Longest segment, in pieces (runs of letters, of digits, of blanks, or single signs).
MAX_PIECES = 16
#: A segment is added only if it beats leaving it out by so much.
MARGIN = 3.0
#: Scores of short spans that a decoder remembers.
REMEMBERED = 4096


def _pieces(region: str) -> list[tuple[int, int]]:
    return [m.span() for m in _PIECE.finditer(region)]


def _bucket(n: int) -> str:
    return str(n) if n < 20 else "20+"


def _shape(span: str) -> str:
    return re.sub(r"[0-9]+", "9", re.sub(r"[A-Za-z]+", "a", span))[:24]


def _segments(region: str) -> Iterator[tuple[int, int, int, int, bool, int]]:
    """(first piece, end piece, start, stop, has an at-sign, dots) of the segments that could be an entity, by end, then start; no more than MAX_PIECES pieces are held."""
    window: deque = deque(maxlen=MAX_PIECES)
    found = _PIECE.finditer(region)
    piece, inside, n = next(found, None), False, 0
    while piece:
        text, following = piece.group(), next(found, None)
        word = text.isalnum()
        # A word is not entered in its middle, nor left there.
        window.append((piece.start(), text in "+(" or word and not inside, len(text) if text[0].isdigit() and text.isascii() else 0, text == "@", text == "."))
        n += 1
        if word and not (following and following.group().isalnum()):
            digits, at, dots, out = 0, False, 0, []
            for back, (start, opens, size, sign, dot) in enumerate(reversed(window), 1):
                digits, at, dots = digits + size, at or sign, dots + dot
                if opens and (at and dots or digits >= 7 or dots >= 3 and digits >= 4):
                    out.append((n - back, n, start, piece.end(), at, dots))
            yield from reversed(out)
        piece, inside = following, word


def candidates(region: str) -> list[tuple[int, int, list[str]]]:
    """(first piece, end piece, features) of the segments that could be an entity, by first piece; for training, whose regions are short."""
    return sorted((i, j, _features(region, a, b, at, dots)) for i, j, a, b, at, dots in _segments(region))


def _side(c: str) -> str:
    return "blank" if c.isspace() else "word" if c.isalnum() else c


def _sides(region: str, a: int, b: int) -> tuple[str, str, str, str]:
    """What stands next to a span, before and after, and what is there beyond blanks."""
    near = region[a - 1 : a] or " ", region[b : b + 1] or " ", _beyond(region, a - 1, -1), _beyond(region, b, 1)
    return tuple(_side(c) for c in near)


def _features(region: str, a: int, b: int, at: bool, dots: int) -> list[str]:
    return _features_of(region[a:b], at, dots, *_sides(region, a, b))


def _features_of(span: str, at: bool, dots: int, before: str, after: str, prior: str, following: str) -> list[str]:
    digits = _NOT_DIGIT.sub("", span)
    groups = re.findall(r"[0-9]+", span)
    octets = len(groups) == 4 and dots == 3 and len(digits) + 3 == len(span) and all(len(g) <= 3 and int(g) <= 255 for g in groups)
    return [
        "bias",
        "digits=" + _bucket(len(digits)),
        "groups=" + _bucket(len(groups)),
        "sizes=" + "-".join(str(len(g)) for g in groups[:6]),
        f"at={at}" + ("" if not at else f",domain={bool(re.search(r'@[A-Za-z0-9-]+([.][A-Za-z0-9-]+)*[.][A-Za-z]{2,}$', span))}"),
        "shape=" + _shape(span),
        f"octets={octets}",
        f"luhn={12 <= len(digits) <= 19 and luhn(digits)}",
        "before=" + before,
        "after=" + after,
        "prior=" + prior,
        "next=" + following,
        f"letters={bool(re.search('[A-Za-z]', span))}",
        f"plus={span[0] == '+'},paren={'(' in span}",
        f"blanks={bool(re.search(r'[ ]{2}|[^ -~]', span))}",
    ]


def _beyond(region: str, at: int, step: int) -> str:
    """The next sign that isn't blank, from `at` on in one direction; a blank if there is none."""
    while 0 <= at < len(region) and region[at].isspace():
        at += step
    return region[at] if 0 <= at < len(region) else " "


class SegmentField:
    """Weights of (kind, feature), and decoding and training over candidate segments."""

    def __init__(self, weights: dict[str, dict[str, float]] | None = None):
        self.weights = weights or {k: {} for k in KINDS}
        self._known: dict[tuple, list[tuple[str, float]]] = {}

    def _scores(self, found) -> list[tuple[int, int, str, float]]:
        return [(i, j, k, sum([w.get(f, 0.0) for f in fs])) for i, j, fs in found for k, w in self.weights.items()]

    def _worths(self, key: tuple) -> list[tuple[str, float]]:
        """What a segment of each kind adds, by its span and sides; remembered for short spans, of which at most REMEMBERED are kept."""
        if (worth := self._known.get(key)) is None:
            features = _features_of(*key)
            worth = [(k, sum([w.get(f, 0.0) for f in features]) - MARGIN) for k, w in self.weights.items()]
            if len(key[0]) <= 64:
                if len(self._known) >= REMEMBERED:
                    self._known.clear()
                self._known[key] = worth
        return worth

    def decode(self, region: str) -> list[tuple[int, int, str]]:
        """The best segmentation; pieces outside entities score zero.  Offsets within the region.

        A segment is scored when its last piece is read and then forgotten; of the best
        segmentations only those up to the last MAX_PIECES pieces are held, as chains that
        share what they begin with.
        """
        best, done = deque([(0.0, None)], maxlen=MAX_PIECES + 1), 0
        for i, j, a, b, at, dots in _segments(region):
            for _ in range(min(j - done, MAX_PIECES + 1)):
                best.append(best[-1])
            done = j
            score, chain = best[i - j - 1]
            for k, worth in self._worths((region[a:b], at, dots, *_sides(region, a, b))):
                if score + worth > best[-1][0]:
                    best[-1] = score + worth, (chain, a, b, k)
        out, chain = [], best[-1][1]
        while chain:
            chain, *span = chain
            out.append(tuple(span))
        return out[::-1]

    def train(self, examples: list[tuple[str, list[tuple[int, int, str]]]], epochs: int = 6, rate: float = 0.3, l2: float = 1e-3, seed: int = 7) -> SegmentField:
        """Stochastic gradient steps on the conditional log-likelihood (forward and backward sums over segmentations)."""
        prepared = [(len(_pieces(r)), candidates(r), {(a, b): k for a, b, k in gold}, _pieces(r)) for r, gold in examples]
        prepared = [p for p in prepared if p[1]]
        order = random.Random(seed)
        for epoch in range(epochs):
            order.shuffle(prepared)
            step = rate / (1 + epoch)
            for n, found, gold, parts in prepared:
                scored = self._scores(found)
                begin, end = defaultdict(list), defaultdict(list)
                for i, j, _, s in scored:
                    end[j].append((i, s))
                    begin[i].append((j, s))
                forward, backward = [0.0] * (n + 1), [0.0] * (n + 1)
                for j in range(1, n + 1):
                    forward[j] = _logsum([forward[j - 1], *[forward[i] + s for i, s in end[j]]])
                for i in range(n - 1, -1, -1):
                    backward[i] = _logsum([backward[i + 1], *[backward[j] + s for j, s in begin[i]]])
                features = {(i, j): fs for i, j, fs in found}
                for i, j, k, s in scored:
                    observed = 1.0 if gold.get((parts[i][0], parts[j - 1][1])) == k else 0.0
                    delta = observed - math.exp(min(0.0, forward[i] + s + backward[j] - forward[n]))
                    if abs(delta) > 1e-4:
                        w = self.weights[k]
                        for f in features[i, j]:
                            w[f] = w.get(f, 0.0) * (1 - step * l2) + step * delta
        self._known.clear()
        return self


def _logsum(xs: list[float]) -> float:
    m = max(xs)
    return m + math.log(sum([math.exp(x - m) for x in xs]))


def generated(n: int = 1500, seed: int = 11) -> list[tuple[str, list[tuple[int, int, str]]]]:
    """Regions with entities of each kind, variants that the patterns miss, and look-alikes that are none."""
    rng = random.Random(seed)
    digits = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    word = lambda: "".join(rng.choice("abcdefghijklmnoprstuvw") for _ in range(rng.randint(3, 8)))

    def card() -> str:
        d = digits(15)
        return next(d + c for c in "0123456789" if luhn(d + c))

    def bad_card() -> str:
        d = digits(16)
        return d if not luhn(d) else d[:-1] + str((int(d[-1]) + 1) % 10)

    def split(d: str, sep: str) -> str:
        return sep.join(d[k : k + 4] for k in range(0, len(d), 4))

    makers = [
        ("email", lambda: f"{word()}.{word()}@{word()}.{rng.choice(['com', 'org', 'net', 'de'])}"),
        ("email", lambda: f"{word()}{digits(2)}@{word()}{digits(1)}.{word()}.com"),
        ("ip", lambda: ".".join(str(rng.randint(0, 255)) for _ in range(4))),
        ("card", card),
        ("card", lambda: split(card(), rng.choice(" -"))),
        ("card", lambda: split(card(), ".")),
        ("phone", lambda: f"+{rng.randint(1, 99)} ({digits(3)}) {digits(3)}-{digits(4)}"),
        ("phone", lambda: f"+{rng.randint(1, 99)} {digits(3)} {digits(3)} {digits(4)}"),
        ("phone", lambda: f"({digits(3)}) {digits(3)}-{digits(4)}"),
        ("phone", lambda: f"{digits(3)}-{digits(3)}-{digits(4)}"),
        (None, bad_card),
        (None, lambda: split(bad_card(), rng.choice(" -"))),
        (None, lambda: digits(rng.randint(7, 11))),
        (None, lambda: f"{digits(1)}.{digits(1)}.{digits(1)}"),
        (None, lambda: f"{rng.randint(256, 999)}.{digits(2)}.{digits(2)}.{digits(3)}"),
        (None, lambda: f"20{digits(2)}-{digits(2)}-{digits(2)} {digits(2)}:{digits(2)}:{digits(2)}"),
        (None, lambda: "".join(rng.choice("0123456789abcdef") for _ in range(40))),
        (None, lambda: f"{digits(3)},{digits(3)},{digits(3)}"),
    ]
    out = []
    for k in range(n):
        kind, make = makers[k % len(makers)]
        text = make()
        lead = rng.choice(["", "", f"{digits(2)} ", f"x{digits(1)} "])
        tail = rng.choice(["", "", ".", ",", "!!", f" {digits(2)}"])
        out.append((lead + text + tail, [(len(lead), len(lead) + len(text), kind)] if kind else []))
    return out


def fit(docs: DataFrame, max_docs: int = 2000, max_regions: int = 600, id_col: str = "doc_id", text_col: str = "text") -> SegmentField:
    """Trains the field on generated examples and on at most `max_regions` regions of at most `max_docs` documents.

    The documents are those with the smallest id hashes; their regions are labelled by the
    fixed patterns, so what these leave out teaches what is no personal data here.
    """
    ids = F.col(id_col).cast("long")
    chosen = docs.select(ids.alias("__id")).where("__id is not null").distinct().orderBy(F.xxhash64("__id"), "__id").limit(max_docs)

    def regions(batches):
        for batch in batches:
            found = [m.group() for t in batch.column(0).to_pylist() for m in REGION.finditer(t) if m.end() - m.start() <= 200]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], names=["region"])

    # At most max_docs ids: a bound that holds for any input.
    sample = docs.select(ids.alias("__id"), text_of(text_col).alias("text")).join(F.broadcast(chosen), "__id").select("text").mapInArrow(regions, "region string")
    rows = sample.distinct().orderBy(F.xxhash64("region"), "region").limit(max_regions).collect()
    return SegmentField().train(generated() + [(r["region"], base_spans(r["region"])) for r in rows])


def all_spans(text: str, field: SegmentField) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """(spans of the fixed patterns, spans that the field adds); added spans overlap no other."""
    base = base_spans(text)
    if "@" not in text and not _DIGIT.search(text):
        return base, []
    added = []
    taken = sorted((a, b) for a, b, _ in base)
    for m in REGION.finditer(text):
        for a, b, kind in field.decode(m.group()):
            a, b = a + m.start(), b + m.start()
            if not any(x < b and a < y for x, y in _near(taken, a, b)):
                added.append((a, b, kind))
    return base, added


def _near(taken: list[tuple[int, int]], a: int, b: int) -> list[tuple[int, int]]:
    from bisect import bisect_left

    at = bisect_left(taken, (b, 0))
    return taken[max(0, at - 4) : at]


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1])))


def personal_data(docs: DataFrame, field: SegmentField | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added.

    Counts and base_sha256 are of the fixed patterns; `spans` holds these and what the
    field adds, as kind:start:end in code points, by start and then kind.

    Edge cases: a null text is the empty one and has no spans; texts of any length are
    read whole; repeated rows get equal results; an empty table gives no rows; other
    columns are not read.
    """
    field = field or fit(docs, id_col=id_col, text_col=text_col)
    shared = docs.sparkSession.sparkContext.broadcast(field)
    names = ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_added"]

    def run(batches):
        for batch in slices(batches):
            found = [all_spans(t, shared.value) for t in batch.column(1).to_pylist()]
            counts = [pa.array([sum(s[2] == k for s in base) for base, _ in found], pa.int64()) for k in KINDS]
            digests = [hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *counts, pa.array(digests, pa.string()), pa.array([joined(b + a) for b, a in found], pa.string()), pa.array([len(a) for _, a in found], pa.int64())],
                names=names,
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")


def redact(docs: DataFrame, field: SegmentField | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` with each span of personal data replaced by its kind in angle brackets.

    Spans that overlap are replaced once, by the kind of the one that begins first.

    Edge cases: a null text becomes the empty one; texts without spans stay as they are;
    repeated rows and rows with a missing id are redacted like others; an empty table gives
    no rows; other columns go along unread.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field or fit(docs, id_col=id_col, text_col=text_col))

    @F.arrow_udf("string")
    def clean(text: pa.Array) -> pa.Array:
        out = []
        for t in text.to_pylist():
            parts, at = [], 0
            for a, b, kind in sorted(sum(all_spans(t, shared.value), [])):
                if b <= at:
                    continue
                parts += [t[at : max(a, at)], f"<{kind}>"]
                at = b
            out.append("".join([*parts, t[at:]]))
        return pa.array(out, pa.string())

    return docs.withColumn(text_col, clean(text_of(text_col)))
