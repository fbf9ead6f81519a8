"""Benchmark decontamination by templates: slots replaced by typed placeholders, windows joined by hash."""

from __future__ import annotations

import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pelagia.llm.common import Hasher, filter_of, mix64, slices, span_hashes, text_of, trim, word_spans, written

UNITS = frozenset(
    """kg g mg t lb lbs oz km m cm mm mi ft in yd l ml s sec secs ms min mins h hr hrs hours hour minutes minute seconds second days day weeks week months month years year
    meters metres meter metre miles mile feet foot inches inch liters litres grams kilograms kilometers kilometres dollars dollar cents euros euro pounds percent degrees
    mph kmh kph hz khz mhz ghz kb mb gb tb w kw kwh v""".split()
)
_IN = rb"A-Za-z0-9\x80-\xff"
_UNIT = b"|".join(sorted((u.encode() for u in UNITS), key=len, reverse=True))
#: Capitals of ASCII, Latin-1, Latin Extended-A, Greek and Cyrillic, as UTF-8.
_CAPITALS = [chr(c).encode() for c in [*range(65, 91), *range(0xC0, 0x180), *range(0x386, 0x3AC), *range(0x400, 0x430)] if chr(c).isupper()]
#: A class of last bytes for each first byte; the pattern tries far fewer branches so.
_CAPITAL = b"|".join(re.escape(lead) + b"[" + b"".join(re.escape(c[-1:]) for c in _CAPITALS if c[:-1] == lead) + b"]" for lead in sorted({c[:-1] for c in _CAPITALS}))
#: A capitalised word within a sentence: after a word or a comma and white space, which is one blank by then; the search goes from blank to blank.
_NAME = re.compile(rb" (?<=[a-z0-9,;\x80-\xff] )((?:" + _CAPITAL + rb")(?:[a-z]|[\xc3-\xf4][\x80-\xbf]+)+)(?![" + _IN + rb"])")
_NUMBER = re.compile(rb"(?<![" + _IN + rb"])[0-9][0-9.,:/]*(?:st|nd|rd|th)?(?![" + _IN + rb"])")
_MEASURE = re.compile(rb"(?<![" + _IN + rb"])[0-9][0-9.,]*(?:" + _UNIT + rb")(?![" + _IN + rb"])", re.I)
_UNIT_AFTER = re.compile(rb"(?<=\x02 )(?:" + _UNIT + rb")(?![" + _IN + rb"])", re.I)
#: Placeholders in the order in which they are put in.
SLOTS = ((b"\x01", _NAME), (b"\x04", _MEASURE), (b"\x02", _NUMBER), (b"\x03", _UNIT_AFTER))
PLACEHOLDERS = frozenset(p for p, _ in SLOTS)
_DROPPED = bytes(c for c in range(5, 128) if not chr(c).isalnum() and c not in b" \t\n\x0b\x0c\r")
_DIGIT = re.compile(rb"[0-9]")
_IN_WORD = re.compile(rb"[\x01-\x04]")
#: A 64-bit number for each byte, so that words that differ in length or in zero bytes don't come near each other.
_NUMBERS = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_LETTERS = np.array([c not in b" \t\n\x0b\x0c\r" for c in range(256)])
#: Added to the length of a window that is compared by its words as they are.
EXACT = 1 << 32


_STEP = 0xD6E8FEB86659FD93
_BACK = pow(_STEP, -1, 1 << 64)


class Powers:
    """Powers of _STEP and of its inverse modulo 2**64, as many as were asked for."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def to(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = 1 << n.bit_length()
            cls.up, cls.down = (np.cumprod(np.append(np.ones(1, np.uint64), np.full(size, x, np.uint64))) for x in (_STEP, _BACK))
        return cls.up[:n], cls.down[:n]


def _replaced(text: str) -> tuple[bytes, list[tuple[bytes, bytes]]]:
    """(the template with white space between its words, the stages of `template`)."""
    raw, stages = b" ".join(text.encode().translate(None, b"\x01\x02\x03\x04").split()), []
    digits = _DIGIT.search(raw) is not None
    for mark, pattern in SLOTS:
        if digits or pattern is _NAME:
            stages.append((mark, raw))
            raw = pattern.sub(b" " + mark if pattern is _NAME else mark, raw)
    return raw.lower().translate(None, _DROPPED), stages


def template(text: str) -> tuple[list[bytes], list[tuple[bytes, bytes]]]:
    """(template words, the text at each stage of the replacement with the placeholder that comes next).

    White space parts words, however much of it; case of A-Z and punctuation are dropped.
    """
    raw, stages = _replaced(text)
    return raw.split(), stages


def hashed(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hashes of the words of a template, whether each is a placeholder), from its bytes."""
    data = np.frombuffer(raw, np.uint8)
    starts, ends = word_spans(data, _LETTERS)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    first = data[starts]
    return span_hashes(_NUMBERS[data], starts, ends), (ends - starts == 1) & (first >= 1) & (first <= 4)


def slot_values(stages: list[tuple[bytes, bytes]]) -> dict[bytes, list[str]]:
    """The values that each placeholder stands for, in their order in the text."""
    patterns = dict(SLOTS)
    return {mark: [m.rstrip(b".,:/").lower().decode("utf-8", "replace") for m in patterns[mark].findall(raw)] for mark, raw in stages}


def places(words: list[bytes], stages: list[tuple[bytes, bytes]]) -> tuple[dict[int, list[str]], dict[int, bytes]]:
    """By the position of each word that has slots, alone or glued to text: their values, and the word with these put back."""
    values, held, plain = {k: iter(v) for k, v in slot_values(stages).items()}, {}, {}
    for k, w in enumerate(words):
        if marks := _IN_WORD.findall(w):
            held[k] = [next(values[m], "") for m in marks]
            back = iter(held[k])
            plain[k] = _IN_WORD.sub(lambda _: next(back).encode(), w)  # noqa: B023
    return held, plain


def windows(h: np.ndarray, slot: np.ndarray, lengths: Iterable[int], heavy: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, hash) of the windows that are placeholders for at most half, or with `heavy` of those for more."""
    starts, sizes, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    up, down = Powers.to(len(h))
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(h * up)))
    slots = np.concatenate(([0], np.cumsum(slot))) if slot.any() else None
    for n in sorted(set(lengths)):
        if len(h) >= n > 0:
            x = mix64((total[n:] - total[:-n]) * down[: len(h) - n + 1] + np.uint64(n + EXACT * heavy))
            many = np.zeros(len(x), bool) if slots is None else 2 * (slots[n:] - slots[:-n]) > n
            at = np.flatnonzero(many == heavy)
            starts.append(at)
            sizes.append(np.full(len(at), n))
            hashes.append(x[at])
    return np.concatenate(starts), np.concatenate(sizes), np.concatenate(hashes)


def _any_heavy(slot: np.ndarray, lengths: Iterable[int]) -> bool:
    slots = np.concatenate(([0], np.cumsum(slot)))
    return any((2 * (slots[n:] - slots[:-n]) > n).any() for n in lengths if len(slot) >= n > 0)


_WINDOW = "id long, pos long, size long, h long, slots array<string>, total long"


def _rows(df: DataFrame, id_col: str, text_col: str, window: int, lengths: Iterable[int] | None, allowed) -> DataFrame:
    """Windows of each text.  lengths None: a text shorter than `window` is one window of its own length.

    Windows of placeholders for more than half say little as templates; they are hashed
    with their values put back.  Of items (lengths None) only those have them that have
    no other windows.
    """

    def run(batches):
        hasher = Hasher()
        for batch in slices(batches):
            out: list[list] = [[], [], [], [], [], []]
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                raw, stages = _replaced(text)
                known, slot = hashed(raw)
                if not len(known):
                    continue
                wanted = lengths if lengths is not None else [min(window, len(known))]
                starts, sizes, hashes = windows(known, slot, wanted)
                held = None
                if slot.any() and (lengths is not None or not len(starts)) and _any_heavy(slot, wanted):
                    words = raw.split()
                    held, plain = places(words, stages)
                    exact = windows(hasher([plain.get(k, w) for k, w in enumerate(words)]), slot, wanted, heavy=True)
                    starts, hashes = np.concatenate((starts, exact[0])), np.concatenate((hashes, exact[2]))
                    sizes = np.concatenate((sizes, exact[1] + EXACT))
                total = len(starts)
                if allowed is not None and total:
                    keep = allowed.value.holds(hashes)
                    if not keep.any():
                        continue
                    starts, sizes, hashes = starts[keep], sizes[keep], hashes[keep]
                place = places(raw.split(), stages)[0] if held is None else held
                for s, n, x in zip(starts.tolist(), sizes.tolist(), hashes.view(np.int64).tolist()):
                    slots = [v for k in range(s, s + n) for v in place.get(k, ())] if n < EXACT else []
                    for column, v in zip(out, (i, s, n, x, slots, total)):
                        column.append(v)
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(c, pa.int64()) for c in out[:4]], pa.array(out[4], pa.list_(pa.string())), pa.array(out[5], pa.int64())], names=[c.split()[0] for c in _WINDOW.split(", ")]
            )
        hasher.known.clear()
        trim()

    return df.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text")).where("id is not null").mapInArrow(run, _WINDOW)


def contaminated(
    docs: DataFrame, benchmark: DataFrame, window: int = 8, min_share: float = 0.5, min_words: int = 5,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """One row per document and benchmark item found in it: doc_id, item_id, share, same_slots.

    Numbers, names and units become typed placeholders; windows of `window` template words
    are joined by hash.  Windows of an item that lie at the same distance in a document
    belong together; they count if the slots are consistent, that is, if each slot value
    of the item stands for one value in the document.  Where a value stands for itself in
    some windows and for others elsewhere, just the windows of the others don't count;
    where it stands for several others, none does.  An item all of whose windows are
    placeholders for more than half is compared word by word.  The item is found if `min_share` of its windows match so;
    `same_slots` tells whether no value was changed in these.

    Tasks drop windows that no item has by a filter of fixed size, so few reach the join,
    which is exact; whether the join is broadcast Spark decides by the items' size.

    Edge cases: null and empty texts have no windows; an item shorter than a window is one
    window of its length, and one below `min_words` words is never looked for; rows with a
    missing id are not looked at; rows that share an id count as one document; an empty
    table on either side gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    items = written(_rows(benchmark, item_col, item_text_col, window, None, None).where(F.col("size") % EXACT >= min_words), "items")
    allowed = spark.sparkContext.broadcast(filter_of(items, "h"))
    short = [r["size"] for r in items.select((F.col("size") % EXACT).alias("size")).distinct().collect()]  # at most `window` different sizes
    found = _rows(docs, id_col, text_col, window, short or [window], allowed)
    met = found.select(F.col("id").alias("doc_id"), "pos", "size", "h", F.col("slots").alias("theirs")).join(
        items.select(F.col("id").alias("item_id"), F.col("pos").alias("at"), "size", "h", F.col("slots").alias("own"), "total"), ["h", "size"]
    )
    met = written(met.where(F.size("own") == F.size("theirs")).withColumn("offset", F.col("pos") - F.col("at")), "met")  # texts are read once
    pair = ["doc_id", "item_id", "offset"]
    slots = met.select(*pair, "at", F.explode(F.arrays_zip("own", "theirs")).alias("s")).select(*pair, "at", "s.own", "s.theirs")
    ways = slots.groupBy(*pair, "own").agg((F.min("theirs") != F.max("theirs")).alias("several"), F.max(F.col("own") == F.col("theirs")).alias("itself"))
    ways = ways.where("several").select(*pair, "own", "itself")
    off = slots.join(ways, [*pair, "own"]).where("not itself or theirs <> own").select(*pair, F.when(F.col("itself"), F.col("at")).alias("at")).distinct()
    whole = off.where("at is null").select(*pair)
    sound = met.withColumn("same", F.forall(F.arrays_zip("own", "theirs"), lambda x: x["own"] == x["theirs"])).join(off, [*pair, "at"], "left_anti").join(whole, pair, "left_anti")
    good = sound.groupBy(*pair).agg(F.countDistinct("at").alias("n"), F.first("total").alias("total"), F.min("same").alias("same"))
    return (
        good.select("doc_id", "item_id", (F.col("n") / F.col("total")).alias("share"), F.coalesce("same", F.lit(True)).alias("same_slots"))
        .where(F.col("share") >= min_share)
        .groupBy("doc_id", "item_id")
        .agg(F.max("share").alias("share"), F.max("same_slots").alias("same_slots"))
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **settings) -> DataFrame:
    """The rows of `docs` in which no benchmark item is found, with all their columns.

    Edge cases: null and empty texts stay; rows that share an id go together if any of
    them holds an item; rows with a missing id stay; an empty table gives no rows; other
    columns go along unread.
    """
    hit = written(contaminated(docs, benchmark, id_col=id_col, **settings).select(F.col("doc_id").alias("__hit")).distinct(), "hits")
    return docs.join(hit, F.col(id_col).cast("long") == F.col("__hit"), "left_anti")
