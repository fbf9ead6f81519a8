"""SentencePiece merges: an agenda of adjacent symbol pairs in the order of their scores."""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pelagia.llm.common import slices, text_of, trim

SPACE = "▁"
#: Characters of the words that a worker keeps encoded, in each of two halves (some 25 MB); when the newer is full it becomes the older.
CACHE_CHARS = 2_000_000
#: Characters of the texts that are encoded at once.
SLICE_CHARS = 1_000_000
#: Merges that all words of a batch take side by side, one a round; a word with more goes on alone.
ROUNDS = 32
_RUNS = re.compile(r" +[^ ]*")
#: A pair of symbols as one number is left << SHIFT | right; symbols are below 1 << SHIFT.
SHIFT = 22
#: Place in the agenda of a pair that doesn't merge.
NEVER = 1 << 30


class MergeEncoder:
    """Encodes text with the vocabulary of a merge-type SentencePiece model.

    The vocabulary (pieces and scores) comes from the library; the merging is done here:
    an agenda holds the adjacent pairs of symbols whose piece is in the vocabulary, the
    one with the highest score merges first, the leftmost of equals.  No piece holds a
    space mark after another character, so merges never cross from one word into the next
    and words are encoded by themselves and remembered.

    The agendas of a batch's new words lie side by side in arrays; each round takes the
    first pair of every word, merges it and enters the pairs that this makes.  A word with
    more than ROUNDS merges goes on from there with its agenda as a heap, so the work is
    linear in its length but for the heap's logarithm.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.library.vocab_size()
        self.pieces = {}
        scores = {}
        for i in range(n):
            piece = self.library.id_to_piece(i)
            if not (self.library.is_control(i) or self.library.is_unknown(i) or self.library.is_byte(i) or self.library.is_unused(i)):
                self.pieces[piece] = i
                scores[piece] = self.library.get_score(i)
        if any(SPACE in p.lstrip(SPACE) for p in self.pieces):
            raise ValueError("a piece crosses words; this encoder splits at spaces")
        ranks = {s: r for r, s in enumerate(sorted(set(scores.values()), reverse=True))}
        self.bytes = [self.library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.unknown, self.end = self.library.unk_id(), self.library.eos_id()
        self.byte_fallback = all(self.library.is_byte(i) for i in self.bytes)
        self.kind = np.uint16 if n <= 1 << 16 else np.uint32
        self.text_of = list(map(str, range(n)))
        # Symbols: the pieces, the characters that they are made of, and any other character behind these by its code point.
        self.strings = [*self.pieces, *sorted({c for p in self.pieces for c in p} - self.pieces.keys())]
        self.others = len(self.strings)
        numbers = {s: k for k, s in enumerate(self.strings)}
        self.symbol = np.arange(self.others, self.others + 0x110000, dtype=np.int64)
        for c in filter(lambda c: len(c) == 1, self.strings):
            self.symbol[ord(c)] = numbers[c]
        self.into = {
            numbers[p[:k]] << SHIFT | numbers[p[k:]]: numbers[p] for p in self.pieces for k in range(1, len(p)) if p[:k] in numbers and p[k:] in numbers
        }
        self.place = [ranks[scores[p]] for p in self.pieces]
        self.ids = np.array(list(self.pieces.values()), self.kind)
        keys = sorted(self.into)
        self.pairs = np.array([*keys, 1 << 62], np.int64)
        self.merged = np.array([*(self.into[k] for k in keys), 0], np.int64)
        self.places = np.array([*(self.place[self.into[k]] for k in keys), NEVER], np.int64)
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.kept = 0

    def piece_ids(self, piece: str) -> list[int]:
        """The id of a piece; of a character that the vocabulary lacks those of its bytes."""
        found = self.pieces.get(piece)
        return [found] if found is not None else [self.bytes[b] for b in piece.encode()] if self.byte_fallback else [self.unknown]

    def _encoded(self, row: list[int]) -> bytes:
        """The ids of symbols, some of which may be no pieces."""
        string = lambda s: self.strings[s] if s < self.others else chr(s - self.others)
        return np.array([i for s in row for i in self.piece_ids(string(s))], self.kind).tobytes()

    def _pair(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place in the agenda, and symbol that the two merge into, of pairs of symbols."""
        key = left << SHIFT | right
        at = np.searchsorted(self.pairs, key)
        return np.where(self.pairs[at] == key, self.places[at], NEVER), self.merged[at]

    def merge_alone(self, row: list[int]) -> list[int]:
        """The symbols of one word after all merges, by an agenda that is a heap."""
        into, place, n = self.into, self.place, len(row)
        agenda = [place[m] << 32 | i for i in range(n - 1) if (m := into.get(row[i] << SHIFT | row[i + 1])) is not None]
        heapify(agenda)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while agenda:
            top = heappop(agenda)
            left = top & 0xFFFFFFFF
            if row[left] is None or (right := after[left]) == n:
                continue
            new = into.get(row[left] << SHIFT | row[right])
            if new is None or place[new] << 32 | left != top:
                continue  # one of the two has changed meanwhile
            row[left], row[right] = new, None
            after[left] = right = after[right]
            if right < n:
                before[right] = left
                if (m := into.get(new << SHIFT | row[right])) is not None:
                    heappush(agenda, place[m] << 32 | left)
            back = before[left]
            if back >= 0 and (m := into.get(row[back] << SHIFT | new)) is not None:
                heappush(agenda, place[m] << 32 | back)
        return [s for s in row if s is not None]

    def merge(self, words: list[str]) -> list[bytes]:
        """The ids of each word, none of them empty, after all merges."""
        out: list[bytes] = [b""] * len(words)
        word, size = np.arange(len(words)), np.array(list(map(len, words)), np.int64)
        row = self.symbol[np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)]
        place, new = np.full(len(row), NEVER, np.int64), np.zeros(len(row), np.int64)
        place[:-1], new[:-1] = self._pair(row[:-1], row[1:])
        place[np.cumsum(size) - 1] = NEVER  # the last of a word has no right neighbour
        for k in range(ROUNDS + 1):
            if not len(word):
                break
            first = np.cumsum(size) - size
            top = np.minimum.reduceat(place << 32 | np.arange(len(row)), first)
            left = top & 0xFFFFFFFF
            more = place[left] != NEVER
            if k == ROUNDS and more.any():
                for w, a, n in zip(word[more].tolist(), first[more].tolist(), size[more].tolist()):
                    out[w] = self._encoded(self.merge_alone(row[a : a + n].tolist()))
            self._put(out, word[~more], row[np.repeat(~more, size)], size[~more])
            if k == ROUNDS:
                break
            left, stays = left[more], np.repeat(more, size)
            row[left] = new[left]
            last = first[more] + size[more] - 1
            ends, starts = left + 1 == last, left == first[more]
            stays[left + 1] = False
            row, place, new = row[stays], place[stays], new[stays]
            left = (np.cumsum(stays) - 1)[left]
            word, size = word[more], size[more] - 1
            place[left[ends]] = NEVER
            for at in (left[~ends], left[~starts] - 1):
                place[at], new[at] = self._pair(row[at], row[at + 1])
        return out

    def _put(self, out: list[bytes], word: np.ndarray, row: np.ndarray, size: np.ndarray) -> None:
        """Enters the ids of finished words."""
        if not len(word):
            return
        known = row < len(self.ids)
        width, blob = np.dtype(self.kind).itemsize, self.ids[np.where(known, row, 0)].tobytes()
        end = np.cumsum(size)
        for w, a, b in zip(word.tolist(), ((end - size) * width).tolist(), (end * width).tolist()):
            out[w] = blob[a:b]
        first = end - size
        for k in np.flatnonzero(~np.logical_and.reduceat(known, first)).tolist():
            out[int(word[k])] = self._encoded(row[first[k] : end[k]].tolist())

    @staticmethod
    def split(text: str) -> list[str]:
        """The words of a text; further spaces before a word are marks that belong to it."""
        if not text:
            return []
        if SPACE in text:
            text = text.replace(SPACE, " ")
        parts = text.split(" ")
        return [w[1:].replace(" ", SPACE) for w in _RUNS.findall(" " + text)] if "" in parts else parts

    def _learn(self, new: list[str], check: bool) -> None:
        found = self.merge([SPACE + w for w in new]) if new else []
        if check and new:  # but the mark alone, which the library gives for the space at a text's end only
            own = [a for w, a in zip(new, found) if w]
            theirs = self.library.encode([w for w in new if w], num_threads=1)
            width, flat = np.dtype(self.kind).itemsize, np.fromiter(chain.from_iterable(theirs), self.kind)
            if [len(a) // width for a in own] != list(map(len, theirs)) or flat.tobytes() != b"".join(own):
                wrong = next(w for w, a, b in zip(filter(None, new), own, theirs) if a != np.array(b, self.kind).tobytes())
                raise ValueError(f"the library encodes {wrong[:80]!r} otherwise")
        self.words.update(zip(new, found))
        self.kept += sum(map(len, new))

    def encode(self, texts: list[str], check: bool = True) -> list[list[int]]:
        """Ids of each text, with the end id.  With `check` the library encodes every word that isn't remembered too, and a difference raises an error."""
        split = list(map(self.split, texts))
        if self.kept > CACHE_CHARS:  # what is still in use comes back from the older half
            self.older, self.words, self.kept = self.words, {}, 0
        new = set().union(*split) - self.words.keys()
        back = new & self.older.keys()
        for w in back:
            self.words[w] = self.older[w]
            self.kept += len(w)
        self._learn(list(new - back), check)
        get = self.words.__getitem__
        return [[*np.frombuffer(b"".join(map(get, s)), self.kind).tolist(), self.end] for s in split]

    def forget(self) -> None:
        """Drops the words remembered, which a worker would hold on to through whatever runs in it next."""
        self.words, self.older, self.kept = {}, {}, 0

    def joined(self, ids: list[int]) -> str:
        return " ".join(map(self.text_of.__getitem__, ids))


@lru_cache(maxsize=2)
def encoder(path: str) -> MergeEncoder:
    """One encoder per Python worker; its words stay between tasks, within the bounds above, unless they are forgotten."""
    return MergeEncoder(path)


def _portions(batches):
    """Slices of Arrow batches with at most SLICE_CHARS characters, or one text."""
    for batch in slices(batches):
        texts = batch.column(1).to_pylist()
        at = size = 0
        for k, t in enumerate(texts):
            if size and size + len(t) > SLICE_CHARS:
                yield batch.column(0).slice(at, k - at), texts[at:k]
                at, size = k, 0
            size += len(t)
        if at < len(texts):
            yield batch.column(0).slice(at), texts[at:]


def encode(docs: DataFrame, model_path: str, check: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, ids array<int>, n_tokens, decoded text.

    Ids are those of the sentencepiece library with an end id and no sampling; `decoded`
    is what the library's decode gives for them.  With `check`, the library encodes each
    word too when a worker meets it and doesn't remember it, by batches, and a difference
    raises an error; words are encoded one by one, so that covers the texts.

    Edge cases: a null text is the empty one, whose only id is the end id; texts of any
    length and words without spaces are encoded whole; a missing id stays missing and
    repeated rows get equal results; an empty table gives no rows; other columns are not
    read.  The model file must exist on every executor.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))

    def run(batches):
        enc = encoder(model_path)
        for keys, texts in _portions(batches):
            ids = enc.encode(texts, check)
            yield pa.RecordBatch.from_arrays(
                [keys, pa.array(ids, pa.list_(pa.int32())), pa.array(list(map(len, ids)), pa.int64()), pa.array([enc.library.decode(i) for i in ids], pa.string())],
                names=["doc_id", "ids", "n_tokens", "decoded"],
            )
        enc.forget()
        trim()

    return rows.mapInArrow(run, "doc_id long, ids array<int>, n_tokens long, decoded string")


def encode_digests(docs: DataFrame, model_path: str, check: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: `encode` with digests for the long columns, and its edge cases."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))

    def run(batches):
        enc = encoder(model_path)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        for keys, texts in _portions(batches):
            ids = enc.encode(texts, check)
            yield pa.RecordBatch.from_arrays(
                [
                    keys,
                    pa.array(list(map(len, ids)), pa.int64()),
                    pa.array([sha(enc.joined(i)) for i in ids], pa.string()),
                    pa.array([sha(enc.library.decode(i)) for i in ids], pa.string()),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )
        trim()

    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
