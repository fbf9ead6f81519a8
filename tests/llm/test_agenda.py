"""The array agenda and its heap against the library, and the rounds of the near-copy stage against all pairs."""

import random

import numpy as np

from pelagia.llm import near_dedup, sp_tokens
from pelagia.llm.queries import piece_model


def test_agenda_equals_library(monkeypatch):
    random.seed(4)
    letters = "abcdehilnorstu éßж中🙂́'.-0123456789"
    words = ["".join(random.choices(letters.replace(" ", ""), k=random.choice([1, 2, 5, 9, 40, 300]))) for _ in range(2_000)]
    words += ["a" * 5_000, "internationalisation" * 400, "🙂" * 70, "\x00x", "the"]
    enc = sp_tokens.MergeEncoder(piece_model())
    theirs = [np.array(i, enc.kind).tobytes() for i in enc.library.encode(words)]
    for rounds in (0, 3, sp_tokens.ROUNDS, 10_000):
        monkeypatch.setattr(sp_tokens, "ROUNDS", rounds)
        assert enc.merge([sp_tokens.SPACE + w for w in words]) == theirs, rounds
    texts = ["", " ", "  a  b ", "one two  three", " ".join(words), "▁x ▁"]
    assert enc.encode(texts) == [[*i, enc.end] for i in enc.library.encode(texts)]


def test_large_group_without_common_representative(spark):
    """Copies of a text with one word changed link to those changed nearby only; the group must be whole."""
    random.seed(5)
    base = [f"w{random.randrange(10_000)}" for _ in range(70)]
    texts = []
    for k in range(300):
        t = list(base)
        t[random.randrange(70)] = f"c{k}"
        t[random.randrange(70)] = f"d{k % 7}"
        texts.append(" ".join(t))
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in map(str.split, texts)]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    linked = set()
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if len(a & b) >= 0.8 * len(a | b) - 1e-12:
                linked |= {i, j}
                x, y = sorted((find(i), find(j)))
                root[y] = x
    want = {i: find(i) for i in linked}
    got = {r.doc_id: r.root for r in near_dedup.near_groups(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert len(set(want.values())) > 1 and got == want
