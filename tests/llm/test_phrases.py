"""Collocations against brute force: cuts, containment, ties, shards, long and missing texts."""

import random
import re
from collections import Counter, defaultdict

import pytest

from pelagia.llm import phrases

SCHEMA = "doc_id long, text string, lang string, phrase string, n int"


def brute(rows, least, most, share, top):
    f, n = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i : i + k])) for k in range(1, most + 1) for i in range(len(w) - k + 1))
    found = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    out = defaultdict(list)
    for (lang, p), a in found.items():
        if any(m == lang and len(q) > len(p) and 100 * b >= share * a and any(q[i : i + len(p)] == p for i in range(len(q))) for (m, q), b in found.items()):
            continue
        score, _, l, r = min((10**6 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
        out[lang].append((-score, -a, " ".join(p).encode(), l, r))
    return sorted((lang, i, p.decode(), -a, l, r, n[lang], -s) for lang, ps in out.items() for i, (s, a, p, l, r) in enumerate(sorted(ps)[:top], 1))


def rows_of(seed, n=250):
    r = random.Random(seed)
    words = ["a", "B", "b", "c", "é", "ß", "中文", "d e", "x\x00y", "z"]
    seps = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "\x0b", "; ", "!?", "\x85", " "]
    rows = [(i, "".join(r.choice(words) + r.choice(seps) for _ in range(r.randint(0, 60))), r.choice(["en", "en", "fr", None, ""]), "q", 1) for i in range(n)]
    return rows + [(None, None, "en", "q", 1), (3, "", None, "q", 1), (4, " ... ", "de", "q", 1)] + [rows[5]] * 7


@pytest.mark.parametrize("least, most, shards", [(10, 3, 3), (4, 4, 2), (7, 2, 1), (1, 3, 5)])
def test_collocations_equal_brute_force(spark, monkeypatch, least, most, shards):
    monkeypatch.setattr(phrases, "CHUNK", 50 if shards == 2 else 4000)
    rows = rows_of(least) + [(9, "x\x00y Q. x\x00y q", "en", "q", 1)] * 6
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = sorted(tuple(r) for r in phrases.collocations(df, least, most, 50, 40, shards).collect())
    assert got == brute(rows, least, most, 50, 40) and got


def test_long_text_one_word_and_empty_table(spark):
    rows = [(1, "Alpha beta " * 300_000, "en", "", 0), (2, "alpha. beta", "en", "", 0)]
    got = [tuple(r) for r in phrases.collocations(spark.createDataFrame(rows, SCHEMA)).collect()]
    # Both three-word phrases hold the two-word ones nearly always, so those go.
    assert [(g[1], g[2], g[3]) for g in got] == [(1, "alpha beta alpha", 299_999), (2, "beta alpha beta", 299_999)]
    assert got[0][6] == 600_002
    assert phrases.collocations(spark.createDataFrame([], SCHEMA)).collect() == []


def test_products_beyond_64_bits(spark):
    big = 3_000_000_000
    counts = spark.createDataFrame([("en", "a b", 2, big), ("en", "a", 1, big + 1), ("en", "b", 1, 2 * big)], "lang string, phrase string, words int, f long")
    got = phrases._scored(counts, spark.createDataFrame([("en", 5 * big)], "lang string, n long")).first()
    assert got["score"] == 10**6 * big * big // ((big + 1) * 2 * big) == 499_999
