"""Exact copies without Python workers, near copies linked by fingerprints first, words that no worker keeps."""

import random

from pyspark.sql import functions as F

import corpus_pipeline
from pelagia.llm import exact_dedup, near_dedup, queries, simhash, sp_tokens

SF = "/root/testdata/sf0.001"


def test_exact_copies_need_no_python_and_lower_ascii_only(spark):
    texts = ["ÄBC", "äbc", "ÄbC", "İx", "i̇x", "Straße", "STRASSE", "straße", "ΣΑΣ", "abc", "ABC", None, "", "K", "k"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = exact_dedup.keep_one(df)
    assert "EvalPython" not in kept._jdf.queryExecution().optimizedPlan().toString()
    want = {}
    for i, t in enumerate(texts):
        want.setdefault((t or "").encode().lower(), i)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(want.values())
    got = exact_dedup.duplicate_groups(df)
    assert {r.doc_id: r.keep_id for r in got.collect()} == {i: want[(t or "").encode().lower()] for i, t in enumerate(texts)}


def test_fingerprints_link_near_copies_before_shingles_meet(spark, monkeypatch):
    r = random.Random(6)
    base = [f"w{r.randrange(5000)}" for _ in range(600)]
    rows = [(k, " ".join([*base[:300], f"x{k % 3}", *base[301:]])) for k in range(40)] + [(50 + k, " ".join(r.sample(base, 500))) for k in range(9)] + [(90, ""), (91, None), (92, " \n")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    pairs = {tuple(x) for x in near_dedup.fingerprint_pairs(df.select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text"))).collect()}
    prints = {i: simhash.simhash(simhash.shingle_hashes(t or "", 3)) for i, t in rows}
    assert {tuple(sorted(p)) for p in pairs} and all((prints[a] ^ prints[b]).bit_count() <= 2 or (prints[a] ^ prints[b]) & (2**64 - 1) == 0 for a, b in pairs)
    assert len({b for a, b in pairs} | {a for a, b in pairs}) >= 13 and not {i for p in pairs for i in p} & {90, 91, 92}
    seen = []
    monkeypatch.setattr(near_dedup.simhash, "links", lambda *a, f=simhash.links: seen.append(1) or f(*a))
    kept = corpus_pipeline.drop_near_copies(spark, df, SF)
    assert sorted(x.doc_id for x in kept.collect()) == [0, *range(50, 59), 90, 91, 92] and seen


def test_words_are_forgotten_after_a_task():
    enc = sp_tokens.encoder(queries.piece_model())
    first = enc.encode(["some words of a text"])
    assert enc.words
    enc.forget()
    assert not enc.words and not enc.older and enc.encode(["some words of a text"]) == first
