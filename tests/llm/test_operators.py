"""The training-data operators against brute force, and on awkward tables."""

import base64
import gzip
import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from pelagia.llm import decontam, exact_dedup, html_text, line_dedup, near_dedup, pii, quotes, simhash, sp_tokens, toxicity, warc
from pelagia.llm.common import components, filter_of, forest_roots
from pelagia.llm.queries import piece_model

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, h string, key int, id string, pos double"
#: Nulls, empty and blank texts, ties, repeated rows, clashing column names, a very long text.
ROWS = [
    (1, "Hello world, this is one.", "x", 1, "a", 0.5), (2, "hello WORLD, this is one.", None, None, None, None), (2, "hello WORLD, this is one.", None, None, None, None),
    (3, None, "x", 1, "a", 0.5), (4, "", "x", 1, "a", 0.5), (5, " \t\n ", "y", 2, "b", 1.5), (None, "No id here at all.", "y", 2, "b", 1.5),
    (None, "Hello world, this is one.", "y", 2, "b", 1.5), (7, "word " * 40_000, "z", 3, "c", 2.5), (8, "É Über straße\nÉ ÜBER STRASSE", "z", 3, "c", 2.5), (8, "same id, other text", "z", 3, "c", 2.5),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def lower(t):
    return (t or "").encode().lower().decode()


def sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


# exact dedup -----------------------------------------------------------------


def brute_groups(rows, keep):
    groups = defaultdict(list)
    for i, t in rows:
        groups[lower(t)].append(-(2**63) if i is None else i)
    out, used = Counter(), Counter()
    for i, t in rows:
        g, me = groups[lower(t)], -(2**63) if i is None else i
        k = keep(g)
        used[lower(t), me] += 1
        out[i, None if k == -(2**63) else k, len(g), me == k and used[lower(t), me] == 1, sha(lower(t))] += 1
    return out


@pytest.mark.parametrize("keep", ["min", "max"])
@pytest.mark.parametrize("weak", [False, True])
def test_exact_groups(spark, odd, keep, weak):
    args = {"content_hash": lambda b: hashlib.md5(b).digest()[:1][:0] + bytes([len(b) % 2])} if weak else {}
    got = Counter(tuple(r) for r in exact_dedup.duplicate_groups(odd, keep, **args).collect())
    assert got == brute_groups([r[:2] for r in ROWS], {"min": min, "max": max}[keep])


@pytest.mark.parametrize("weak", [False, True])
def test_exact_keep_one(odd, empty, weak):
    args = {"content_hash": lambda b: bytes([len(b) % 2])} if weak else {}
    kept = exact_dedup.keep_one(odd, "max", **args)
    assert kept.columns == odd.columns
    rows = [tuple(r) for r in kept.collect()]
    assert sorted(lower(r[1]) for r in rows) == sorted({lower(r[1]) for r in ROWS})
    assert all(r in ROWS for r in rows)
    assert (2, "hello WORLD, this is one.") in [r[:2] for r in rows] and (4, "") in [r[:2] for r in rows]
    assert exact_dedup.keep_one(empty).count() == 0 and exact_dedup.duplicate_groups(empty).count() == 0


# lines -----------------------------------------------------------------------


def brute_lines(rows, least=10, docs=2):
    strip = " \t\n\x0b\x0c\r"
    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            k = lower(line.strip(strip))
            if len(k) >= least:
                holders[k].add(i)
    out = Counter()
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = []
        for line in lines:
            k = lower(line.strip(strip))
            first = min([x for x in holders.get(k, ()) if x is not None], default=None)
            if not (len(holders.get(k, ())) >= docs and i != first):
                kept.append(line)
        out[i, len(lines), len(lines) - len(kept), "\n".join(kept)] += 1
    return out


def test_lines(spark, odd, empty):
    more = [(10, "a line that repeats\nshort\n  A LINE that Repeats\t\nown line of ten"), (11, "short\na line that repeats"), (12, "a line that repeats\n\nÉCOLE À PARIS\n"), (13, "école à paris\nÉCOLE À PARIS ")]
    rows = [r[:2] for r in ROWS] + more
    df = odd.select("doc_id", "text", "pos").unionByName(spark.createDataFrame(more, "doc_id long, text string"), allowMissingColumns=True)
    for k in (2, 3):
        assert Counter(tuple(r) for r in line_dedup.drop_repeated_lines(df, min_docs=k).collect()) == brute_lines(rows, docs=k)
    assert line_dedup.drop_repeated_lines(empty).count() == 0


# tokens ----------------------------------------------------------------------


def test_tokens_equal_library(odd, docs, empty):
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    df = docs.select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    rows = sp_tokens.encode(df, piece_model(), check=True).collect()
    texts = [r["text"] or "" for r in df.collect()]
    assert Counter((r["doc_id"], tuple(r["ids"]), r["decoded"], r["n_tokens"]) for r in rows) == Counter(
        (r["doc_id"], tuple(ids := lib.encode(t, add_eos=True)), lib.decode(ids), len(ids)) for r, t in zip(df.collect(), texts)
    )
    digests = {r["doc_id"]: r for r in sp_tokens.encode_digests(docs, piece_model(), check=True).collect()}
    one = docs.first()
    ids = lib.encode(one["text"], add_eos=True)
    assert digests[one["doc_id"]]["ids_sha256"] == sha(" ".join(map(str, ids))) and digests[one["doc_id"]]["decoded_sha256"] == sha(lib.decode(ids))
    assert sp_tokens.encode(empty, piece_model()).count() == 0


def test_agenda_on_odd_strings():
    import random

    enc = sp_tokens.MergeEncoder(piece_model())
    rng = random.Random(3)
    for n in [*[rng.randint(0, 120) for _ in range(1500)], 20_000]:
        s = "".join(rng.choice("ab e▁é\n\t日本😀<>sthenr   ") for _ in range(n))
        assert enc.encode([s])[0] == enc.library.encode(s, add_eos=True)


# fingerprints ----------------------------------------------------------------


def brute_simhash(t, k):
    import xxhash

    words = re.findall(rb"[^\x20\x09-\x0d]+", lower(t).encode())
    shingles = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_simhash_components(spark, odd, docs, empty):
    df = odd.select("doc_id", "text").unionByName(docs.select((F.col("doc_id") + 100).alias("doc_id"), "text"))
    rows = [(r[0], r[1]) for r in df.collect()]
    fps = [brute_simhash(t, 3) for _, t in rows]
    distinct = sorted(set(fps))
    at = roots(distinct, [(a, b) for i, a in enumerate(distinct) for b in distinct[i + 1 :] if (a ^ b).bit_count() <= 2])
    low = {}
    for (i, _), f in zip(rows, fps):
        if i is not None:
            low[at[f]] = min(low.get(at[f], i), i)
    want = Counter((i, f"{f:016x}", low.get(at[f])) for (i, _), f in zip(rows, fps))
    assert Counter(tuple(r) for r in simhash.simhash_components(df).collect()) == want
    assert simhash.simhash_components(empty).count() == 0


def test_links_are_all_pairs(spark):
    import random

    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(30)]
    fps = set(base)
    for b in base:
        for _ in range(8):
            fps.add(b ^ sum(1 << k for k in rng.sample(range(64), rng.randint(1, 4))))
    signed = {f - (f >> 63 << 64): f for f in fps}
    df = spark.createDataFrame([(s,) for s in signed], "fp long")
    for d in (0, 1, 2, 3):
        got = {tuple(r) for r in simhash.links(df, d).collect()}
        assert got == {(a, b) for a in signed for b in signed if a < b and (signed[a] ^ signed[b]).bit_count() <= d}


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 200), (200, 300), (300, 100), (500, 500)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 200: 100, 300: 100}


def test_forest_roots(spark):
    parents = [(i, i - 1) for i in range(1, 40)] + [(101, 100), (102, 100), (103, 102)]
    got = {r["node"]: r["root"] for r in forest_roots(spark.createDataFrame(parents, "n long, p long"), "n", "p").collect()}
    assert got == {**{i: 0 for i in range(1, 40)}, 101: 100, 102: 100, 103: 100}
    assert forest_roots(spark.createDataFrame([], "n long, p long"), "n", "p").count() == 0


def test_near_groups(spark, empty):
    import random

    rng = random.Random(9)
    rows, words = [], [f"w{k}" for k in range(400)]
    for g in range(6):
        text = [rng.choice(words) for _ in range(150)]
        for k in range(9):
            copy = list(text)
            for _ in range(k):
                copy[rng.randrange(150)] = rng.choice(words)
            rows.append((g * 100 + k, " ".join(copy)))
    rows += [(9000, None), (9001, "a b"), (9002, "A b"), (None, rows[0][1])]
    sets = {i: set(simhash.shingle_hashes(t or "", 5).tolist()) for i, t in rows if i is not None}
    ids = sorted(sets)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    at = roots(ids, links)
    assert len(links) > 20
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("root", F.lit("clash"))
    got = {r["doc_id"]: r["root"] for r in near_dedup.near_groups(df).collect()}
    linked = {x for p in links for x in p}
    assert got == {i: at[i] for i in linked}
    kept = near_dedup.keep_one(df)
    assert kept.columns == df.columns and sorted(r[0] for r in kept.collect() if r[0] is not None) == [i for i in ids if at[i] == i]
    assert near_dedup.keep_one(empty).count() == 0


# personal data ---------------------------------------------------------------


def test_base_spans():
    t = "é a.b+c@x-y.example.com, 1.2.3.4 1.2.3.256 4111 1111 1111 1111 4111111111111112 +1 (017) 555-7713 +12 34"
    got = [(k, t[a:b]) for a, b, k in pii.base_spans(t)]
    assert got == [("email", "a.b+c@x-y.example.com"), ("ip", "1.2.3.4"), ("phone", "+1 (017) 555-7713")]  # the digits from 256 on are one run of the card pattern, too long for a card
    for a, b, k in pii.base_spans(t):
        assert pii.BASE[k].fullmatch(t[a:b])


def test_pii_query(spark, odd, docs, empty):
    field = pii.fit(docs)
    rows = {r["doc_id"]: r for r in pii.personal_data(docs, field).collect()}
    assert sum(r["n_email"] + r["n_ip"] + r["n_card"] + r["n_phone"] for r in rows.values()) > 5
    for d in docs.collect():
        spans = []
        for kind, p in pii.BASE.items():
            spans += [(m.start(), m.end(), kind) for m in p.finditer(d["text"] or "") if pii._valid(kind, m.group())]
        r = rows[d["doc_id"]]
        text = ",".join(f"{k}:{a}:{b}" for a, b, k in sorted(spans, key=lambda s: (s[0], pii.KINDS.index(s[2]))))
        assert r["base_sha256"] == sha(text)
        assert set(filter(None, text.split(","))) <= set(filter(None, r["spans"].split(",")))
    assert pii.personal_data(odd, field).count() == len(ROWS)
    assert pii.personal_data(empty).count() == 0


def test_field_adds_variants():
    field = pii.SegmentField().train(pii.generated())
    found = lambda t: [(k, t[a:b]) for a, b, k in sum(pii.all_spans(t, field), [])]
    assert found("call (017) 555-7713 now") == [("phone", "(017) 555-7713")]
    assert found("card 4111.1111.1111.1111 ok") == [("card", "4111.1111.1111.1111")]
    held = pii.generated(400, seed=99)
    hits = sum(bool(gold) == bool(sum(pii.all_spans(r, field), [])) for r, gold in held)
    assert hits / len(held) > 0.93
    for clean in ("in 2021 there were 1,234,567 of 12 345", "version 1.2.3 of 4711", "0123456789abcdef0123456789abcdef"):
        assert found(clean) == []


# toxicity --------------------------------------------------------------------


def test_decoding_restores_words():
    text = Counter("you are an idiot and a moron that is pathetic stupid trash loser the of this".split() * 50)
    model = toxicity.CharModel(dict(toxicity.trigrams(text)))
    for hidden, word in (("1d10t", "idiot"), ("i d i o t", "idiot"), ("m0r0n", "moron"), ("p@th3t1c", "pathetic"), ("stuuuuupid", "stupid"), ("l.o.s.e.r", "loser"), ("tr4$h", "trash")):
        assert model.decode(hidden) == word
    assert toxicity.suspicious("this is clean text".split(), "this is clean text") == set()
    assert "1d10t" in toxicity.suspicious("you 1d10t!".split(), "you 1d10t!")


def test_toxicity_held_out(spark, odd, empty):
    import zlib

    d = "/root/testdata/sf0.01"
    df, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    out = toxicity.toxicity(df, labels)
    rows = out.join(labels, "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in rows)
    held = [r for r in rows if r["held_out"]]
    pairs = [(a["score"] > b["score"]) + 0.5 * (a["score"] == b["score"]) for a in held if a["toxic"] for b in held if not b["toxic"]]
    assert sum(pairs) / len(pairs) > 0.75
    assert toxicity.toxicity(odd, labels).count() == len(ROWS)
    assert toxicity.drop_toxic(odd, labels).columns == odd.columns
    assert toxicity.toxicity(empty, labels.limit(0)).count() == 0
    assert toxicity.toxicity(odd, labels.limit(0)).count() == len(ROWS)


# archives --------------------------------------------------------------------


def test_archive_round_trip(spark, tmp_path):
    rows = [(3, "http://a", "same é"), (1, "http://b\r\nX: y", "same é"), (2, None, None), (5, "u", ""), (4, "v", "WARC/1.1\r\n\r\nnot a record\r\n\r\n"), (4, "v", "WARC/1.1\r\n\r\nnot a record\r\n\r\n"), (None, "n", "lone"), (9, "w", "x" * 100_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("key", F.lit("clash"))
    for codec in ("gzip", "none"):
        path = str(tmp_path / codec)
        warc.write_archive(df, path, compression=codec, records_per_file=3)
        read = warc.read_archives(spark, path)
        assert read.where("kind = 'gap'").count() == 0
        first = {}
        for i, _, h in rows:
            first[h or ""] = min(first.get(h or "", 99), -1 if i is None else i)
        want = Counter()
        for i, _, h in rows:
            b = (h or "").encode()
            f = first[h or ""]
            again = (-1 if i is None else i) != f
            want[i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if again else "response", f if again else None] += 1
        assert Counter(tuple(r) for r in warc.page_records(read).collect()) == want
        payloads = {bytes(r["payload"]) for r in read.where("type = 'response'").collect()}
        assert payloads == {(h or "").encode() for _, _, h in rows}
    path = str(tmp_path / "least")
    warc.write_archive(df, path, min_revisit_bytes=10)
    assert warc.read_archives(spark, path).where("type = 'revisit'").count() == 0
    path = str(tmp_path / "void")
    warc.write_archive(df.limit(0), path)
    assert warc.read_archives(spark, path).count() == 0


def record(i, payload=b"hello", kind="response", digest=None):
    digest = digest or warc.sha1_base32(payload)
    return b"WARC/1.1\r\nWARC-Type: %s\r\nWARC-Record-ID: <urn:page:%d>\r\nWARC-Payload-Digest: sha1:%s\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (kind.encode(), i, digest.encode(), len(payload), payload)


def ids(data):
    return [int(re.search(r"\d+", f["record_id"])[0]) for k, _, _, _, f in warc.salvage(data) if k == "record"]


def gaps(data):
    return [(a, b) for k, a, b, _, _ in warc.salvage(data) if k == "gap"]


def test_salvage():
    a, b, c = record(1), record(2, b"two"), record(3, b"three\nWARC/1.1\r\nnot one")
    assert ids(a + b + c) == [1, 2, 3] and gaps(a + b + c) == []
    # A wrong length, a wrong digest, a torn header and a cut end each cost just their record.
    bad = b.replace(b"Content-Length: 3", b"Content-Length: 999")
    assert ids(a + bad + c) == [1, 3] and gaps(a + bad + c) == [(len(a), len(a + bad))]
    assert ids(a + record(2, digest="A" * 32) + c) == [1, 3]
    assert ids(a + b"WARC/1.1\r\nbroken line\r\n\r\n" + c) == [1, 3]
    assert ids(a + b + c[:-9]) == [1, 2]
    assert gaps(b"junk\n" + a) == [(0, 5)]
    # Gzip members, one per record: a flipped byte costs one member.
    z = [gzip.compress(x, mtime=0) for x in (a, b, c)]
    assert ids(b"".join(z)) == [1, 2, 3]
    broken = bytearray(z[1])
    broken[14] ^= 0xFF
    data = z[0] + bytes(broken) + z[2]
    assert ids(data) == [1, 3] and gaps(data) == [(len(z[0]), len(z[0] + z[1]))]
    assert ids(z[0] + b"garbage" + z[1]) == [1, 2] and gaps(z[0] + b"garbage" + z[1]) == [(len(z[0]), len(z[0]) + 7)]
    # A member of many records that breaks off keeps the records before the damage.
    import random

    rng = random.Random(1)
    many = [record(k, rng.randbytes(3000)) for k in range(200)]
    member = gzip.compress(b"".join(many), mtime=0)
    got = ids(member[: len(member) // 2] + z[2])
    assert got[-1] == 3 and got[:-1] == list(range(len(got) - 1)) and len(got) > 50
    assert ids(b"") == [] and ids(a + z[1] + c) == [1, 2, 3]


def test_reader_logs_gaps(spark, tmp_path):
    (tmp_path / "x.warc.gz").write_bytes(gzip.compress(record(1)) + b"\x1f\x8b\x08 not gzip" + gzip.compress(record(2)))
    rows = warc.read_archives(spark, str(tmp_path)).collect()
    assert Counter(r["kind"] for r in rows) == {"record": 2, "gap": 1}


# pages -----------------------------------------------------------------------

PAGE = """<html><head><title>T</title><style>p{}</style></head><body class="no-sidebar"><header>Site</header><nav><a href=x>Home</a></nav><div class="cookie-notice">We use cookies</div>
<div id="content"><h1>Title</h1><p>First paragraph with <b>bold</b>ness &amp; a few more words to be long enough.<p>Short.<div class="ad">Buy</div><p>Another   paragraph
of decent length.<ul><li>one<li>two</ul><script>var t="</p>";</script></div><aside>Side</aside><section id="comments"><div class="comment"><p>Nice post, a long comment here and everywhere.</div></section><form>Name</form><footer>(c)</footer>"""


def test_article_text(spark, empty):
    want = "Title First paragraph with boldness & a few more words to be long enough. Short. Another paragraph of decent length. one two"
    assert html_text.main_text(PAGE) == want
    assert html_text.main_text(PAGE.replace('<div id="content">', "<main><article>").replace("</script></div>", "</script></article></main>")) == want
    assert html_text.main_text("") == "" and html_text.main_text("<nav>x</nav>") == "" and html_text.main_text("plain text") == "plain text"
    assert html_text.main_text("<p>a<br>b</p><td>c") == "a b c"
    assert html_text.main_text('<div class="layout sidebar-right"><p>All of the text.</p></div><footer>x</footer>') == "All of the text."
    rows = [(1, "u", PAGE), (2, None, None), (None, "v", ""), (3, "w", "<p>" + "long " * 30_000), (3, "w", "<article>x</article>")]
    got = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1))).collect()
    assert len(got) == 5 and {r["n_chars"] for r in got} >= {0, len(want), 1} and all(r["n_chars"] == len(r["text"]) for r in got)


def test_articles_of_given_pages(spark):
    import html

    for r in html_text.extract(spark.read.parquet(f"{SF}/pages.parquet")).join(spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "html"), "page_id").collect():
        inner = re.search(r"<article>(.*?)(</article>|$)", r["html"], re.S)[1]
        assert r["text"] == " ".join(html.unescape(re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", inner))).split())


# contamination ---------------------------------------------------------------


def test_templates(spark):
    items = [(1, "If Tom has 5 apples and buys 3 more apples, how many apples does Tom have now?"), (2, "A train runs 60 km in 2 hours; how long does it need for 90 km in all?"), (3, "short item here"), (4, None)]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("h", F.lit(0))
    texts = [
        (10, "Intro. " + items[0][1] + " End."), (11, "x if Ann has 7 apples and buys 4 more apples, how many apples does Ann have now? y"), (12, "If Ann has 7 apples and buys 4 more apples, how many apples does Bob have now?"),
        (13, "A train runs 80 km in 5 hours; how long does it need for 100 km in all?"), (14, "Nothing of the kind is said in this text, which has 5 apples."), (15, "short item here"), (16, None), (None, items[0][1]), (17, ""),
    ]
    df = spark.createDataFrame(texts, "doc_id long, text string").withColumn("size", F.lit("clash"))
    got = {(r["doc_id"], r["item_id"]): r["same_slots"] for r in decontam.contaminated(df, bench).collect()}
    # "Tom" begins as a name that is the second word; 12 breaks off where Bob stands for Tom.
    assert got[10, 1] is True and got[11, 1] is False and got[13, 2] is False
    assert (12, 1) not in got and not {14, 15, 16, 17} & {d for d, _ in got}
    kept = decontam.drop_contaminated(df, bench)
    assert kept.columns == df.columns and {r["doc_id"] for r in kept.collect()} == {12, 14, 15, 16, 17, None}
    assert decontam.contaminated(df.limit(0), bench).count() == 0 and decontam.contaminated(df, bench.limit(0)).count() == 0


def test_contamination_brute_force(spark, docs):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    words = lambda t: re.sub(r"[^\w\s]", "", (t or "").lower()).split()
    items = {r["item_id"]: words(r["text"]) for r in bench.collect()}
    want = set()
    for d in docs.collect():
        w = words(d["text"])
        have = {tuple(w[i : i + 8]) for i in range(len(w) - 7)}
        for i, t in items.items():
            ws = [tuple(t[k : k + 8]) for k in range(len(t) - 7)]
            if ws and sum(x in have for x in ws) >= 0.5 * len(ws):
                want.add((d["doc_id"], i))
    assert {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(docs, bench).collect()} == want and want


def test_filter_has_no_misses(spark):
    import numpy as np

    h = [r[0] for r in spark.range(5000).select(F.xxhash64("id")).collect()]
    f = filter_of(spark.createDataFrame([(x,) for x in h], "h long"), "h")
    assert f.holds(np.array(h, np.int64).view(np.uint64)).all()
    assert f.holds(np.arange(1, 5000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).mean() < 0.01


# quotations ------------------------------------------------------------------


def test_quote_parsing():
    own, found = quotes.parse("Yes.\n\nOn Mon, Bob wrote:\n> What do you\n> think?\n>> First one\n> > here.\n> And more\nEnd")
    assert own == "Yes.\n\nEnd" and found == [(1, "What do you think?"), (2, "First one here."), (1, "And more")]
    assert quotes.parse("") == ("", [])


def test_threads(spark, empty):
    a, b = "This is the first message of all. It says two things.", "I do not agree with that at all. Why should it be so?"
    rows = [
        (1, 1, a), (2, 2, f"{b}\n> This is the first\n> message of all. It says two things."), (3, 3, f"Because of reasons given.\n> I do not agree with that at all.\n> Why should it be so?\n>> {a}"), (4, 4, "Alone and without any quote."),
        (5, 5, f"> {a}"), (6, 6, None), (6, 6, None), (None, 7, a), (8, 0, f"> {a}"),
    ]
    df = spark.createDataFrame(rows, "id long, sent int, text string").withColumn("level", F.lit("clash"))
    got = {r["id"]: (r["conversation"], r["position"], r["reply_to"], r["text"]) for r in quotes.conversations(df).collect()}
    assert got[1] == (1, 1, None, a) and got[2] == (1, 2, 1, b) and got[3] == (1, 3, 2, "Because of reasons given.")
    assert got[5] == (1, 4, 1, "") and got[4][:3] == (4, 1, None) and got[6] == (6, 1, None, "") and got[8][:3] == (8, 1, None) and len(got) == 7
    assert quotes.conversations(df.limit(0)).count() == 0


def test_turns_become_threads(spark):
    turns = spark.read.parquet(f"{SF}/conversations.parquet")
    got = {r["id"]: r for r in quotes.conversations(quotes.as_messages(turns), thread_col="conv_id").collect()}
    rows = sorted((r["conv_id"], r["turn"], r["text"] or "") for r in turns.collect())
    count = Counter()
    units, before = defaultdict(dict), {}
    for c, _, t in rows:
        count[c] += 1
        i = c * 1000 + count[c]
        assert got[i]["text"] == t.strip()
        if count[c] > 1 and quotes.unit_hashes(before[c]):
            first = min(k for k, u in units[c].items() if all(x in u for x in quotes.unit_hashes(before[c])))
            assert got[i]["reply_to"] == first and got[i]["conversation"] == got[first]["conversation"] and got[i]["position"] > got[first]["position"]
        units[c][i], before[c] = set(quotes.unit_hashes(t)), t


# pipeline --------------------------------------------------------------------


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "exact_dedup", "near_dedup", "decontamination", "tokens"]
    out = corpus_pipeline.run(spark, SF).collect()
    ids = {r["doc_id"] for r in out}
    assert len(ids) == len(out) and 0.5 * docs.count() < len(out) < docs.count()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert all(r["decoded"] == (texts[r["doc_id"]] or "") for r in out)
    assert len({lower(texts[i]) for i in ids}) == len(ids)
    assert math.isclose(sum(r["n_tokens"] for r in out), sum(len(r["ids"]) for r in out))
