"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pelagia.llm import decontam, exact_dedup, hard_negatives, html_text, line_dedup, phrases, pii, quotes, simhash, sp_tokens, substrings, toxicity, warc
from pelagia.sources.scratch import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def piece_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_groups(table(spark, sf_dir, "documents"), keep="max")


def op3_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = quotes.as_messages(table(spark, sf_dir, "conversations"))
    return quotes.conversations(messages, min_share=0.8, thread_col="conv_id")


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sp_tokens.encode_digests(table(spark, sf_dir, "documents"), piece_model())


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.7)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"), words=3, max_bits=2)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "archive")
    warc.write_archive(table(spark, sf_dir, "pages"), path, min_revisit_bytes=0)
    return warc.page_records(warc.read_archives(spark, path, with_payload=False))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=8, min_share=0.3)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents"), min_chars=10, min_docs=2)
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", label)
    return hard_negatives.hard_negatives(vectors, F.col("vec_id") % 100 == 0, positives=5, negatives=5, low=80, high=100, scale=256)


def op12_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substrings.drop_repeated_passages(table(spark, sf_dir, "documents"), window=35)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"), min_count=10, max_words=3, inside_share=50, top=2000)


QUERIES = {
    "op1_pii": op1_pii,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_quotation_linking": op3_quotation_linking,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_toxicity": op5_toxicity,
    "op6_simhash": op6_simhash,
    "op7_warc": op7_warc,
    "op8_decontamination": op8_decontamination,
    "op9_line_dedup": op9_line_dedup,
    "op10_html_text": op10_html_text,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_repeated_passages": op12_repeated_passages,
    "op13_collocations": op13_collocations,
}

_NORM = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Base32 of a SHA-1: 8 groups of 5 hex digits, each of 4 base32 digits.
_BASE32 = "list_reduce(list_transform(range(0, 8), lambda g: " + " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(sha1(t), (5 * g + 1)::INTEGER, 5))::BIGINT >> {s}) & 31) + 1)::INTEGER, 1)" for s in (15, 10, 5, 0)
) + "), lambda a, b: a || b)"

ORACLE = {
    "op11_hard_negatives": """
        WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
                   FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_dot_product(a.q, b.q)::BIGINT AS score
              FROM v a, v b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
        p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
        n AS (SELECT anchor_id, positive_id, id AS negative_id, positive_score, score AS negative_score, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS k
              FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score)
        SELECT anchor_id, positive_id, k::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE k <= 5""",
    "op12_repeated_passages": """
        WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
        x AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d)),
        r AS (SELECT s FROM x GROUP BY s HAVING count(*) > 1),
        g AS (SELECT doc_id, unnest(range(i, i + 35)) AS pos FROM x SEMI JOIN r USING (s)),
        p AS (SELECT doc_id, pos, w[pos] AS word FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS pos FROM d)),
        k AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY pos) AS t FROM p ANTI JOIN g USING (doc_id, pos) GROUP BY doc_id)
        SELECT doc_id, len(w)::BIGINT AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM d LEFT JOIN k USING (doc_id)""",
    "op13_collocations": f"""
        WITH d AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_NORM}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
        w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM d),
        g AS (SELECT lang, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM w, range(1, 4) t(k)),
        f AS (SELECT lang, k AS words, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS a FROM g GROUP BY ALL),
        n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY 1),
        c AS (SELECT lang, words, phrase, a, string_split(phrase, ' ') AS p FROM f WHERE words > 1 AND a >= 10),
        k AS (SELECT lang, words, phrase, a, k, array_to_string(p[1:k], ' ') AS x, array_to_string(p[k + 1:], ' ') AS y FROM c, range(1, 3) t(k) WHERE k < words),
        s AS (SELECT k.*, l.a AS l, r.a AS r, (1000000::HUGEINT * k.a * k.a // (l.a::HUGEINT * r.a))::BIGINT AS score
              FROM k JOIN f l ON l.lang = k.lang AND l.phrase = k.x AND l.words = k.k JOIN f r ON r.lang = k.lang AND r.phrase = k.y AND r.words = k.words - k.k),
        b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        i AS (SELECT lang, p[1:2] AS q, a FROM c WHERE words = 3 UNION ALL SELECT lang, p[2:3], a FROM c WHERE words = 3),
        h AS (SELECT lang, array_to_string(q, ' ') AS phrase, max(a) AS longer FROM i GROUP BY ALL),
        o AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, score
              FROM b LEFT JOIN h USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 50 * a)
        SELECT lang, rank, phrase, a, l, r, n, score FROM o JOIN n USING (lang) WHERE rank <= 2000""",
    "op7_warc": f"""
        SELECT page_id, strlen(t) AS payload_bytes, {_BASE32} AS payload_digest,
               CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first_id THEN first_id END AS refers_to
        FROM (SELECT page_id, coalesce(html, '') AS t, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id FROM pages)""",
    "op2_exact_dedup": f"""
        SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
        FROM (SELECT doc_id, {_NORM} AS t FROM documents)""",
    "op9_line_dedup": """
        WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
        l AS (SELECT doc_id, unnest(range(1, len(lines) + 1)) AS pos, unnest(lines) AS line FROM d),
        k AS (SELECT doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
        r AS (SELECT key, min(doc_id) AS first_id FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
        m AS (SELECT k.doc_id, k.pos, k.line, r.key IS NOT NULL AND k.doc_id <> r.first_id AS gone FROM k LEFT JOIN r ON k.key = r.key)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
        FROM m GROUP BY doc_id""",
}
