"""The pipeline's stages on awkward rows, each on what its predecessor kept."""

import corpus_pipeline
from pelagia.llm import pii

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"word{k % 977} of{k % 31}" for k in range(4000))
#: Ids, texts and columns whose names operators use inside.
ROWS = [
    (900_001, "A plain text about the tides of the southern coast and its many small boats.", "en", "x", 1), (900_002, "a PLAIN text about the tides of the southern coast and its many small boats.", "en", "x", 1),
    (900_003, None, "en", None, None), (900_004, "", None, "x", 2), (900_005, " \n\t ", "en", "x", 2), (None, "No id is here, yet the text should stay.", "en", "x", 3),
    (900_006, LONG, "en", "x", 4), (900_007, LONG + " and a tail", "en", "x", 4), (900_008, "Another text, once.", "en", "x", 4), (900_008, "Another text, once.", "en", "x", 4),
]
SCHEMA = "doc_id long, text string, lang string, root string, h int"


def test_stages_on_awkward_rows_and_on_none(spark):
    docs, none = spark.createDataFrame(ROWS, SCHEMA), spark.createDataFrame([], SCHEMA)
    left = {}
    for name, stage in corpus_pipeline.STAGES:
        docs, none = stage(spark, docs, SF), stage(spark, none, SF)
        if name != "tokens":
            assert docs.columns == none.columns == [c.split()[0] for c in SCHEMA.split(", ")]
        assert none.collect() == []
        left[name] = docs.collect()
    ids = {name: sorted(r["doc_id"] or 0 for r in rows) for name, rows in left.items()}
    assert ids["toxicity"] == sorted(r[0] or 0 for r in ROWS)
    # Blank texts differ from empty ones; the null text is the empty one's copy.
    assert ids["exact_dedup"] == [0, 900_001, 900_003, 900_005, 900_006, 900_007, 900_008]
    assert ids["near_dedup"] == ids["decontamination"] == ids["tokens"] == [0, 900_001, 900_003, 900_005, 900_006, 900_008]


def test_redacted_texts(spark):
    rows = [(1, "Write to ann@mail.example or 10.0.0.1.", "x"), (2, None, "y"), (3, "nothing here", "z"), (None, "bob@mail.example", "x")]
    field = pii.fit(spark.read.parquet(f"{SF}/documents.parquet"))
    got = [(r["doc_id"], r["text"], r["spans"]) for r in pii.redact(spark.createDataFrame(rows, "doc_id long, text string, spans string").coalesce(1), field).collect()]
    assert got[0][1].startswith("Write to <email> or <ip>") and got[1:] == [(2, "", "y"), (3, "nothing here", "z"), (None, "<email>", "x")]
