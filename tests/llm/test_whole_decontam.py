"""Verbatim copies with glued slots, clashes in part of an item, and items of numbers."""

from pelagia.llm import decontam

GLUED = "On Monday the well known Anglo-Saxon scholar met with Anna and then with Berta near the old mill before Anna went home again with all of the books"
NUMBERS = "12 34 56 78 plus 90 11 13 15 17 19 21"


def found(spark, items, texts):
    bench = spark.createDataFrame(list(enumerate(items, 1)), "item_id long, text string")
    docs = spark.createDataFrame(list(enumerate(texts, 10)), "doc_id long, text string")
    return {(r["doc_id"], r["item_id"]): (round(r["share"], 3), r["same_slots"]) for r in decontam.contaminated(docs, bench).collect()}


def test_values_are_those_of_their_place():
    words, stages = decontam.template("it was Anna's house and then Berta came on 2024-01-02 with 7 others")
    held, plain = decontam.places(words, stages)
    assert sorted(held.items()) == [(2, ["anna"]), (6, ["berta"]), (9, ["2024", "01", "02"]), (11, ["7"])]
    assert plain[2] == b"annas" and plain[9] == b"20240102"


def test_copies_with_glued_slots(spark):
    dated = "on 2024-01-02 we paid 5 dollars for the first ticket and 7 for the other ticket and then 5 for the last of them"
    texts = [f"so said Smith-Jones to me: {GLUED}", f"call 555-123-4567 or pay by 9: {dated}", GLUED.replace(" with Berta near", " with\n  Berta near")]
    got = found(spark, [GLUED, dated], texts)
    assert got[10, 1][1] and got[11, 2][1] and got[12, 1] == (1.0, True)


def test_a_clash_costs_its_windows_only(spark):
    tail = "while the rest of this long question goes on as it was without a single change of any word in it at all until 5 is named"
    item = f"there are 5 apples in the big basket on the table {tail}"
    got = found(spark, [item], [item.replace("are 5 apples", "are 8 apples")])
    n = len(decontam.template(item)[0]) - 7
    assert set(got) == {(10, 1)} and got[10, 1][0] == round((n - 3) / n, 3)


def test_items_of_numbers_and_names_of_any_script(spark):
    name = "then the teacher asked \u00c9mile and \u041e\u043b\u044c\u0433\u0430 how many of the apples they still had"
    got = found(spark, [NUMBERS, name], [f"see {NUMBERS} there", NUMBERS.replace("56", "57").replace("13", "14"), name.replace("\u00c9mile", "Anna")])
    assert got == {(10, 1): (1.0, True), (12, 2): (1.0, False)}
