"""Long conversations, short quotes, and passages whose sentences were first said elsewhere."""

from pelagia.llm import quotes


def test_long_conversation_keeps_all_turns(spark):
    turns = [(c, k, f"Conversation {c} has come to turn {k} by now.") for c, n in ((5, 2300), (6, 3), (7, 1)) for k in range(n)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, text string")
    messages = quotes.as_messages(df)
    sent = {(r["conv_id"], r["sent"]): r for r in messages.collect()}
    assert len(sent) == len(turns) and len({r["id"] for r in sent.values()}) == len(turns)
    assert all((f"> {turns[k - 2][2]}" in sent[5, k]["text"]) and (k < 3 or f">> {turns[k - 3][2]}" in sent[5, k]["text"]) for k in range(2, 2301))
    got = {r["id"]: r for r in quotes.conversations(messages, thread_col="conv_id").collect()}
    assert len(got) == len(turns)
    for c, n in ((5, 2300), (6, 3), (7, 1)):
        mine = [got[sent[c, k]["id"]] for k in range(1, n + 1)]
        assert [r["position"] for r in mine] == list(range(1, n + 1)) and {r["conversation"] for r in mine} == {c * 1000 + 1}
        assert [r["reply_to"] for r in mine] == [None] + [r["id"] for r in mine[:-1]]


def test_every_holder_is_a_candidate(spark):
    a, b, c, d = "This is sentence one.", "Here comes number two.", "Then follows the third.", "And last the fourth."
    rows = [(1, 1, f"{a} {b}"), (2, 2, f"{c} {d}"), (3, 3, f"{a} {c}"), (4, 4, f"Indeed, I agree with it.\n> {a} {c}"), (5, 5, "Yes, thanks."), (6, 6, f"Good to hear that.\n> Yes, thanks."), (7, 7, "No.\n\nSorry."), (8, 8, "A pity, that is.\n> Sorry.")]
    got = {r["id"]: r["reply_to"] for r in quotes.conversations(spark.createDataFrame(rows, "id long, sent int, text string")).collect()}
    assert got == {1: None, 2: None, 3: None, 4: 3, 5: None, 6: 5, 7: None, 8: 7}
