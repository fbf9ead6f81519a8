"""Conversations from messages that quote each other."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from pelagia.llm.common import forest_roots, text_of, written

_MARKS = re.compile(r"(?:[ \t]*>)+[ \t]?")
#: Lines that only introduce a quotation.
_INTRODUCES = re.compile(r"\s*(?:on .{0,200}wrote|.{0,120} (?:wrote|writes|said)|-+ ?original message ?-+)\s*:?\s*", re.I)
_SENTENCE = re.compile(r"(?<=[.!?])\s+")
_NOT_WORD = re.compile(r"[^\w\s]+|_")


def parse(text: str) -> tuple[str, list[tuple[int, str]]]:
    """(own text, quoted passages as (level, text)) of a message.

    A line's level is the number of quote marks before it.  A passage is a run of lines of
    one level, empty lines parting them, with hard-wrapped lines joined.  Lines that only
    introduce a quotation ("... wrote:") are dropped where a quotation follows.
    """
    own: list[str] = []
    found: list[tuple[int, str]] = []
    level, run = 0, []

    def close() -> None:
        if level and run:
            found.append((level, " ".join(run)))
        run.clear()

    for line in re.split(r"\r?\n", text):
        m = _MARKS.match(line)
        now = m.group().count(">") if m else 0
        if now > level and not level and own and _INTRODUCES.fullmatch(own[-1]):
            own.pop()
        elif now > level and run and _INTRODUCES.fullmatch(run[-1]):
            run.pop()
        bare = line[m.end() :].strip() if m else line
        if now != level or not bare:
            close()
            level = now
        if not now:
            own.append(line)
        elif bare:
            run.append(bare)
    close()
    return "\n".join(own).strip(), found


def normal(text: str) -> str:
    """Lower case, punctuation dropped, white space as one blank."""
    return " ".join(_NOT_WORD.sub("", text.lower()).split())


def _hash(unit: str) -> int:
    return (h := xxh64_intdigest(unit)) - (h >> 63 << 64)


def unit_hashes(text: str, min_words: int = 3) -> list[int]:
    """Signed 64-bit hashes of the normalised sentences of `min_words` words or more; of the whole text if it has none."""
    units = [u for u in map(normal, _SENTENCE.split(text)) if u.count(" ") >= min_words - 1]
    if not units and (whole := normal(text)):
        units = [whole]
    return list(map(_hash, dict.fromkeys(units)))


def own_hashes(text: str) -> list[int]:
    """The units of a message's own text, and those of each paragraph, as a short paragraph is quoted as a passage of its own."""
    found = unit_hashes(text)
    parts = re.split(r"\r?\n[ \t]*(?:\r?\n[ \t]*)+", text)
    return list(dict.fromkeys(found + [h for p in parts for h in unit_hashes(p)])) if len(parts) > 1 else found


def _parsed(messages: DataFrame) -> DataFrame:
    """(id, thread, sent, own_text, own units, quoted: level and units of each passage)."""

    @F.arrow_udf("struct<own_text:string,own:array<bigint>,quoted:array<struct<level:int,units:array<bigint>>>>")
    def run(text: pa.Array) -> pa.Array:
        out = []
        for own, found in map(parse, text.to_pylist()):
            out.append({"own_text": own, "own": own_hashes(own), "quoted": [{"level": k, "units": u} for k, t in found if (u := unit_hashes(t))]})
        kind = pa.struct([("own_text", pa.string()), ("own", pa.list_(pa.int64())), ("quoted", pa.list_(pa.struct([("level", pa.int32()), ("units", pa.list_(pa.int64()))])))])
        return pa.array(out, kind)

    return messages.select("id", "thread", "sent", run("text").alias("p")).select("id", "thread", "sent", "p.*")


def link_quotes(parsed: DataFrame, min_share: float = 0.8) -> DataFrame:
    """(id, parent, level): the original message of each quoted passage.

    Passages and own texts are compared by the hashes of their sentences, so a passage may
    be any part of a message and may be wrapped anew.  Of the messages of the thread that
    were sent before it and hold at least `min_share` of its sentences, the passage links
    to the one with most of them, of equals to the earliest.

    None is left out: a message that holds enough of k sentences holds one of any
    k - least + 1, so the holders of that many of the rarest are all candidates.  Messages
    with the same sentences count as their earliest, and passages with the same sentences
    are looked up once, so repeated texts and stock phrases don't multiply.

    Edge cases: a passage without sentences, and one that no earlier message holds, has no
    row; messages of other threads are never looked at; an empty table gives no rows.
    """
    key = F.md5(F.concat_ws("|", F.concat_ws(",", F.col("units").cast("array<string>")), "thread"))
    own = parsed.where(F.size("own") > 0).groupBy("thread", F.array_sort("own").alias("own")).agg(F.min(F.struct("sent", "id")).alias("o"))
    own = written(own.select("thread", "own", F.col("o.sent").alias("parent_sent"), F.col("o.id").alias("parent")), "originals")
    have = own.select("thread", "parent", F.explode("own").alias("h"))
    blocks = parsed.select("thread", "id", "sent", F.posexplode("quoted").alias("block", "q")).select("thread", "id", "sent", "block", "q.level", F.array_sort("q.units").alias("units"))
    blocks = written(blocks.withColumn("key", key), "passages")
    sets = written(blocks.groupBy("key").agg(F.first("thread").alias("thread"), F.first("units").alias("units")), "sets")
    need = sets.select("key", "thread", F.explode("units").alias("h"))
    held = have.groupBy("thread", "h").agg(F.count(F.lit(1)).alias("held"))
    spare = F.size("by_rarity") - F.ceil(min_share * F.size("by_rarity") - F.lit(1e-6)) + 1
    by_rarity = F.array_sort(F.collect_list(F.struct(F.coalesce("held", F.lit(0)).alias("held"), "h")))
    rare = need.join(held, ["thread", "h"], "left").groupBy("key", "thread").agg(by_rarity.alias("by_rarity"))
    rare = rare.select("key", "thread", F.explode(F.slice("by_rarity", F.lit(1), spare.cast("int"))).alias("r")).where("r.held > 0").select("key", "thread", F.col("r.h").alias("h"))
    led = rare.join(have, ["thread", "h"]).select("key", "parent").distinct()
    n = F.size(F.array_intersect("units", "own"))
    hits = led.join(sets.select("key", "units"), "key").join(own.select("parent", "parent_sent", "own"), "parent").select("key", "parent", "parent_sent", n.alias("n"), F.size("units").alias("total"))
    # Per set of sentences and number of them that are held, the earliest message.
    steps = hits.where(F.col("n") >= min_share * F.col("total")).groupBy("key", "n").agg(F.min(F.struct("parent_sent", "parent")).alias("o"))
    best = blocks.select("id", "sent", "block", "level", "key").join(steps, "key").where("o.parent_sent < sent")
    best = best.groupBy("id", "block").agg(F.min_by(F.struct("o.parent", "level"), F.struct(-F.col("n"), "o.parent_sent", "o.parent")).alias("x"))
    return best.select("id", "x.parent", "x.level").groupBy("id", "parent").agg(F.min("level").alias("level"))


def numbered(rows: DataFrame, group: str, order: list[str], name: str, ties: tuple[str, ...] = ()) -> DataFrame:
    """The rows with their number within `group`, and with the block and the number of blocks of the group.

    Rows are dealt by ranges of group and order, so a group of any size is spread over many
    tasks; each range numbers its own rows and adds those of the group in ranges before.
    `ties` order rows that are equal in `order`.
    """
    placed = written(rows.repartitionByRange(group, *order).withColumn("__block", F.spark_partition_id()), name)
    sizes = placed.groupBy(group, "__block").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(group).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    split = sizes.withColumns({"__before": F.sum("n").over(w), "__blocks": F.count(F.lit(1)).over(Window.partitionBy(group))}).where("__blocks > 1").drop("n")
    out = placed.withColumn("__k", F.row_number().over(Window.partitionBy(group, "__block").orderBy(*order, *ties)).cast("long"))
    out = out.join(split, [group, "__block"], "left")  # a group for each border between ranges at most
    return out.withColumn("k", F.col("__k") + F.coalesce("__before", F.lit(0))).drop("__before")


def conversations(messages: DataFrame, min_share: float = 0.8, thread_col: str | None = None) -> DataFrame:
    """Reply-ordered conversations without quotes: conversation, position, reply_to, id, text.

    `messages` has id, sent (anything ordered) and text; `thread_col` names a mailbox or
    list beyond which no message is quoted, if there is one.  A message replies to the
    original of its outermost quotation (the lowest level; of those the latest).  Messages
    that reply to one another form a conversation, named by the id of its first message
    and ordered by time, so a reply comes after what it answers.  Lines that only quote are left out.

    Edge cases: null and empty texts have no quotes and an empty text; a missing id is not
    looked at; of repeated rows with one id the first by time and own text counts; a
    missing thread is a thread of its own; an empty table gives no rows; other columns are
    not read.
    """
    thread = F.coalesce(F.col(thread_col).cast("string"), F.lit("")) if thread_col else F.lit("")
    base = messages.select(F.col("id").cast("long").alias("id"), "sent", thread.alias("thread"), text_of("text").alias("text")).where("id is not null")
    # Quotes are parsed off before anything is shuffled.
    rows = _parsed(base).withColumn("r", F.row_number().over(Window.partitionBy("id").orderBy("sent", "own_text"))).where("r = 1").drop("r")
    rows = written(rows, "messages")
    links = link_quotes(rows, min_share)
    parent = written(links.groupBy("id").agg(F.min_by("parent", F.struct("level", -F.col("parent"))).alias("reply_to")), "replies")
    rooted = forest_roots(parent, "id", "reply_to")
    found = (
        rows.select("id", "sent", F.col("own_text").alias("text"))
        .join(rooted.select(F.col("node").alias("id"), "root"), "id", "left")
        .join(parent, "id", "left")
        .select(F.coalesce("root", "id").alias("conversation"), "sent", "reply_to", "id", "text")
    )
    return numbered(found, "conversation", ["sent", "id"], "found").select("conversation", F.col("k").cast("int").alias("position"), "reply_to", "id", "text")


#: Turns of a conversation that are numbered in one run of ids, and the distance of such runs.
RUN, RUNS_APART = 1000, 1 << 44


def message_id(conv: Column, k: Column) -> Column:
    """conv * 1000 + k below 1,000 turns; each further thousand lies 2**44 higher, so no two turns share an id.

    Conversation ids beyond 8.7e9 in size or more than 5e8 turns fail instead of overlapping.
    """
    out = conv * RUN + k % RUN + F.floor(k / RUN).cast("long") * F.lit(RUNS_APART)
    sound = (F.abs(conv) < RUNS_APART // 2 // RUN) & (k < (1 << 19) * RUN)
    return F.when(sound, out).otherwise(F.raise_error(F.lit("conversation id or turn count beyond the range of message ids")).cast("long"))


def as_messages(turns: DataFrame) -> DataFrame:
    """Messages of a table of turns: in each conversation a turn answers the one before by quoting it.

    A message holds its own text, the whole turn before it one level deep and the turn
    before that two levels deep, as mail programs write it; ids grow with time.

    Edge cases: turns without a conversation have no message; a null text is an empty one;
    turns with the same number are ordered by text; an empty table gives no messages.
    """
    rows = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), text_of("text").alias("text")).where("conv_id is not null")
    rows = numbered(rows, "conv_id", ["turn"], "turns", ties=("text",))
    w = Window.partitionBy("conv_id", "__block").orderBy("turn", "text")
    w_back = Window.partitionBy("conv_id", "__block").orderBy(F.desc("k"))
    # Where a conversation goes on in the next range, its last two turns are handed over.
    edges = written(rows.where("__blocks > 1").withColumn("__back", F.row_number().over(w_back)).where("__back <= 2").select("conv_id", "k", "text"), "edges")
    rows = rows.withColumn("p1", F.lag("text", 1).over(w)).withColumn("p2", F.lag("text", 2).over(w))
    for name, back in (("p1", 1), ("p2", 2)):
        before = edges.select("conv_id", (F.col("k") + back).alias("k"), F.col("text").alias(f"edge{back}"))
        rows = rows.join(before, ["conv_id", "k"], "left").withColumn(name, F.coalesce(name, f"edge{back}"))
    mark = lambda c, m: F.regexp_replace(c, r"(?m)^", m)
    quote = F.when(F.col("p1").isNotNull(), F.concat(F.lit("\nSomeone wrote:\n"), F.coalesce(F.concat(mark(F.col("p2"), ">> "), F.lit("\n")), F.lit("")), mark(F.col("p1"), "> ")))
    return rows.select(message_id(F.col("conv_id"), F.col("k")).alias("id"), F.col("k").alias("sent"), "conv_id", F.concat("text", F.coalesce(quote, F.lit(""))).alias("text"))
