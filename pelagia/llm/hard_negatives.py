"""Hard negatives of anchors: score windows below each positive, answered from disjoint slots."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pelagia.llm.common import trim, written
from pelagia.sources.scratch import delete_path

#: Rows of a packed block, and components that one side of a cell holds at most (rows times dimensions).
BLOCK_ROWS, CELL_ROWS, CELL_ANCHORS = 1024, 1 << 22, 1 << 20
#: Scores of a cell that are held at once.
SCORES = 1 << 21
#: Below the first bound float32 sums integers exactly, below the second float64; scores beyond the third fail the job.
EXACT32, EXACT64, MOST = 1 << 24, 1 << 53, 1 << 56


def usable(label: str, vector: str) -> Column:
    """Rows with a label and a vector whose components are all finite numbers."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    return F.col(label).isNotNull() & F.col(vector).isNotNull() & F.coalesce(F.forall(vector, finite), F.lit(False))


def _packed(rows: DataFrame, scale: int, name: str, used: list[str]) -> DataFrame:
    """(no, dim, n, data) blocks of rows of one dimension, components as floor(scale * x); other columns go along."""
    extra = rows.columns[2:-1]

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            vectors = batch.column(batch.num_columns - 1)
            sizes, flat = np.diff(vectors.offsets.to_numpy()), np.floor(scale * vectors.flatten().to_numpy(zero_copy_only=False))
            starts = np.cumsum(sizes) - sizes
            dims, counts, data = [], [], []
            for dim in np.unique(sizes):
                mine = np.flatnonzero(sizes == dim)
                for at in range(0, len(mine), BLOCK_ROWS):
                    some = mine[at : at + BLOCK_ROWS]
                    q = flat[(starts[some][:, None] + np.arange(dim)).ravel()]
                    kind = np.float32 if not len(q) or np.abs(q).max() < EXACT32 else np.float64
                    block = pa.record_batch([*[c.take(pa.array(some)) for c in batch.columns[:-1]], pa.array([q.astype(kind).tobytes()] + [None] * (len(some) - 1), pa.binary())], names=["id", "label", *extra, "q"])
                    block = block.replace_schema_metadata({"kind": np.dtype(kind).name})
                    sink = pa.BufferOutputStream()
                    with pa.ipc.new_stream(sink, block.schema) as w:
                        w.write_batch(block)
                    dims.append(dim)
                    counts.append(len(some))
                    data.append(sink.getvalue().to_pybytes())
            yield pa.RecordBatch.from_arrays([pa.array(dims, pa.int32()), pa.array(counts, pa.int64()), pa.array(data, pa.binary())], names=["dim", "n", "data"])
        trim()

    blocks = rows.mapInArrow(run, "dim int, n long, data binary").withColumn("no", F.monotonically_increasing_id())
    return written(blocks, name, used)


def _opened(cell: pa.Table, dim: int) -> tuple[pa.Table, np.ndarray]:
    """The rows of a cell's blocks and their components."""
    tables, parts = [], []
    for data in cell.column("data").to_pylist():
        table = pa.ipc.open_stream(data).read_all()
        parts.append(np.frombuffer(table.column("q")[0].as_py(), table.schema.metadata[b"kind"].decode()).reshape(table.num_rows, dim))
        tables.append(table.drop_columns(["q"]).replace_schema_metadata(None))
    return pa.concat_tables(tables).combine_chunks(), np.concatenate(parts)


def _exact(rows: np.ndarray, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both sides in the smallest type whose sums are exact, by the bound of Cauchy and Schwarz."""
    norm = lambda m: float(np.sqrt((m.astype(np.float64) ** 2).sum(axis=1).max(initial=0)))
    bound = norm(rows) * norm(anchors) * (1 + 1e-9)
    if not bound < MOST:
        raise ValueError("vectors whose scores may pass 2^56")
    kind = np.float32 if bound < EXACT32 else np.float64 if bound < EXACT64 else np.int64
    return rows.astype(kind), anchors.astype(kind)


def _first(group: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k different (score, id) of each group: higher scores first, then smaller ids."""
    order = np.lexsort((ids, -score, group))
    g, s, i = group[order], score[order], ids[order]
    new = np.ones(len(order), bool)
    new[1:] = (g[1:] != g[:-1]) | (s[1:] != s[:-1]) | (i[1:] != i[:-1])
    order, g = order[new], g[new]
    head = np.flatnonzero(np.r_[True, g[1:] != g[:-1]]) if len(g) else np.zeros(0, np.int64)
    place = np.arange(len(g)) - np.repeat(head, np.diff(np.r_[head, len(g)]))
    return order[place < k]


def _best_of_label(rows: pa.Table, anchors: pa.Table, dim: int, k: int) -> pa.Table:
    """(anchor_id, id, score): the k best other rows of each anchor's label within a cell."""
    r, x = _opened(rows, dim)
    a, y = _opened(anchors, dim)
    x, y = _exact(x, y)
    r_id, r_label, a_id, a_label = r["id"].to_numpy(), r["label"].to_numpy(), a["id"].to_numpy(), a["label"].to_numpy()
    out = [[], [], []]
    for label in np.unique(a_label):
        mine = np.flatnonzero(r_label == label)
        mine = mine[np.argsort(r_id[mine], kind="stable")]
        if not len(mine):
            continue
        ids, asked = r_id[mine], np.flatnonzero(a_label == label)
        # Repeated rows count once, so as many more may be needed before k different ones are found.
        most = min(len(ids), k + len(ids) - len(np.unique(ids)))
        step = max(1, SCORES // len(ids))
        for at in range(0, len(asked), step):
            some = asked[at : at + step]
            score = (y[some] @ x[mine].T).astype(np.int64)
            low, high = np.searchsorted(ids, a_id[some], "left"), np.searchsorted(ids, a_id[some], "right")
            for row in np.flatnonzero(low < high):
                score[row, low[row] : high[row]] = -MOST
            limit = np.partition(score, len(ids) - most, axis=1)[:, len(ids) - most]
            g, c = np.nonzero((score >= limit[:, None]) & (score > -MOST))
            keep = _first(g, score[g, c], ids[c], k)
            for column, values in zip(out, (a_id[some][g[keep]], ids[c[keep]], score[g[keep], c[keep]])):
                column.append(values)
    return pa.table([pa.array(np.concatenate(c) if c else [], pa.int64()) for c in out], names=["anchor_id", "id", "score"])


def _best_of_slots(rows: pa.Table, anchors: pa.Table, dim: int, k: int) -> pa.Table:
    """(anchor_id, slot, id, score): the k best rows of other labels in each of an anchor's slots within a cell.

    Slot j holds the scores above the next upper limit up to its own; the window of limit
    j reaches furthest down of all that begin above the slot, so what lies below it is in none.
    """
    r, x = _opened(rows, dim)
    a, y = _opened(anchors, dim)
    x, y = _exact(x, y)
    r_id, r_label, a_id, a_label = r["id"].to_numpy(), r["label"].to_numpy(), a["id"].to_numpy(), a["label"].to_numpy()
    uppers, lowers = (a[c].combine_chunks() for c in ("uppers", "lowers"))
    counts = np.diff(uppers.offsets.to_numpy())
    width = int(counts.max(initial=0))
    fill = np.arange(width) < counts[:, None]
    up, down = np.full(fill.shape, -2 * MOST), np.full(fill.shape, 2 * MOST)
    up[fill], down[fill] = uppers.flatten().to_numpy(), lowers.flatten().to_numpy()
    out = [[], [], [], []]
    step = max(1, SCORES // len(r_id))
    for at in range(0, len(a_id), step):
        some = slice(at, at + step)
        score = y[some] @ x.T
        g, c = np.nonzero((score <= up[some, :1]) & (score >= down[some].min(axis=1)[:, None]) & (r_label != a_label[some][:, None]))
        value = score[g, c].astype(np.int64)
        slot = (up[some][g] >= value[:, None]).sum(axis=1) - 1
        inside = value >= down[some][g, slot]
        g, c, value, slot = g[inside], c[inside], value[inside], slot[inside]
        keep = _first(g * width + slot, value, r_id[c], k)
        for column, values in zip(out, (a_id[some][g[keep]], slot[keep], r_id[c[keep]], value[keep])):
            column.append(values)
    return pa.table([pa.array(np.concatenate(c) if c else [], pa.int64()) for c in out], names=["anchor_id", "slot", "id", "score"])


def _in_cells(blocks: DataFrame, anchors: DataFrame, best: Callable, k: int, schema: str) -> DataFrame:
    """Every block of rows with every block of anchors, in cells that hold a bounded part of each."""
    sizes = lambda df: df.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum(F.col("n") * F.greatest("dim", F.lit(1))), F.lit(0)).alias("v"), F.count(F.lit(1)).alias("b")).first()
    r, a = sizes(blocks), sizes(anchors)
    across = max(1, -(-r["v"] // CELL_ROWS), min(blocks.sparkSession.sparkContext.defaultParallelism, r["b"]))
    down = max(1, -(-a["v"] // CELL_ANCHORS))
    deal = lambda n: F.pmod(F.xxhash64("no"), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(int(n) - 1)))
    left = blocks.select("dim", deal(across).alias("i"), each(down).alias("j"), "data")
    right = anchors.select("dim", each(across).alias("i"), deal(down).alias("j"), "data")

    def meet(rows: pa.Table, asked: pa.Table) -> pa.Table:
        if not rows.num_rows or not asked.num_rows:
            return pa.table({c.split()[0]: pa.array([], pa.int64()) for c in schema.split(", ")})
        out = best(rows, asked, rows["dim"][0].as_py(), k)
        trim()
        return out

    key = ["dim", "i", "j"]
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(meet, schema)


def _leading(df: DataFrame, by: list[str], k: int) -> DataFrame:
    """The first k different (score, id) of each group; tasks send no more than their own first k."""
    w = Window.partitionBy(*by).orderBy(F.desc("score"), "id")
    return df.withColumn("place", F.dense_rank().over(w)).where(F.col("place") <= k).distinct()


def hard_negatives(
    vectors: DataFrame, anchors: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, scale: int = 256,
    id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding",
) -> DataFrame:
    """One row per anchor, positive and hard negative: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Scores are exact integer inner products of floor(scale * x).  An anchor (`anchors` is a
    condition on rows) has as positives the first `positives` other rows of its label, by
    score, then by smaller id; a positive's negatives are the first `negatives` rows of
    other labels whose score is from `low` to `high` percent of the positive's.

    The upper limits of an anchor's windows cut its scores into disjoint slots.  Anchors
    and rows meet in blocks, in cells of bounded size on both sides; a cell keeps the first
    of each slot, and so do tasks before their results are shuffled.  The slots of an
    anchor, merged in descending order from each window's own slot on, answer all its
    windows, which overlap.

    Edge cases: rows without id, label or vector, and rows with a missing, NaN or infinite
    component take no part; rows with the anchor's id are not its candidates; a row that is
    repeated (same id and score) is one candidate; of anchors that share an id the one with
    the smallest label, then vector, asks; vectors of different lengths never meet; an
    anchor without positives, and a positive without negatives, has no row, and a negative
    positive's window is empty; an empty table gives no rows; other columns are not read;
    vectors so long that a score might pass 2^56 fail the job.
    """
    spark, used = vectors.sparkSession, []
    fine = vectors.where(usable(label_col, vector_col) & F.col(id_col).isNotNull())
    columns = [F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label")]
    vector = F.col(vector_col).cast("array<double>").alias("vector")
    blocks = _packed(fine.select(*columns, vector), scale, "vectors", used)
    asked = written(fine.where(anchors).select(*columns, vector).groupBy("id").agg(F.min(F.struct("label", "vector")).alias("first")).select("id", "first.*"), "anchors", used)

    near = _in_cells(blocks, _packed(asked, scale, "asked", used), _best_of_label, positives, "anchor_id long, id long, score long")
    percent = lambda p: (F.col("score") * p).cast("decimal(20,0)") / 100
    upper, lower = F.floor(percent(high)).cast("long"), F.ceil(percent(low)).cast("long")
    found = written(_leading(near, ["anchor_id"], positives).select("anchor_id", F.col("id").alias("positive_id"), "score", upper.alias("upper"), lower.alias("lower")), "positives", used)
    limits = found.groupBy("anchor_id").agg(F.sort_array(F.collect_set(F.struct("upper", "lower")), asc=False).alias("w"))
    limits = limits.select(F.col("anchor_id").alias("id"), F.col("w.upper").alias("uppers"), F.col("w.lower").alias("lowers"))
    limited = asked.join(limits, "id").select("id", "label", "uppers", "lowers", "vector")

    slots = _in_cells(blocks, _packed(limited, scale, "limited", used), _best_of_slots, negatives, "anchor_id long, slot long, id long, score long")
    kept = written(_leading(slots, ["anchor_id", "slot"], negatives), "slots", used)
    merged = kept.groupBy("anchor_id").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("order"), "id", "slot"))).alias("merged"))
    own = found.join(limits, F.col("anchor_id") == F.col("id")).withColumn("own", F.array_position("uppers", F.col("upper")) - 1)
    window = F.filter("merged", lambda e: (e["slot"] >= F.col("own")) & (-e["order"] >= F.col("lower")))
    rows = own.join(merged, "anchor_id").select("anchor_id", "positive_id", F.col("score").alias("positive_score"), F.posexplode(F.slice(window, 1, negatives)).alias("at", "n"))
    out = written(
        rows.select("anchor_id", "positive_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("n.id").alias("negative_id"), "positive_score", (-F.col("n.order")).alias("negative_score")), "negatives"
    )
    for path in used:
        delete_path(spark, path)
    return out
