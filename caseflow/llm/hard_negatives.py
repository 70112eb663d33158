"""Hard negatives by a secondary-sort shuffle of scored pairs.

Rows whose id is divisible by ``every`` are anchors; a row's score is its integer inner
product with the anchor.  An anchor's positives are its first ``positives`` other rows of
the same label, and for each positive the first ``negatives`` rows of other labels that score
between ``low`` percent of the positive's score and that score are its hard negatives.

Scores are made in cells of a grid: rows fall into shards and anchors into blocks by the hash
of their ids, both sized in vector components (``CELL``), and every shard meets every block
once.  Of a cell only what can be in the result leaves: in a first pass an anchor's first
positives in the cell, from which its first positives of all follow; in a second the
first negatives of the cell in each of these positives' windows.

What leaves is dealt out by anchor and sorted by (anchor, descending score, positives
first, id) inside the partitions, by Spark's own spilling sort.  One pass then reads each
partition as a stream: a positive opens a window, a negative goes to the windows it lies
in, and a window closes when it is full or left behind.  What the stream holds is one
anchor's open windows, never its pairs.

Edge cases: rows with a null id, a null label, a null vector or a component that is
null or not finite take no part; of rows with the same id the least by (label, vector)
counts, so a repeated row is one; shorter vectors are continued with zeros, and an empty one
scores 0 with everything; scores tie by the smaller id; scores are exact, and clipped
to the range of long where components are that large; an anchor without positives, or
a positive without negatives, gives no rows; an empty table gives none; other columns are
not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from caseflow.llm import common as C

ANCHOR_EVERY = 100
POSITIVES = 5
NEGATIVES = 5
#: A negative scores at least so many percent of its positive.
LOW = 80
#: Vectors are multiplied by this and rounded down.
SCALE = 256
#: Components in a side of a cell.
CELL = 1 << 19
#: Scores of a cell held at once.
_AT_ONCE = 1 << 21
_LONG = (1 << 63) - 1
_PAIRS = "anchor_id bigint, id bigint, score bigint, negative boolean"
_RESULT = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


def taking_part(rows: DataFrame, id_col: str, label_col: str, vector_col: str) -> DataFrame:
    """(id, label, vector) of the rows that take part, one for an id."""
    known = F.forall("vector", lambda x: F.coalesce((F.abs(x) < float("inf")) & ~F.isnan(x), F.lit(False)))
    d = rows.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.col(label_col).cast("bigint").alias("label"),
        F.col(vector_col).cast("array<double>").alias("vector"),
    ).where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.coalesce(known, F.lit(False)))
    return d.groupBy("id").agg(F.min(F.struct("label", "vector")).alias("_least")).select("id", "_least.*")


def whole(vectors: np.ndarray) -> np.ndarray:
    """Components as whole numbers: doubles where that is exact, else Python's."""
    if not vectors.size or np.abs(vectors).max() < 2.0**900:
        return np.floor(vectors * SCALE)
    return np.frompyfunc(lambda v: math.floor(v * SCALE) if abs(v) < 2.0**900 else int(v) * SCALE, 1, 1)(vectors)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of whole numbers, as longs."""
    if not a.shape[1]:
        return np.zeros((len(a), len(b)), np.int64)
    size = [max(1, int(np.abs(x).max())) for x in (a, b)]
    if size[0] * size[1] * a.shape[1] < 1 << 53:
        return (a @ b.T).astype(np.int64)
    exact = [np.frompyfunc(int, 1, 1)(x) for x in (a, b)]
    return np.clip(exact[0] @ exact[1].T, -_LONG, _LONG).astype(np.int64)


def _matrices(*columns: pa.ChunkedArray) -> list[np.ndarray]:
    """Lists of numbers as matrices of one width, continued with zeros."""
    parts = []
    for c in columns:
        c = c.combine_chunks()
        c = pa.concat_arrays(c.chunks) if isinstance(c, pa.ChunkedArray) else c
        parts.append((c.flatten().to_numpy(zero_copy_only=False).astype(float), np.diff(c.offsets.to_numpy())))
    width = max((int(n.max()) for _, n in parts if len(n)), default=0)
    made = []
    for flat, sizes in parts:
        m = np.zeros((len(sizes), width))
        m[np.arange(width) < sizes[:, None]] = flat
        made.append(whole(m))
    return made


def _first(order: np.ndarray, group: np.ndarray, taken: np.ndarray, most: int) -> np.ndarray:
    """Of ``order`` (indices, group by group) the first ``most`` taken ones of each group."""
    order = order[taken[order]]
    g = group[order]
    begins = np.concatenate([[True], g[1:] != g[:-1]]) if len(g) else np.zeros(0, bool)
    place = np.arange(len(g)) - np.maximum.accumulate(np.where(begins, np.arange(len(g)), 0))
    return order[place < most]


def _cells(rows: DataFrame, anchors: DataFrame, pick: Callable, grid: tuple[int, int]) -> DataFrame:
    """Every shard of rows meets every block of anchors; ``pick`` says what leaves.

    ``pick(scores, anchor ids, anchor labels, anchor windows, ids, labels)`` gives (anchor, row) places.
    """
    shards, blocks = grid
    shard = F.pmod(F.xxhash64("id", F.lit("shard")), F.lit(shards))
    block = F.pmod(F.xxhash64("id", F.lit("block")), F.lit(blocks))
    cells = min(shards * blocks, 1 << 15)
    # columns of their own: both sides come from the same stored rows
    rows, anchors = (x.select(*[F.col(c).alias(c) for c in x.columns]) for x in (rows, anchors))
    mine = rows.withColumns({"_shard": shard, "_block": F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<bigint>"))})
    theirs = anchors.withColumns({"_block": block, "_shard": F.explode(F.sequence(F.lit(0), F.lit(shards - 1)).cast("array<bigint>"))})
    mine, theirs = (x.repartition(cells, "_block", "_shard").groupBy("_block", "_shard") for x in (mine, theirs))

    def cell(block: pa.Table, shard: pa.Table) -> pa.Table:
        found: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] * 3]
        windows = "opened" in block.column_names
        if block.num_rows and shard.num_rows:
            m, n = _matrices(block.column("vector"), shard.column("vector"))
            a_ids, a_labels = (block.column(c).to_numpy() for c in ("id", "label"))
            ids, labels = (shard.column(c).to_numpy() for c in ("id", "label"))
            opened = block.column("opened").to_pylist() if windows else [()] * len(m)
            step = max(1, _AT_ONCE // len(ids))
            for s in range(0, len(m), step):
                part = slice(s, s + step)
                scores = products(m[part], n)
                i, j = pick(scores, a_ids[part], a_labels[part], opened[part], ids, labels)
                found.append([a_ids[part][i], ids[j], scores[i, j]])
        cols = [np.concatenate(x) for x in zip(*found)]
        return pa.table([*cols, np.full(len(cols[0]), windows)], names=["anchor_id", "id", "score", "negative"])

    return theirs.cogroup(mine).applyInArrow(lambda block, shard: cell(block, shard), _PAIRS)


def mine(
    rows: DataFrame,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
    every: int = ANCHOR_EVERY,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    cell: int = CELL,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    rows = C.stored(taking_part(rows, id_col, label_col, vector_col), "vectors")
    anchors = rows.where(F.col("id") % every == 0)
    n, parts, wide = rows.agg(F.count("*"), F.sum(F.when(F.col("id") % every == 0, 1)), F.max(F.size("vector"))).first()
    side = max(1, cell // max(1, wide or 0))
    grid = (max(1, -(-n // side)), max(1, -(-(parts or 0) // side)))

    def near(scores, a_ids, a_labels, _, ids, labels):
        """An anchor's first rows of the same label."""
        i, j = np.nonzero((a_labels[:, None] == labels) & (a_ids[:, None] != ids))
        order = np.lexsort((ids[j], -scores[i, j], i))
        best = _first(order, i, np.ones(len(i), bool), positives)
        return i[best], j[best]

    first = _cells(rows, anchors, near, grid)
    order = W.partitionBy("anchor_id").orderBy(F.col("score").desc(), "id")
    first = C.stored(first.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= positives).drop("_n"), "positives")
    opened = first.groupBy("anchor_id").agg(F.collect_list("score").alias("opened"))
    opened = anchors.join(opened.withColumnRenamed("anchor_id", "id"), "id")

    def hard(scores, _, a_labels, opened, ids, labels):
        """The first rows of other labels in each of an anchor's windows."""
        tops = np.full((len(opened), positives), -1, np.int64)
        for i, x in enumerate(opened):
            tops[i, : len(x)] = x
        # least whole number n with 100 n >= low * top; below 0 a window is empty
        floors = np.where(tops >= 0, least_score(tops, low), _LONG)
        wanted = (scores >= floors.min(1)[:, None]) & (scores <= tops.max(1)[:, None]) & (a_labels[:, None] != labels)
        i, j = np.nonzero(wanted)
        s = scores[i, j]
        order = np.lexsort((ids[j], -s, i))
        keep = np.zeros(len(i), bool)
        for k in range(positives):
            keep[_first(order, i, (s <= tops[i, k]) & (s >= floors[i, k]), negatives)] = True
        return i[keep], j[keep]

    pairs = first.unionByName(_cells(rows, opened, hard, grid))
    return read_windows(pairs, positives, negatives, low)


def least_score(top, low: int):
    """The least whole number n with 100 n >= low x top, for tops of 0 or more."""
    whole, rest = top // 100, top % 100
    return whole * low + (rest * low + 99) // 100


def read_windows(pairs: DataFrame, positives: int, negatives: int, low: int) -> DataFrame:
    """The secondary sort, and the stream that opens windows and emits negatives."""
    keys = ["anchor_id", F.col("score").desc(), "negative", "id"]
    dealt = pairs.repartition("anchor_id").sortWithinPartitions(*keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, opened, begun = None, [], 0
        for b in batches:
            out: list[tuple] = []
            for at, i, score, negative in zip(*[c.to_pylist() for c in b.columns]):
                if at != anchor:
                    anchor, opened, begun = at, [], 0
                if not negative:
                    if begun < positives:
                        begun += 1
                        if score >= 0:
                            opened.append([i, score, least_score(score, low), 0])
                    continue
                opened = [w for w in opened if score >= w[2] and w[3] < negatives]
                for w in opened:
                    w[3] += 1
                    out.append((at, w[0], w[3], i, w[1], score))
            cols = list(zip(*out)) or [()] * 6
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            names = [c.split()[0] for c in _RESULT.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

    return dealt.select("anchor_id", "id", "score", "negative").mapInArrow(run, _RESULT)
