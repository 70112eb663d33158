"""Near-duplicate documents by MinHash with tensored banding, confirmed on full sets.

A document's set holds its distinct k-word shingles (k, threshold: parameters).  Two small
collections of ``half`` keys, ``ROWS`` minhashes each, are computed; every pair of a key
from one and a key from the other is a table key, so ``half**2`` tables cost
``2 * half * ROWS`` minhashes.  ``half`` follows from the threshold so that a pair at the
threshold shares no table with probability below ``MISS``.

Documents with equal sets are merged first.  In a table bucket every member is compared
with one pivot, the member most often met by others: links grow with the members, not with
their pairs.  Most groups are settled there.  Where a pivot's members do not all fall into
one component, some may still be linked to each other but not to it.  They are compared
through their differences to the pivot, which are short: a shingle index over the
differences counts, for each unlinked member, what it shares with all others at once, and
|X & Y| = |P| - lacks(x) - lacks(y) + shared differences gives the exact verdict.  Large
memberships are dealt out in blocks of bounded size, a pair of blocks at a time, and only
links between different components leave a task, a spanning forest of them at most.

Edge cases: null or empty texts have no set, stand alone and are kept; fewer than k words
make one shingle of the whole sequence; repeated rows of an id fall together; a null id
cannot be linked or named: such rows come back with null component and are kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from caseflow.llm import common as C
from caseflow.llm.components import connected_components

ROWS = 2
MISS = 5e-5
#: Most members, and most shingles of members, of a block on average.
BLOCK = 1000
BLOCK_SHINGLES = 2_000_000
_MIX = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xBF58476D1CE4E5B9)]


def half_tables(threshold: float, rows: int = ROWS, miss: float = MISS) -> int:
    """Keys per collection so that one collection misses a pair at the threshold this rarely."""
    return math.ceil(math.log(miss) / math.log1p(-(threshold**rows)))


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _MIX[2]
    return h ^ (h >> np.uint64(29))


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles of a whole text."""
    words = text.encode("utf-8", "replace").lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    n = len(words)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    width = min(n, k)
    s = np.full(n - width + 1, width, np.uint64) * _MIX[1]
    for i in range(width):
        s = _mix(s * _MIX[0] + h[i : n - width + 1 + i])
    return np.unique(s)


def _factors(count: int) -> np.ndarray:
    """Odd multipliers, each a different order of 64-bit values."""
    drawn = np.random.default_rng(20240229).integers(1, 2**63, count, dtype=np.uint64)
    return drawn * np.uint64(2) + np.uint64(1)


def half_keys(s: np.ndarray, factors: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """The keys of both collections, each from ``rows`` minhashes."""
    least = np.full(len(factors), np.iinfo(np.uint64).max)
    for at in range(0, len(s), 1024):
        least = np.minimum(least, (s[at : at + 1024, None] * factors[None, :]).min(axis=0))
    keys = np.zeros(len(factors) // rows, np.uint64)
    for r in range(rows):
        keys = _mix(keys * _MIX[0] + least.reshape(-1, rows)[:, r])
    return keys


def signatures(docs: DataFrame, id_col: str, text_col: str, k: int, half: int) -> DataFrame:
    """id, n_shingles, a 128-bit digest of the set (x1, x2) and the half keys (left, right)."""
    factors = _factors(2 * half * ROWS)

    def sign(texts: list) -> dict:
        out = {n: [] for n in ("n_shingles", "x1", "x2", "left", "right")}
        for t in texts:
            s = shingle_set(t, k)
            digest = np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64)
            keys = half_keys(s, factors).view(np.int64).tolist() if len(s) else []
            out["n_shingles"].append(len(s))
            out["x1"].append(int(digest[0]))
            out["x2"].append(int(digest[1]))
            out["left"].append(keys[:half])
            out["right"].append(keys[half:])
        return out

    longs = T.ArrayType(T.LongType())
    schema = T.StructType([
        *[T.StructField(n, T.LongType()) for n in ("n_shingles", "x1", "x2")],
        T.StructField("left", longs), T.StructField("right", longs),
    ])
    return C.map_text(docs, [id_col], text_col, schema, sign)


def _buckets(reps: DataFrame) -> DataFrame:
    """(bucket, id, size): members of table buckets that hold at least two documents.

    Both halves of such a bucket's key are shared, so only shared halves are multiplied.
    """
    half = lambda side: F.transform(side, lambda key, at: F.xxhash64(F.lit(side), at, key))
    sides = [reps.select("id", F.lit(s).alias("side"), F.explode(half(s)).alias("half")) for s in ("left", "right")]
    halves = sides[0].unionByName(sides[1])
    common = halves.groupBy("half").agg(F.count("*").alias("size")).where("size > 1")
    halves = C.stored(halves.join(common, "half", "left_semi"), "near-halves")
    left, right = (halves.where(F.col("side") == s).select("id", F.col("half").alias(s)) for s in ("left", "right"))
    rows = C.stored(left.join(right, "id").select("id", F.xxhash64("left", "right").alias("bucket")), "near-tables")
    shared = rows.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    return C.stored(rows.join(shared, "bucket"), "near-buckets")


def _stars(members: DataFrame, rank: DataFrame) -> DataFrame:
    """(pivot, id): every member with the first of its bucket by rank; rows: bucket, id."""
    first = (
        members.join(rank, "id")
        .groupBy("bucket")
        .agg(F.max(F.struct("score", (-F.col("id")).alias("least"))).alias("top"))
        .select("bucket", (-F.col("top.least")).alias("pivot"))
    )
    return members.join(first, "bucket").where("id <> pivot").select("pivot", "id").distinct()


def _linked(both: int, x: int, y: int, num: int, den: int) -> bool:
    return den * both >= num * (x + y - both)


def _compare(stars: DataFrame, texts: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """(pivot, id, linked, size): verdicts on full sets, and the size of the member's set."""
    names = ["pivot", "id", "linked", "size"]
    kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int64()]

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, pivots = None, []
        for b in C.few_rows(batches):
            rows = []
            for pivot, at, i, text in zip(*[c.to_pylist() for c in b.columns]):
                if (pivot, at) != key:
                    key, pivots = (pivot, at), []
                x = shingle_set(text, k)
                if i == pivot:
                    pivots.append(x)  # more than one where an id is repeated
                    continue
                for p in pivots:
                    both = len(np.intersect1d(x, p, assume_unique=True))
                    rows.append((pivot, i, _linked(both, len(x), len(p), num, den), len(x)))
            cols = list(zip(*rows)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(x, y) for x, y in zip(cols, kinds)], names=names)

    # a pivot's text goes once before each slice of its members
    slices = stars.groupBy("pivot").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("slices"))
    heads = slices.select(
        "pivot", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"), F.col("pivot").alias("id")
    )
    mine = stars.join(slices, "pivot")
    mine = mine.select("pivot", F.pmod(F.xxhash64("id"), "slices").cast("int").alias("slice"), "id")
    rows = heads.unionByName(mine).join(texts, "id").repartition("pivot", "slice")
    rows = rows.sortWithinPartitions("pivot", "slice", F.col("id") != F.col("pivot"), "id")
    rows = rows.select("pivot", "slice", "id", "text")
    return rows.mapInArrow(check, "pivot bigint, id bigint, linked boolean, size bigint")


def _open_members(seen: DataFrame, parts: DataFrame) -> DataFrame:
    """(pivot, low, high, id, linked, part): members of pivots that leave pairs open, a row per
    pair of blocks; a row with the pivot's own id begins each."""
    rows = seen.join(parts, F.col("id") == F.col("node"), "left")
    rows = rows.select("pivot", "id", "linked", "size", F.coalesce("component", "id").alias("part"))
    left = rows.groupBy("pivot").agg(
        F.min("linked").alias("all"),
        F.min("part").alias("least"),
        F.max("part").alias("most"),
        F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("size") / BLOCK_SHINGLES)).cast("int").alias("blocks"),
    )
    left = left.where("not all and least < most").select("pivot", "blocks")
    rows = rows.join(left, "pivot").withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
    rows = rows.select("pivot", low, high, "id", "linked", "part", "block")
    heads = rows.select("pivot", "low", "high").distinct()
    heads = heads.select(
        "pivot", "low", "high", F.col("pivot").alias("id"), F.lit(True).alias("linked"),
        F.lit(None).cast("bigint").alias("part"), F.lit(-1).alias("block"),
    )
    return rows.unionByName(heads)


def links_in_block(p: np.ndarray, sets: list, linked: list, parts: list, blocks: list, num: int, den: int):
    """(i, j) of members of a pivot that are linked and in different components: a forest of links.

    Members of different blocks are compared, or all if there is one block.
    """
    lacks, differences = [], []
    for x in sets:
        shared = np.isin(x, p, assume_unique=True)
        minus = p[~np.isin(p, x, assume_unique=True)]
        lacks.append(len(minus))
        differences.append(np.concatenate([x[~shared], minus]))
    lens = np.array([len(d) for d in differences])
    sizes, lacks = np.array([len(x) for x in sets]), np.array(lacks)
    _, code = np.unique(np.concatenate(differences), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), lens)
    order = np.argsort(code, kind="stable")
    postings = owner[order]
    ends = np.cumsum(np.bincount(code)) if len(code) else np.zeros(0, np.int64)
    begins = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    offsets = np.concatenate([[0], np.cumsum(lens)])
    root = {part: part for part in parts}
    blocks = np.array(blocks)
    apart = len(set(blocks.tolist())) > 1

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i in range(len(sets)):
        if linked[i]:
            continue
        mine = code[offsets[i] : offsets[i + 1]]
        met = [postings[begins[c] : ends[c]] for c in mine[ends[mine] - begins[mine] > 1]]
        shared = np.bincount(np.concatenate(met), minlength=len(sets)) if met else np.zeros(len(sets), np.int64)
        both = len(p) - lacks[i] - lacks + shared
        good = den * both >= num * (sizes[i] + sizes - both)
        if apart:
            good &= blocks != blocks[i]
        for j in np.nonzero(good)[0].tolist():
            a, b = find(parts[i]), find(parts[j])
            if j != i and a != b:
                root[max(a, b)] = min(a, b)
                yield i, j


def _settle(open_: DataFrame, texts: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """(pivot, id): links among members of a pivot that lie in different components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, p, rows = None, None, []

        def done() -> pa.RecordBatch:
            ids, linked, parts, blocks, sets = zip(*rows)
            found = list(links_in_block(p, list(sets), linked, parts, blocks, num, den))
            cols = [[ids[i] for i, _ in found], [ids[j] for _, j in found]]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["pivot", "id"])

        for b in C.few_rows(batches):
            for pivot, low, high, block, i, linked, part, text in zip(*[c.to_pylist() for c in b.columns]):
                if (pivot, low, high) != key:
                    if len(rows) > 1:
                        yield done()
                    key, rows = (pivot, low, high), []
                if block < 0:
                    p = shingle_set(text, k)
                else:
                    rows.append((i, linked, part, block, shingle_set(text, k)))
        if len(rows) > 1:
            yield done()

    d = open_.join(texts, "id").repartition(F.col("pivot"), F.col("low"), F.col("high"))
    d = d.sortWithinPartitions("pivot", "low", "high", "block", "id")
    d = d.select("pivot", "low", "high", "block", "id", "linked", "part", "text")
    return d.mapInArrow(run, "pivot bigint, id bigint")


def find_links(reps: DataFrame, texts: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """(pivot, id): links that join all linked documents; reps: id, left, right; texts: id, text."""
    members = _buckets(reps)
    rank = C.stored(members.groupBy("id").agg(F.sum("size").alias("score")), "near-rank")
    texts = C.stored(texts.join(rank, "id", "left_semi"), "near-texts")
    stars = C.stored(_stars(members.select("bucket", "id"), rank), "near-stars")
    seen = C.stored(_compare(stars, texts, k, num, den), "near-compared")
    links = seen.where("linked").select("pivot", "id")
    parts = connected_components(links, "pivot", "id")
    more = C.stored(_settle(_open_members(seen, parts), texts, k, num, den), "near-settled")
    return links.unionByName(more)


def near_duplicates(
    docs: DataFrame,
    k: int = 5,
    num: int = 80,
    den: int = 100,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """id, n_shingles, component_id and kept for every row; linked when |A & B| * den >= num * |A | B|."""
    sig = C.stored(signatures(docs, id_col, text_col, k, half_tables(num / den)), "near-signatures")
    sig = sig.withColumnRenamed(id_col, "id")
    real = sig.where("n_shingles > 0 and id is not null")
    # one row per set, of its smallest id; copies meet in every task before they are shuffled
    classes = C.stored(
        real.groupBy("x1", "x2").agg(F.min(F.struct("id", "left", "right")).alias("rep")).select("x1", "x2", "rep.*"),
        "near-classes",
    )
    reps, classes = classes.select("id", "left", "right"), classes.select("x1", "x2", F.col("id").alias("rep"))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    links = find_links(reps, texts, k, num, den)
    copies = real.join(classes, ["x1", "x2"]).where("id <> rep").select(F.col("rep").alias("pivot"), "id").distinct()
    parts = connected_components(links.unionByName(copies), "pivot", "id")
    out = sig.join(parts, sig["id"] == parts["node"], "left")
    component = F.coalesce("component", "id")
    return out.select(
        F.col("id").alias(id_col),
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """One row of each group of near-duplicates, all columns: that of the smallest id.

    Rows with a null id cannot be told apart and stay.
    """
    kept = near_duplicates(docs, id_col=id_col, text_col=text_col, **params)
    kept = kept.where(F.col("kept") & F.col(id_col).isNotNull()).select(F.col(id_col).alias("_id")).distinct()
    rows = docs.select(F.struct("*").alias("_row"), F.col(id_col).alias("_mine"))
    one = rows.join(kept, F.col("_mine") == F.col("_id"), "left_semi").dropDuplicates(["_mine"])
    return one.unionByName(rows.where("_mine is null")).select("_row.*")
