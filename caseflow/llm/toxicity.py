"""Toxicity by two class-conditional Kneser-Ney models.

Words, in lower case and without ASCII punctuation and digits, are spelled out as bytes
between a start and an end mark.  Each class (toxic,
ordinary) has its own counts for the longest byte sequences and for those that begin
a word; all shorter sequences share one set of continuation counts, so a rare
expression is smoothed the same way in both classes and cannot tip the scale by being
rare.  A text's evidence is the difference of the two log-likelihoods, normalised by
its length; a logistic curve fitted on labelled rows outside the counts turns it into
a score between 0 and 1.

Counting is a Spark job over every labelled training row.  Counts stay exact, keyed by a
64-bit hash: what goes to the executors is as long as the sequences are many, about ten bytes
each, packed where they were counted.

Edge cases: a null or empty text has no words and gets the curve's value for no
evidence; null or unknown labels are not learned from; a doc_id labelled twice is toxic
if any of its labels is; repeated documents are scored (and learned from) row by row;
rows with a null doc_id are scored, never learned from; without labels of both classes
every score is 0.  Only the named columns are read, so others may carry any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard as zstd
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F, types as T

from caseflow.llm import common as C

ORDER = 8
DISCOUNT = 0.75
#: Training fold kept out of the counts, for the calibration curve.
CALIBRATION_FOLD = 4
CALIBRATION_ROWS = 20_000
_CACHE = 400_000
_START, _END = b"\x02", b"\x03"
_DROPPED = "".join(map(chr, (*range(33, 65), *range(91, 97), *range(123, 127))))
_K = np.uint64(0x9E3779B97F4A7C15)
_SEED = np.uint64(0x51_7C_C1_B7_27_22_0A_95)
_UNDO = np.uint64(pow(int(_K), -1, 1 << 64))


def _spelled(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all words with their marks, where each word starts, place inside the word."""
    text = np.frombuffer(b"".join([_START + w + _END for w in words]), np.uint8)
    lens = np.fromiter(map(len, words), np.int64, len(words)) + 2
    starts = np.cumsum(lens) - lens
    return text.astype(np.uint64) + np.uint64(1), starts, np.arange(len(text)) - np.repeat(starts, lens)


def _sequences(text: np.ndarray, order: int) -> Iterator[np.ndarray]:
    """For n = 0 .. order, the hash of the n bytes that end at each position."""
    h = np.full(len(text), _SEED)
    yield h
    for _ in range(order):
        before = np.empty_like(h)
        before[0], before[1:] = _SEED, h[:-1]
        h = before * _K + text
        yield h


def words_of(text: str | None) -> list[bytes]:
    if not text:
        return []
    return text.lower().encode("utf-8", "replace").translate(None, _DROPPED.encode()).split()


def count_sequences(words: DataFrame, order: int = ORDER) -> DataFrame:
    """Occurrences of byte sequences by class, from rows (word, c0, c1).

    A row per sequence: ``gram``, its 64-bit hash; ``shape``, its length, first and last
    byte, from which the hashes of its parts follow; ``a0`` and ``a1``.
    """

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ws = [w.encode("utf-8", "replace") for w in b.column(0).to_pylist()]
            if not ws:
                continue
            c0, c1 = (np.asarray(b.column(i).to_numpy(zero_copy_only=False), np.int64) for i in (1, 2))
            text, starts, place = _spelled(ws)
            lens = np.diff(np.append(starts, len(text)))
            c0, c1 = np.repeat(c0, lens), np.repeat(c1, lens)
            for n, h in enumerate(_sequences(text, order)):
                at = np.nonzero(place >= n - 1)[0]
                if n < 2 or not len(at):
                    continue
                gram, first, inv = np.unique(h[at], return_index=True, return_inverse=True)
                one = at[first]
                shape = (n << 18 | text[one - n + 1].astype(np.int64) << 9 | text[one].astype(np.int64)).astype(np.int32)
                counts = [np.bincount(inv, c[at], len(gram)).astype(np.int64) for c in (c0, c1)]
                cols = [gram.view(np.int64), shape, *counts]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["gram", "shape", "c0", "c1"])

    spelled = words.select("word", "c0", "c1").mapInArrow(spell, "gram bigint, shape int, c0 bigint, c1 bigint")
    return spelled.groupBy("gram", "shape").agg(F.sum("c0").alias("a0"), F.sum("c1").alias("a1"))


def keyed_counts(sequences: DataFrame, order: int = ORDER) -> DataFrame:
    """key, context (all but the last byte), a0 and a1 of every sequence the model keeps.

    Each class keeps its own count where the sequence begins a word or has full length;
    a shorter one counts how many different bytes precede it, whatever the class.
    """

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(order, _K)]))
        for b in batches:
            gram, shape, a0, a1 = (b.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            gram, n = gram.view(np.uint64), shape >> 18
            first, last = ((shape >> k & 511).astype(np.uint64) for k in (9, 0))
            suffix = gram - (_SEED * powers[n] + first * powers[n - 1]) + _SEED * powers[n - 1]
            top = (first == _START[0] + 1) | (n == order)
            ones = np.ones(len(gram), np.int64)
            for key, end, x0, x1 in ((gram[top], last[top], a0[top], a1[top]), (suffix, last, ones, ones)):
                cols = [key.view(np.int64), ((key - end) * _UNDO).view(np.int64), x0, x1]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["key", "context", "a0", "a1"])

    rows = sequences.mapInArrow(entries, "key bigint, context bigint, a0 bigint, a1 bigint")
    return rows.groupBy("key", "context").agg(F.sum("a0").alias("a0"), F.sum("a1").alias("a1"))


class Table:
    """Counts by 64-bit key, from pieces packed on the executors."""

    def __init__(self, pieces: list[tuple[bytes, bytes]], width: int):
        keys = np.concatenate([np.zeros(0, np.uint64), *(np.frombuffer(k, np.uint64) for k, _ in pieces)])
        rows = [np.frombuffer(zstd.decompress(c), np.int64).reshape(width, -1).T.astype(np.float32) for _, c in pieces]
        by = np.argsort(keys)
        self.keys, self.counts = keys[by], np.concatenate([np.zeros((0, width), np.float32), *rows])[by]

    def of(self, keys: np.ndarray) -> np.ndarray:
        """The counts of each key, 0 where it was never counted."""
        if not len(self.keys):
            return np.zeros((len(keys), self.counts.shape[1]), np.float32)
        one, inv = np.unique(keys, return_inverse=True)
        at = np.minimum(np.searchsorted(self.keys, one), len(self.keys) - 1)
        return np.where((self.keys[at] == one)[:, None], self.counts[at], np.float32(0))[inv]


class Model:
    """Counts of sequences; totals and kinds of what follows a context.  Unpacked at first use."""

    def __init__(self, sequences: list, contexts: list, order: int):
        self.packed, self.order, self.tables = (sequences, contexts), order, None

    def differences(self, words: list[bytes]) -> np.ndarray:
        """log P(word | toxic) - log P(word | ordinary), word by word."""
        if not words:
            return np.zeros(0, np.float32)
        if self.tables is None:
            self.tables = Table(self.packed[0], 2), Table(self.packed[1], 4)
            self.packed = None
        own, after = self.tables
        text, starts, place = _spelled(words)
        p = np.full((len(text), 2), 1 / 257, np.float32)
        alive = place > 0  # a context that was never seen has no longer one that was
        before = None
        for n, h in enumerate(_sequences(text, self.order)):
            if n:
                at = np.nonzero(alive & (place >= n - 1))[0]
                facts = after.of(before[at - 1])
                seen = facts[:, :2].any(axis=1)
                alive[at[~seen]] = False
                at, facts = at[seen], facts[seen]
                t, kinds = facts[:, :2], facts[:, 2:]
                a = np.maximum(own.of(h[at]) - np.float32(DISCOUNT), 0)
                q = (a + np.float32(DISCOUNT) * kinds * p[at]) / np.maximum(t, 1)
                p[at] = np.where(t > 0, np.clip(q, 1e-12, 1), p[at])
            before = h
        logs = np.log(p)
        diff = np.where(place > 0, logs[:, 1] - logs[:, 0], 0)
        return np.add.reduceat(diff, starts).astype(np.float32)


def _packed(counts: DataFrame) -> list[tuple[bytes, bytes]]:
    """Rows (key, counts ...) as pieces of bytes: nothing is unpacked on the driver."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, *cols = (c.to_numpy(zero_copy_only=False).astype(np.int64) for c in b.columns)
            made = [keys.tobytes(), zstd.compress(np.concatenate(cols).tobytes(), 3)]
            yield pa.RecordBatch.from_arrays([pa.array([m], pa.binary()) for m in made], names=["keys", "counts"])

    got = counts.mapInArrow(pack, "keys binary, counts binary").toArrow()
    return list(zip(got.column("keys").to_pylist(), got.column("counts").to_pylist()))


def fit_model(words: DataFrame, order: int = ORDER) -> Model:
    """Kneser-Ney counts from rows (word, c0, c1), every sequence by itself."""
    counts = C.stored(keyed_counts(count_sequences(words, order), order), "toxicity-counts")
    sums = [F.sum(a).alias(a) for a in ("a0", "a1")]
    kinds = [F.sum((F.col(a) > 0).cast("bigint")).alias("k" + a) for a in ("a0", "a1")]
    own = _packed(counts.select("key", "a0", "a1"))
    return Model(own, _packed(counts.groupBy("context").agg(*sums, *kinds)), order)


FEATURES = ["n_words", "f_mean", "f_clipped", "f_root", "f_rate", "f_top", "f_strong"]


def _features(d: np.ndarray) -> list[float]:
    """Of the word-wise differences of a text, by ``FEATURES``: lengths divide all sums."""
    n = max(1, len(d))
    above = float(np.maximum(d - 1, 0).sum())
    top = np.partition(d, -3)[-3:] if len(d) > 3 else d
    return [
        len(d), float(d.sum()) / n, float(np.maximum(d, -0.3).sum()) / n, above / n**0.5, above / n,
        float(top.mean()) if len(d) else 0.0, float(np.log1p((d > 3).sum())),
    ]


def evidence(docs: DataFrame, shared: Broadcast, keep: list[str], text_col: str) -> DataFrame:
    """Length-normalised log-likelihood differences of each whole text, by the ``Model`` in ``shared``."""
    known: dict[bytes, float] = {}

    def measure(texts: list) -> dict:
        model = shared.value  # a worker unpacks it once, for all its tasks
        rows = []
        for at in range(0, len(texts), 256):
            listed = [words_of(t) for t in texts[at : at + 256]]
            if len(known) > _CACHE:
                known.clear()
            new = list(set().union(*listed).difference(known))
            for i in range(0, len(new), 50_000):
                part = new[i : i + 50_000]
                known.update(zip(part, model.differences(part).tolist()))
            rows += [_features(np.fromiter(map(known.__getitem__, ws), np.float64, len(ws))) for ws in listed]
        return {name: [r[k] for r in rows] for k, name in enumerate(FEATURES)}

    schema = T.StructType([
        T.StructField(n, T.LongType() if n == "n_words" else T.DoubleType()) for n in FEATURES
    ])
    return C.map_text(docs, keep, text_col, schema, measure)


def score(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    keep: list[str] | None = None,
) -> DataFrame:
    """Every row of ``docs`` with n_words, the evidence, score (0 to 1) and predicted (0 or 1).

    ``keep`` names the columns to carry along (default: the id).
    """
    keep = keep or [id_col]
    marks = (
        labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("_id"))
        .agg(F.max(label_col).cast("int").alias("_toxic"))
    )
    mine = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    mine = mine.where((C.fold("_id") != 0) & F.col("_text").isNotNull())
    counted = mine.where(C.fold("_id") != CALIBRATION_FOLD).join(marks, "_id")
    words = (
        counted.select(F.translate(F.lower("_text"), _DROPPED, "").alias("_text"), "_toxic")
        .select(F.explode(F.split("_text", "[\\x09-\\x0D\\x20]+")).alias("word"), "_toxic")
        .where("word <> ''")
        .groupBy("word")
        .agg(
            F.sum(1 - F.col("_toxic")).alias("c0"),
            F.sum("_toxic").alias("c1"),
        )
    )
    shared = docs.sparkSession.sparkContext.broadcast(fit_model(words))
    chosen = C.bounded_sample(
        marks.where((C.fold("_id") == CALIBRATION_FOLD)), "_toxic", "_id", CALIBRATION_ROWS
    )
    fitted = evidence(mine.join(F.broadcast(chosen), "_id"), shared, ["_toxic"], "_text").toArrow()
    y = fitted.column("_toxic").to_numpy()
    x = _design(*[fitted.column(n).to_numpy() for n in FEATURES])
    weights = C.fit_logistic(x, y).tolist() if 0 < y.sum() < len(y) else None

    got = evidence(docs, shared, keep, text_col)
    if weights is None:
        value = F.lit(0.0)
    else:
        terms = [*[F.col(n) for n in FEATURES[1:]], F.log1p("n_words")]
        z = sum((F.lit(w) * t for w, t in zip(weights, terms)), F.lit(weights[-1]))
        value = 1 / (1 + F.exp(-F.greatest(F.lit(-40.0), F.least(F.lit(40.0), z))))
    return got.withColumn("score", value.cast("double")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int")
    )


def _design(n: np.ndarray, *others: np.ndarray) -> np.ndarray:
    return np.column_stack([*others, np.log1p(n)]).astype(np.float64)


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, all columns, that are not predicted toxic."""
    rows = docs.select(F.struct("*").alias("_row"), F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    marks = labels.select(F.col(id_col).alias("_id"), "toxic")
    got = score(rows, marks, "_id", "_text", keep=["_row"])
    return got.where("predicted = 0").select("_row.*")
