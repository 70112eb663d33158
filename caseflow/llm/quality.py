"""Quality rules: plain counts, and a hashed n-gram logistic regression.

Words and character triples of a text are hashed into ``BUCKETS`` weights each; a text's
value is the mean weight of its words plus the mean weight of its triples, so length
alone moves nothing.  Weights are fitted on a bounded sample of labelled rows
(``TRAIN_ROWS`` a class, in a fixed pseudo-random order), a logistic curve fitted on
another fold turns the value into a probability, and fixed thresholds decide.

Base counts, with words as runs of anything but ASCII white space:
word_chars, code points in words; n_symbols, characters of ``[#*$%&|<>]``; n_dup_lines,
lines with a word that equal an earlier line; n_repeat_words, words in windows of three
words found at least twice in the text.

Edge cases: a null text counts as empty and fails the base rules; labels other than 0
and 1 and null ids are not learned from; a doc_id labelled twice takes its lowest label;
without labels of both classes the base rules alone decide; repeated rows are judged row
by row.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from caseflow.llm import common as C

BUCKETS = 1 << 15
TRAIN_ROWS = 2_000
CALIBRATION_ROWS = 5_000
CALIBRATION_FOLD = 4
#: A text is kept from this probability of good quality on.
THRESHOLD = 0.5
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
_EPOCHS, _RATE, _L2 = 200, 0.5, 1e-6
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    if not text:
        return 0, 0, 0, 0, 0
    data = text.encode("utf-8", "replace")
    words = data.split()
    raw = np.frombuffer(data, np.uint8)
    # code points are bytes that do not continue one; white space is one byte each
    blanks = int(((raw == 32) | ((raw >= 9) & (raw <= 13))).sum())
    chars = int(((raw & 0xC0) != 0x80).sum()) - blanks
    lines = [x for x in data.split(b"\n") if x.strip()]
    return (
        len(words), chars, int(_SYMBOLS[raw].sum()), len(lines) - len(set(lines)), _repeated(words),
    )


def _repeated(words: list[bytes]) -> int:
    if len(words) < 4:
        return 0
    ids: dict[bytes, int] = {}
    at = np.fromiter([ids.setdefault(w, len(ids)) for w in words], np.int64, len(words))
    pair = _numbered(at[:-1] * len(ids) + at[1:])
    triple = _numbered(pair[:-1] * len(ids) + at[2:])
    again = np.bincount(triple)[triple] > 1
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[k : k + len(again)] |= again
    return int(covered.sum())


def _numbered(values: np.ndarray) -> np.ndarray:
    """Dense numbers for equal values, so that products stay small."""
    return np.unique(values, return_inverse=True)[1]


def hashed(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words and of the byte triples of a text."""
    data = text.encode("utf-8", "replace") if text else b""
    words = data.split()
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    raw = np.frombuffer(b" ".join(words), np.uint8).astype(np.uint32)
    if len(raw) < 3:
        return (w % np.uint64(BUCKETS)).astype(np.int64), np.zeros(0, np.int64)
    code = (raw[:-2] << np.uint32(16)) | (raw[1:-1] << np.uint32(8)) | raw[2:]
    code = (code * np.uint32(0x9E3779B1)) >> np.uint32(17)
    return (w % np.uint64(BUCKETS)).astype(np.int64), code.astype(np.int64)


def value(text: str | None, weights: np.ndarray) -> float:
    words, triples = hashed(text)
    out = float(weights[words].mean()) if len(words) else 0.0
    return out + (float(weights[BUCKETS + triples].mean()) if len(triples) else 0.0)


def fit_weights(texts: list[str], y: np.ndarray) -> np.ndarray:
    """Logistic regression by full-batch Adagrad on the bounded sample, classes weighted evenly."""
    cols, vals, lens = [], [], []
    for t in texts:
        words, triples = hashed(t)
        n = 0
        for part, start in ((words, 0), (triples, BUCKETS)):
            if len(part):
                kinds, times = np.unique(part, return_counts=True)
                cols.append((kinds + start).astype(np.int32))
                vals.append((times / len(part)).astype(np.float32))
                n += len(kinds)
        lens.append(n)
    size = 2 * BUCKETS
    w, bias, grown = np.zeros(size), 0.0, np.full(size, 1e-8)
    if not cols or not 0 < y.sum() < len(y):
        return w
    col, val = np.concatenate(cols), np.concatenate(vals)
    row = np.repeat(np.arange(len(texts)), lens)
    even = np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    for _ in range(_EPOCHS):
        z = np.bincount(row, w[col] * val, len(texts)) + bias
        g = (C.sigmoid(z) - y) * even
        grad = np.bincount(col, g[row] * val, size) + _L2 * w
        grown += grad**2
        w -= _RATE * grad / np.sqrt(grown)
        bias -= 2.0 * g.sum()
    return w


def judge(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    keep: list[str] | None = None,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Per row: the base counts, base_failed, probability of good quality and kept."""
    keep = keep or [id_col]
    marks = (
        labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & (C.fold(id_col) != 0))
        .groupBy(F.col(id_col).alias("_id"))
        .agg(F.min(label_col).cast("int").alias("_good"))
    )
    fit = C.bounded_sample(marks.where(C.fold("_id") != CALIBRATION_FOLD), "_good", "_id", TRAIN_ROWS)
    tune = marks.where(C.fold("_id") == CALIBRATION_FOLD)
    tune = C.bounded_rows(tune, "_id", CALIBRATION_ROWS)
    mine = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))

    got = mine.join(F.broadcast(fit), "_id").select("_id", "_good", "_text").toArrow().to_pylist()
    got.sort(key=lambda r: (r["_id"], r["_text"] or ""))
    y = np.array([r["_good"] for r in got], np.float64)
    shared = docs.sparkSession.sparkContext.broadcast(fit_weights([r["_text"] for r in got], y))

    schema = T.StructType([T.StructField("value", T.DoubleType())])
    tuned = C.map_text(
        mine.join(F.broadcast(tune), "_id"), ["_good"], "_text", schema,
        lambda texts: {"value": [value(t, shared.value) for t in texts]},
    ).toArrow()
    x, good = tuned.column("value").to_numpy(), tuned.column("_good").to_numpy()
    curve = C.fit_logistic(x[:, None], good).tolist() if 0 < good.sum() < len(good) else None

    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def measure(texts: list) -> dict:
        counts = [base_counts(t) for t in texts]
        out = {n: [c[k] for c in counts] for k, n in enumerate(names)}
        out["value"] = [value(t, shared.value) for t in texts]
        return out

    schema = T.StructType([
        *[T.StructField(n, T.LongType()) for n in names], T.StructField("value", T.DoubleType())
    ])
    judged = C.map_text(docs, keep, text_col, schema, measure)
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    if curve is None:
        p = F.lit(1.0)
    else:
        p = 1 / (1 + F.exp(-F.greatest(F.lit(-40.0), F.least(F.lit(40.0), F.col("value") * curve[0] + curve[1]))))
    return (
        judged.withColumn("base_failed", failed)
        .withColumn("probability", p.cast("double"))
        .withColumn("kept", ~F.col("base_failed") & (F.col("probability") >= threshold))
        .drop("value")
    )
