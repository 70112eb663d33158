"""Benchmark decontamination by template windows.

Tokens are words without their punctuation.  Numbers, units and names become
typed placeholders; other words count in lower case.  Windows of ``WINDOW`` tokens, of
which ``LITERAL`` at least are plain words, are hashed for every benchmark item and every
document and joined by hash; so a question with other numbers or names still meets its
item.  Windows of a document that line up with an item form a passage.  It counts when
the values in its slots are consistent (each value of the item always stands for the same
value) and it is at least ``RUN`` tokens long, or as long as the item.  Windows are also
taken over the plain lower-case words, for copies that lost their capitals.

Before the join a bitmap of fixed size (``BITS``) of the items' window hashes sifts the
documents' windows; it passes every true match, and the join decides.

Edge cases: null and empty texts have no windows; an item shorter than ``WINDOW`` is one
window of its whole length, below ``LITERAL`` tokens it is too short to be recognised;
repeated items and documents match row by row and fall together by id; null ids of
documents are never contaminated, as nothing could name them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from caseflow.llm import common as C

WINDOW = 8
LITERAL = 4
RUN = 13
BITS = 1 << 22
#: Characters read at once.
_AT_ONCE = 200_000
#: Words taken as units. Fixed values.
UNITS = frozenset(
    "km m cm mm mi ft in yd kg g mg lb lbs oz l ml s sec min h hr hrs mph kmh ms gb mb kb hz khz "
    "percent dollars dollar cents cent euros euro pounds pound miles mile meters meter metres "
    "metre feet foot inches inch yards yard grams gram kilograms kilogram ounces ounce liters "
    "liter litres litre seconds second minutes minute hours hour days day weeks week months month "
    "years year degrees degree".split()
)
#: Number words. Fixed values.
NUMBERS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen "
    "fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty "
    "ninety hundred thousand million billion".split()
)
_MEASURE = re.compile(r"\d+([^\W\d_]{1,4})$")
#: Punctuation and blanks beyond ASCII; they part words.
_ODD = re.compile("[\u00a0-\u00bf\u2000-\u206f\u3000-\u303f]")
_K = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xBF58476D1CE4E5B9)]
#: Placeholders; words hash elsewhere.
NUM, UNIT, NAME, MEASURE = (np.uint64(k) for k in (1, 2, 3, 4))
_BASE = 0x2545F4914F6CDD1D


def _bytes(wanted: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(wanted)] = True
    return table


_SPACE = _bytes(b" \t\n\x0b\x0c\r")
_DIGIT = _bytes(b"0123456789")
_WORD = _DIGIT | _bytes(bytes(range(97, 123)) + bytes(range(128, 256)))
_STOP = _bytes(b".!?:;")


class Tokens(NamedTuple):
    """Plain and template hashes of the tokens of some texts, the number of the text each comes
    from, and where it lies in ``letters``."""

    plain: np.ndarray
    template: np.ndarray
    text: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    letters: np.ndarray

    def value(self, i: int) -> str:
        return self.letters[self.starts[i] : self.ends[i]].tobytes().decode("utf-8", "replace")


class Reader:
    """Turns texts into tokens, all bytes of several texts at once."""

    def __init__(self):
        self.powers = self.inverses = np.ones(1, np.uint64)
        self.units, self.numbers = (np.sort(self.read([" ".join(sorted(x))]).plain) if x else None for x in (UNITS, NUMBERS))

    units = numbers = None

    def _grow(self, n: int) -> None:
        if n > len(self.powers):
            n = 1 << n.bit_length()
            one = np.ones(1, np.uint64)
            self.powers = np.concatenate([one, np.cumprod(np.full(n - 1, _BASE, np.uint64))])
            self.inverses = np.concatenate([one, np.cumprod(np.full(n - 1, pow(_BASE, -1, 1 << 64), np.uint64))])

    def read(self, texts: list[str | None]) -> Tokens:
        """Words without punctuation; a word's hash does not depend on where it stands."""
        raws, smalls = [], []
        for text in texts:
            if not text:
                raws.append(b"")
                smalls.append(b"")
                continue
            if _ODD.search(text):
                text = _ODD.sub(" ", text)
            raw, small = text.encode("utf-8", "replace"), text.lower().encode("utf-8", "replace")
            if len(raw) != len(small):  # the few letters whose small form has another length stay
                same = (c.lower() if len(c.lower().encode()) == len(c.encode()) else c for c in text)
                small = "".join(same).encode("utf-8", "replace")
            raws.append(raw)
            smalls.append(small)
        raw, b = (np.frombuffer(b"\n".join(x), np.uint8) for x in (raws, smalls))
        bounds = np.cumsum([len(x) + 1 for x in raws])
        word = _WORD[b]
        kept = np.nonzero(word | _SPACE[b])[0]
        letters, small, inside = raw[kept], b[kept], word[kept]
        edge = np.diff(np.concatenate([[False], inside, [False]]).view(np.int8))
        starts, ends = np.nonzero(edge == 1)[0], np.nonzero(edge == -1)[0]
        if not len(starts):
            none = np.zeros(0, np.uint64)
            return Tokens(none, none, starts, starts, ends, letters)
        self._grow(len(small))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((small + np.uint64(1)) * self.powers[: len(small)])])
        h = (sums[ends] - sums[starts]) * self.inverses[starts] + (ends - starts).astype(np.uint64) * _K[1]
        h = (h ^ (h >> np.uint64(31))) * _K[2]
        plain = (h ^ (h >> np.uint64(29))) | np.uint64(1 << 63)
        template = plain.copy()

        # a capital first, small letters later, and no sentence begins here: a name
        capital = letters != small
        second = np.minimum(starts + 1, len(small) - 1)
        first = capital[starts] | (letters[starts] >= 0xC0) & capital[second]
        is_small = ~capital & ((small >= 97) & (small < 123) | (small >= 0x80) & (small < 0xC0))
        named = first & (np.add.reduceat(is_small, starts, dtype=np.int64) > 0)
        stop = _STOP[b]
        stop[:-1] &= ~word[1:]
        after = np.searchsorted(kept[starts], np.nonzero(stop)[0])  # words begun before a stop
        owner = np.searchsorted(bounds, kept[starts], side="right")
        begins = np.zeros(len(starts) + 1, bool)
        begins[0] = True
        begins[1:-1] = owner[1:] != owner[:-1]
        begins[after[after > 0]] = True
        template[named & ~begins[:-1]] = NAME

        digits = np.add.reduceat(_DIGIT[small], starts, dtype=np.int64)
        template[digits == ends - starts] = NUM
        for mark, known in ((NUM, self.numbers), (UNIT, self.units)):
            if known is not None:
                at = np.minimum(np.searchsorted(known, plain), len(known) - 1)
                template[known[at] == plain] = mark
        for i in np.nonzero((digits > 0) & (digits < ends - starts))[0].tolist():
            m = _MEASURE.match(small[starts[i] : ends[i]].tobytes().decode("utf-8", "replace"))
            if m and m[1] in UNITS:
                template[i] = MEASURE
        return Tokens(plain, template, owner, starts, ends, letters)


def windows(tokens: np.ndarray, size: int, begins: np.ndarray | None = None) -> np.ndarray:
    """A hash for each window of ``size`` tokens (or those at ``begins``); 0 where too few are plain words."""
    n = max(0, len(tokens) - size + 1) if begins is None else len(begins)
    h = np.full(n, size, np.uint64) * _K[1]
    literal = np.zeros(n, np.int8)
    for i in range(size):
        t = tokens[i : n + i] if begins is None else tokens[begins + i]
        h = h * _K[0] + t
        h = (h ^ (h >> np.uint64(31))) * _K[2]
        literal += t > MEASURE
    h ^= h >> np.uint64(29)
    return np.where(literal >= LITERAL, h | np.uint64(1), 0)


def _found(tokens: Tokens, sizes: list[int], bitmap: np.ndarray | None):
    """(text, hash, place in the text, size, slot values) of the windows of texts: of their
    templates, and of their plain words where these differ."""
    n = len(tokens.plain)
    marked = np.concatenate([[0], np.cumsum(tokens.plain != tokens.template)])
    heads = np.searchsorted(tokens.text, tokens.text)  # first token of each token's text
    for size in sizes:
        if n < size:
            continue
        inside = tokens.text[: n - size + 1] == tokens.text[size - 1 :]
        changed = np.nonzero(inside & (marked[size:] > marked[: n - size + 1]))[0]
        for kind, part, at in ((0, tokens.template, None), (1, tokens.plain, changed)):
            h = windows(part, size, at)
            good = (h != 0) & inside if at is None else h != 0
            if bitmap is not None:
                good &= bitmap[(h >> np.uint64(20)) & np.uint64(len(bitmap) - 1)]
            for k in np.nonzero(good)[0].tolist():
                i = k if at is None else int(at[k])
                slots = np.nonzero(part[i : i + size] <= MEASURE)[0].tolist()
                values = [tokens.value(i + j) for j in slots]
                yield int(tokens.text[i]), int(h[k].view(np.int64)), i - int(heads[i]), size, values


_SCHEMA = "id bigint, hash bigint, at int, size int, slots array<string>, n_tokens int"


def _emit(df: DataFrame, sizes, bitmap) -> DataFrame:
    """Windows of (id, text); sizes None: the item's own (``WINDOW``, or its length if shorter)."""
    shared = None if bitmap is None else df.sparkSession.sparkContext.broadcast(np.packbits(bitmap).tobytes())
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.string()), pa.int32()]
    names = [c.split()[0] for c in _SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, bits = Reader(), None
        if shared is not None:
            bits = np.unpackbits(np.frombuffer(shared.value, np.uint8)).astype(bool)

        def batch(ids: list, texts: list) -> pa.RecordBatch:
            rows: list[tuple] = []
            if sizes is None:  # every item has a size of its own
                for i, text in zip(ids, texts):
                    tokens = reader.read([text])
                    n = len(tokens.plain)
                    if n >= LITERAL:
                        rows += [(i, *w[1:], n) for w in _found(tokens, [min(n, WINDOW)], None)]
            else:
                rows = [(ids[w[0]], *w[1:], 0) for w in _found(reader.read(texts), sizes, bits)]
            cols = list(zip(*rows)) or [[]] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

        for b in batches:
            ids, texts, held = [], [], 0
            for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids.append(i)
                texts.append(text)
                held += len(text or "")
                if held > _AT_ONCE:
                    yield batch(ids, texts)
                    ids, texts, held = [], [], 0
            yield batch(ids, texts)

    return df.mapInArrow(run, _SCHEMA)


def matches(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    run: int = RUN,
) -> DataFrame:
    """(id, item_id, run_tokens, n_tokens): for each document and item the longest passage found."""
    items = benchmark.select(F.col(item_col).cast("bigint").alias("id"), F.col(item_text_col).alias("text"))
    items = C.stored(_emit(items.where("id is not null"), None, None), "benchmark-windows")
    sizes = [r["size"] for r in items.select("size").distinct().collect()]
    slot = F.shiftrightunsigned("hash", 20).bitwiseAND(F.lit(BITS - 1)).cast("int")
    bitmap = np.zeros(BITS, bool)
    bitmap[items.select(slot.alias("s")).distinct().toArrow().column("s").to_numpy()] = True
    mine = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")).where("id is not null")
    found = _emit(mine, sorted(sizes), bitmap).drop("n_tokens")
    met = found.join(
        items.select("hash", "size", F.col("id").alias("item_id"), F.col("at").alias("item_at"), F.col("slots").alias("item_slots"), "n_tokens"),
        ["hash", "size"],
    )
    pairs = F.arrays_zip(F.col("item_slots").alias("old"), F.col("slots").alias("new"))
    passages = met.groupBy("id", "item_id", (F.col("at") - F.col("item_at")).alias("shift")).agg(
        F.collect_set(F.struct("item_at", "size")).alias("places"),
        F.array_distinct(F.flatten(F.collect_set(pairs))).alias("pairs"),
        F.max("n_tokens").alias("n_tokens"),
    )
    covered = F.size(
        F.array_distinct(F.flatten(F.transform("places", lambda p: F.sequence(p["item_at"], p["item_at"] + p["size"] - 1))))
    )
    old = F.size(F.array_distinct(F.transform("pairs", lambda p: p["old"])))
    good = passages.withColumn("run_tokens", covered).where(
        (old == F.size("pairs")) & (F.col("run_tokens") >= F.least(F.lit(run), F.col("n_tokens")))
    )
    return good.groupBy("id", "item_id").agg(
        F.max("run_tokens").cast("bigint").alias("run_tokens"), F.max("n_tokens").cast("bigint").alias("n_tokens")
    ).withColumnRenamed("id", id_col)


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **names) -> DataFrame:
    """The documents, all columns, without those that hold a passage of an item."""
    bad = matches(docs, benchmark, id_col, **names).select(F.col(id_col).alias("_bad")).distinct()
    bad = C.stored(bad, "contaminated")  # its size is known then, and whether to broadcast it
    return docs.join(bad, F.col(id_col).cast("bigint") == F.col("_bad"), "left_anti")
