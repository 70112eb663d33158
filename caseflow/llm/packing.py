"""Token ids, packed into sequences of fixed length.

Texts are tokenised with a given public byte-pair vocabulary, an end token closes each
document, and every task packs its documents window by window with best-fit-decreasing:
longest first, each into the fullest sequence that still has room.  The fullest fitting
sequence is found in a segment tree over remaining capacities.  Documents longer than a
sequence are cut into full sequences and a rest, losing nothing.

A row of the result is a row of the id matrix with what a trainer needs beside it:
``tokens`` (little-endian ids, padded), ``cu_seqlens`` (cumulative segment lengths),
``position_ids`` (starting anew at 0 in every segment), and for each segment the document
and its first token.  No shuffle is needed: what a task holds is one window of
``WINDOW_TOKENS`` tokens plus the document at hand.  Tasks see documents in stored order,
so a table laid out in mix order stays mixed.

Edge cases: null or empty text is a single end token; rows without an id carry a null id;
repeated rows are packed as often as they come; an empty table gives no rows.  Of the
input only the named columns are read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, functions as F

SEQ_LEN = 2048
WINDOW_TOKENS = 2_000_000
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Pattern of the vocabulary's pre-tokeniser, and its free id. Fixed values.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
END = 50256

SCHEMA = (
    "n_tokens int, tokens binary, cu_seqlens array<int>, position_ids binary, "
    "doc_ids array<bigint>, doc_starts array<int>"
)


def encoding(content: bytes) -> tiktoken.Encoding:
    """Encoder from lines of a base64 token and its rank."""
    ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, content.splitlines()) if t}
    return tiktoken.Encoding("corpus", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


class Capacities:
    """Open sequences by remaining capacity, with a segment tree of which capacities occur."""

    def __init__(self, most: int):
        self.size = 1 << most.bit_length()
        self.filled = [0] * (2 * self.size)
        self.open: list[list[int]] = [[] for _ in range(most + 1)]

    def add(self, room: int, sequence: int) -> None:
        self.open[room].append(sequence)
        self._count(room, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """The sequence with the least room of at least ``need``, removed; with its room."""
        room = self._first(need)
        if room is None:
            return None
        self._count(room, -1)
        return self.open[room].pop(), room

    def _count(self, room: int, by: int) -> None:
        at = room + self.size
        while at:
            self.filled[at] += by
            at >>= 1

    def _first(self, need: int) -> int | None:
        at = need + self.size
        if self.filled[at]:
            return need
        while at > 1:
            if not at & 1 and self.filled[at + 1]:  # a left child: look into the right half
                at += 1
                while at < self.size:
                    at *= 2
                    at += not self.filled[at]
                return at - self.size
            at >>= 1
        return None


def best_fit(lengths: list[int], seq_len: int) -> list[list[int]]:
    """Groups of item numbers, each at most ``seq_len`` long in sum: best-fit-decreasing."""
    rooms = Capacities(seq_len)
    packed: list[list[int]] = []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        got = rooms.take(lengths[i])
        if got is None:
            got = len(packed), seq_len
            packed.append([])
        packed[got[0]].append(i)
        left = got[1] - lengths[i]
        if left:
            rooms.add(left, got[0])
    return packed


def _window(pieces: list[tuple], seq_len: int) -> dict:
    """Rows for the pieces (id, first token, ids) of one window."""
    out: dict[str, list] = {c.split()[0]: [] for c in SCHEMA.split(", ")}
    for group in best_fit([len(p[2]) for p in pieces], seq_len):
        group.sort()  # stored order inside a sequence
        parts = [pieces[i] for i in group]
        ids = np.concatenate([p[2] for p in parts])
        places = np.concatenate([np.arange(len(p[2])) for p in parts])
        row = np.full(seq_len, END, "<u4")
        row[: len(ids)] = ids
        spots = np.zeros(seq_len, "<u4")
        spots[: len(ids)] = places
        spots[len(ids) :] = np.arange(seq_len - len(ids))
        out["n_tokens"].append(len(ids))
        out["tokens"].append(row.tobytes())
        out["cu_seqlens"].append([0, *np.cumsum([len(p[2]) for p in parts]).tolist()])
        out["position_ids"].append(spots.tobytes())
        out["doc_ids"].append([p[0] for p in parts])
        out["doc_starts"].append([p[1] for p in parts])
    return out


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    seq_len: int = SEQ_LEN,
    vocabulary: str = VOCABULARY,
    window_tokens: int = WINDOW_TOKENS,
) -> DataFrame:
    """Packed sequences of all documents (columns: ``SCHEMA``)."""
    with open(vocabulary, "rb") as f:  # on the driver; executors get it with the task
        shared = docs.sparkSession.sparkContext.broadcast(f.read())
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    kinds = [pa.int32(), pa.binary(), pa.list_(pa.int32()), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32())]

    def rows(pieces: list[tuple]) -> Iterator[pa.RecordBatch]:
        out = _window(pieces, seq_len)
        for at in range(0, len(out["n_tokens"]), 512):
            cols = [pa.array(out[n][at : at + 512], t) for n, t in zip(names, kinds)]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, pieces, held = None, [], 0
        for b in batches:
            encoder = encoder or encoding(shared.value)
            for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids = encoder.encode_ordinary(text) if text else []
                ids.append(END)
                ids = np.array(ids, np.uint32)
                for at in range(0, len(ids), seq_len):
                    pieces.append((i, at, ids[at : at + seq_len]))
                held += len(ids)
                if held >= window_tokens:
                    yield from rows(pieces)
                    pieces, held = [], 0
        if pieces:
            yield from rows(pieces)

    return docs.select(F.col(id_col).cast("bigint"), F.col(text_col)).mapInArrow(run, SCHEMA)


def write_packed(packed: DataFrame, path: str) -> None:
    """Id matrices, segment lengths and positions as Parquet, on whatever store Spark reaches."""
    packed.write.parquet(path)
