"""Aligning the token ids of two vocabularies over a corpus, with an identity map as fast path.

Every text is encoded twice, by a byte-level vocabulary (A, given space + text) and by a
piece vocabulary (B, which adds the space itself).  Both encodings spell the same bytes, so
byte offsets where tokens of both end cut them into groups, and an A and a B token are
linked where their byte ranges overlap.  How many documents hold an id pair linked is
counted over the corpus.

Most groups are one A token and one B token of the same bytes.  For these an array from
A id to the B id of the same bytes is made once; such links are counted per A id in one
vector of the vocabulary's length in each task, and looked up in one again.  Only the
other links become rows of (document, pair) and enter the shuffles of pairs.

A piece of a document never leaves its task; arrays of a document hold its *different*
pairs.  Aligned documents are written once, as counting and scoring both read them: no text
is encoded twice, and a lost executor costs its own tasks.  Pairs meet their counts in a
merge join at every size, as the table of pairs grows with the corpus; Spark splits the
rows of a frequent pair.

Edge cases: a null or empty text, and one whose tokens do not spell it (U+2581 in it), has
no tokens: zeros and no groups; repeated rows count as documents of their own; null ids
pass through; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame, functions as F, types as T

from caseflow.llm import common as C

BYTE_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
#: Pre-tokeniser of byte-level vocabularies. Fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Bytes encoded and aligned at once.
_AT_ONCE = 500_000


def byte_alphabet() -> dict[str, int]:
    """The letter that stands for each byte in entries of a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteVocabulary:
    """A byte-level BPE file (JSON).  Special tokens are never produced."""

    def __init__(self, content: bytes):
        spec = json.loads(content)
        letters, special = byte_alphabet(), {t["id"] for t in spec["added_tokens"]}
        vocab = spec["model"]["vocab"]
        ranks = {bytes(letters[c] for c in t): i for t, i in vocab.items() if i not in special}
        merges = (m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"])
        order = [vocab[left + right] for left, right in merges]
        kind = spec["pre_tokenizer"]
        if order != sorted(order) or spec["normalizer"] or kind["type"] != "ByteLevel" or kind["add_prefix_space"]:
            raise ValueError("not a byte-level vocabulary whose ids follow its merges")
        self.spelled = [b""] * (max([*ranks.values(), *special]) + 1)
        for token, i in ranks.items():
            self.spelled[i] = token
        self._bpe = tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self._bpe.encode_ordinary(" " + t) for t in texts]


class PieceVocabulary:
    """A sentencepiece model."""

    def __init__(self, content: bytes):
        self._pieces = p = sentencepiece.SentencePieceProcessor(model_proto=content)
        self.spelled = [
            bytes([int(p.id_to_piece(i)[3:5], 16)]) if p.is_byte(i) else p.id_to_piece(i).replace("▁", " ").encode()
            for i in range(p.vocab_size())
        ]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self._pieces.encode(texts, num_threads=1)


class Aligner:
    """Aligns texts, many at once: token ends of all texts lie on one line of bytes, and the
    end of a text is an end of both its encodings."""

    def __init__(self, a, b):
        self.a, self.b = a, b
        self.lengths = [np.array([len(s) for s in v.spelled], np.int64) for v in (a, b)]
        self.same = same_bytes(a, b)
        # ids as text, inside a group's side and at its end
        self._inner = [np.array([f"{i}," for i in range(len(v.spelled))], object) for v in (a, b)]
        self._last = [np.array([f"{i}{x}" for i in range(len(v.spelled))], object) for v, x in ((a, "|"), (b, ";"))]

    def _tokens(self, vocabulary, texts: list[str], raws: list[bytes]) -> list[list[int]]:
        at = [i for i, raw in enumerate(raws) if raw]
        got: list[list[int]] = [[] for _ in texts]
        for i, ids in zip(at, vocabulary.encode([texts[i] for i in at])):
            if b"".join(map(vocabulary.spelled.__getitem__, ids)) == raws[i]:
                got[i] = ids
        return got

    def __call__(self, texts: list[str | None]) -> dict[str, pa.Array]:
        raws = [b" " + t.encode("utf-8", "replace") if t else b"" for t in texts]
        ids = [self._tokens(v, texts, raws) for v in (self.a, self.b)]
        for i, (x, y) in enumerate(zip(*ids)):
            if not x or not y:
                ids[0][i], ids[1][i] = [], []
        counts = [np.array([len(x) for x in side], np.int64) for side in ids]
        flat = [np.fromiter((i for x in side for i in x), np.int64, c.sum()) for side, c in zip(ids, counts)]
        ends = [np.cumsum(n[f]) for n, f in zip(self.lengths, flat)]
        # where each text ends on the line of bytes; texts without tokens have no place on it
        bounds = np.cumsum([len(raw) if x else 0 for raw, x in zip(raws, ids[0])], dtype=np.int64)

        cuts = np.union1d(*ends)  # every stretch between cuts lies in one token of either side
        at_a, at_b = (np.searchsorted(e, cuts) for e in ends)
        both = (ends[0][at_a] == cuts) & (ends[1][at_b] == cuts) if len(cuts) else np.zeros(0, bool)
        text = np.searchsorted(bounds, cuts)
        n_links = np.bincount(text, minlength=len(texts))
        n_groups = np.bincount(text[both], minlength=len(texts))

        # links of a text by pair: a number that orders by text first
        wide = len(self.lengths[1])
        pair, times = np.unique((text * len(self.lengths[0]) + flat[0][at_a]) * wide + flat[1][at_b], return_counts=True)
        owner, pair = np.divmod(pair, len(self.lengths[0]) * wide)
        same = self.same[pair // wide] == pair % wide
        lists = {}
        for ours, which, value in (("same_ids", same, pair // wide), ("pairs", ~same, pair)):
            offsets = np.searchsorted(owner[which], np.arange(len(texts) + 1)).astype(np.int32)
            for name, x in ((ours, value[which]), (f"{ours}_links", times[which])):
                lists[name] = pa.ListArray.from_arrays(pa.array(offsets), pa.array(x, pa.int64()))
        return {
            "n_a": pa.array(counts[0]),
            "n_b": pa.array(counts[1]),
            "n_groups": pa.array(n_groups.astype(np.int64)),
            "n_links": pa.array(n_links.astype(np.int64)),
            "groups": pa.array(self._written(flat, ends, cuts[both], bounds, counts), pa.string()),
            **lists,
        }

    def _written(self, flat, ends, common, bounds, counts) -> list[str]:
        """``a1,a2|b1;a3|b2`` for each text."""
        group = [np.searchsorted(common, e) for e in ends]
        sizes = [np.bincount(g, minlength=len(common)) for g in group]
        before = [np.cumsum(n) for n in sizes]
        line = np.empty(len(flat[0]) + len(flat[1]), object)
        if len(common):
            # a token's place: its own side's tokens before it, and the other side's of groups before
            place = [(before[1] - sizes[1])[group[0]], before[0][group[1]]]
            for side, (f, e, g) in enumerate(zip(flat, ends, group)):
                shown = np.where(e == common[g], self._last[side][f], self._inner[side][f])
                line[np.arange(len(f)) + place[side]] = shown
        upto = np.cumsum(counts[0] + counts[1])
        return ["".join(line[e - n : e])[:-1] for e, n in zip(upto.tolist(), (counts[0] + counts[1]).tolist())]


def same_bytes(a, b) -> np.ndarray:
    """For each A id the smallest B id that is no lone byte's and spells the same bytes, or -1."""
    ids: dict[bytes, int] = {}
    for i, s in enumerate(b.spelled):
        # of pieces with equal bytes the last is the written one: byte pieces stand first
        if s:
            ids[s] = i
    return np.array([ids.get(s, -1) if s else -1 for s in a.spelled], np.int64)


def _content(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


_COUNTS = ["n_a", "n_b", "n_groups", "n_links"]
_ARRAYS = ["same_ids", "same_ids_links", "pairs", "pairs_links"]


def align(
    docs: DataFrame,
    keep: list[str],
    text_col: str = "text",
    byte_vocabulary: str = BYTE_VOCABULARY,
    piece_vocabulary: str = PIECE_VOCABULARY,
) -> DataFrame:
    """The columns of ``keep``, then per document:

    n_a, n_b, n_groups, n_links; groups, as ``a1,a2|b1;a3|b2``; the document's different
    links: A ids linked to the B id of the same bytes (``same_ids``) and other pairs
    (``pairs``, A id x size of B + B id), each with its number of links.
    """
    files = docs.sparkSession.sparkContext.broadcast((_content(byte_vocabulary), _content(piece_vocabulary)))
    fields = [docs.schema[k] for k in keep]
    fields += [T.StructField(n, T.LongType()) for n in _COUNTS] + [T.StructField("groups", T.StringType())]
    fields += [T.StructField(n, T.ArrayType(T.LongType())) for n in _ARRAYS]
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = None
        for b in batches:
            aligner = aligner or Aligner(ByteVocabulary(files.value[0]), PieceVocabulary(files.value[1]))
            texts = b.column(len(keep)).to_pylist()
            start, held = 0, 0
            for i, t in enumerate(texts):
                held += len(t or "")
                if held > _AT_ONCE or i + 1 == len(texts):
                    got = aligner(texts[start : i + 1])
                    kept = [b.column(k).slice(start, i + 1 - start) for k in range(len(keep))]
                    yield pa.RecordBatch.from_arrays([*kept, *[got[n] for n in names[len(keep) :]]], names=names)
                    start, held = i + 1, 0

    # under names of their own, as the text may be among the columns kept
    given = [F.col(k).alias(f"_keep{i}") for i, k in enumerate(keep)]
    return docs.select(*given, F.col(text_col).alias("_text")).mapInArrow(run, T.StructType(fields))


def pair_counts(aligned: DataFrame, same: np.ndarray, wide: int) -> DataFrame:
    """(a_id, pair, same, n_docs): in how many documents each pair is linked.

    Every task adds its links of equal bytes into one vector and sends its entries at the
    end; other pairs are added up batch by batch before they leave the task.
    """
    names = ["pair", "same", "n"]

    def rows(pair: np.ndarray, n: np.ndarray, is_same: bool) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(pair, pa.int64()), pa.array(np.full(len(pair), is_same)), pa.array(n, pa.int64())], names=names
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vector = np.zeros(len(same), np.int64)
        for b in batches:
            vector += np.bincount(b.column(0).flatten().to_numpy(), minlength=len(vector))
            yield rows(*np.unique(b.column(1).flatten().to_numpy(), return_counts=True), False)
        at = np.nonzero(vector)[0]
        yield rows(at * wide + same[at], vector[at], True)

    found = aligned.select("same_ids", "pairs").mapInArrow(run, "pair bigint, same boolean, n bigint")
    found = found.groupBy("pair", "same").agg(F.sum("n").alias("n_docs"))
    return found.select(F.expr(f"pair div {wide}").alias("a_id"), "pair", "same", "n_docs")


def score(
    aligned: DataFrame, byte_vocabulary: str = BYTE_VOCABULARY, piece_vocabulary: str = PIECE_VOCABULARY
) -> DataFrame:
    """``aligned`` with n_best and count_sum in place of the arrays.

    count_sum adds up, over a document's links, in how many documents their pair is
    linked; n_best is the number of links whose pair is the most frequent of its A id.
    """
    a, b = ByteVocabulary(_content(byte_vocabulary)), PieceVocabulary(_content(piece_vocabulary))
    same, wide = same_bytes(a, b), len(b.spelled)
    spark = aligned.sparkSession
    docs = C.stored(aligned.withColumn("_row", F.monotonically_increasing_id()), "aligned")
    counts = C.stored(pair_counts(docs, same, wide), "pair-counts")
    most = counts.groupBy("a_id").agg(F.max("n_docs").alias("most"))
    counts = counts.join(most, "a_id").select("pair", "same", "n_docs", (F.col("n_docs") == F.col("most")).alias("best"))
    # one entry for an A id: as long as the vocabulary, whatever the corpus
    known = counts.where("same").toArrow()
    ids = known.column("pair").to_numpy() // wide
    vectors = np.zeros((2, len(same)), np.int64)
    vectors[0, ids] = known.column("n_docs").to_numpy()
    vectors[1, ids] = known.column("best").to_numpy()
    shared = spark.sparkContext.broadcast(vectors.tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_docs, best = np.frombuffer(shared.value, np.int64).reshape(2, -1)
        for b in batches:
            ids, times = (b.column(i).flatten().to_numpy() for i in (1, 2))
            owner = np.repeat(np.arange(b.num_rows), np.diff(b.column(1).offsets.to_numpy()))
            sums = []
            for value in (best, n_docs):
                total = np.zeros(b.num_rows, np.int64)
                np.add.at(total, owner, value[ids] * times)
                sums.append(pa.array(total))
            yield pa.RecordBatch.from_arrays([b.column(0), *sums], names=["_row", "n_best", "count_sum"])

    fast = docs.select("_row", "same_ids", "same_ids_links").mapInArrow(run, "_row bigint, n_best bigint, count_sum bigint")
    links = docs.select("_row", F.explode(F.arrays_zip(F.col("pairs").alias("pair"), F.col("pairs_links").alias("n"))).alias("l"))
    other = links.select("_row", "l.pair", "l.n").join(counts.where("not same").hint("merge"), "pair")
    other = other.select(
        "_row", F.when(F.col("best"), F.col("n")).otherwise(0).alias("n_best"), (F.col("n") * F.col("n_docs")).alias("count_sum")
    )
    total = fast.unionByName(other).groupBy("_row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    kept = [c for c in docs.columns if c not in (*_ARRAYS, "_row")]
    return docs.join(total, "_row").select(*kept, "n_best", "count_sum")
