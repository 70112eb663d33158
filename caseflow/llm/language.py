"""Language identification by compression.

For each language a zstandard raw-content dictionary is filled with passages of its
labelled documents.  A text is compressed once per dictionary, piece by piece so that
every piece starts from the dictionary alone; the language with the smallest total wins.
The margin to the runner-up, in bits a byte, gives the score, and narrow margins are
marked as rejected.

Dictionaries are fitted on a bounded sample (``PASSAGES`` passages of ``PASSAGE_CHARS``
characters a language, in a fixed pseudo-random order of doc_id); texts are always
compressed whole.

Edge cases: null text, or text without a letter: ``und``, score 0, rejected.  Ties go to
the language with more learned rows, then the first by name.  Without learned languages
every text is ``und``.  Repeated rows are predicted row by row; rows with a null doc_id or
null lang are never learned from.
"""

from __future__ import annotations

import numpy as np
import regex
import zstandard as zstd
from pyspark.sql import DataFrame, functions as F, types as T

from caseflow.llm import common as C

UNKNOWN = "und"
PASSAGES = 160
PASSAGE_CHARS = 700
#: Bytes of a piece; small enough for the dictionary to matter to the last byte.
PIECE = 2048
LEVEL = 6
#: Bits a byte by which the best must beat the next.
MARGIN = 0.02
#: Margins are turned into scores relative to this much evidence, in bits.
_BITS = 4.0
_LETTER = regex.compile(r"\p{L}")


def fit_dictionaries(
    docs: DataFrame, id_col: str, text_col: str, lang_col: str
) -> list[tuple[str, bytes]]:
    """(language, dictionary content), the language with most learned rows first."""
    rows = docs.where(
        (C.fold(id_col) != 0) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()
    ).select(F.col(id_col).alias("_id"), F.col(lang_col).alias("_lang"), F.col(text_col).alias("_text"))
    # a passage from anywhere in the text, at an offset fixed by the id
    room = F.greatest(F.length("_text") - PASSAGE_CHARS, F.lit(0)) + 1
    at = F.pmod(F.crc32(F.concat(F.lit("at|"), F.col("_id").cast("string")).cast("binary")), room) + 1
    cut = rows.select("_id", "_lang", F.col("_text").substr(at.cast("int"), F.lit(PASSAGE_CHARS)).alias("_text"))
    sample = C.bounded_sample(cut, "_lang", "_id", PASSAGES).toArrow().to_pylist()
    sizes = {r["_lang"]: r["count"] for r in rows.groupBy("_lang").count().collect()}
    found: dict[str, list] = {}
    for r in sorted(sample, key=lambda r: (r["_id"], r["_text"])):
        if _LETTER.search(r["_text"]):
            found.setdefault(r["_lang"], []).append(r["_text"].lower())
    order = sorted(found, key=lambda k: (-sizes[k], k))
    return [(k, "\n".join(found[k]).encode("utf-8", "replace")) for k in order]


def predict(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    keep: list[str] | None = None,
    margin: float = MARGIN,
) -> DataFrame:
    """Per row: lang_pred, score (0 to 1: the winner's share of the evidence), margin and rejected."""
    keep = keep or [id_col]
    trained = fit_dictionaries(docs, id_col, text_col, lang_col)
    names = [k for k, _ in trained]
    shared = docs.sparkSession.sparkContext.broadcast([content for _, content in trained])
    made: list = []

    def sizes(text: str) -> tuple[np.ndarray, int]:
        data = text.lower().encode("utf-8", "replace")
        total = np.zeros(len(made), np.int64)
        for at in range(0, len(data), PIECE):
            piece = data[at : at + PIECE]
            for k, c in enumerate(made):
                total[k] += len(c.compress(piece))
        return total, len(data)

    def classify(texts: list) -> dict:
        if not made:
            for content in shared.value:
                d = zstd.ZstdCompressionDict(content, dict_type=zstd.DICT_TYPE_RAWCONTENT)
                d.precompute_compress(level=LEVEL)
                made.append(zstd.ZstdCompressor(
                    dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False,
                ))
        out = {"lang_pred": [], "score": [], "margin": [], "rejected": []}
        for text in texts:
            lang, score, gap = UNKNOWN, 0.0, 0.0
            if text and made and _LETTER.search(text):
                total, n = sizes(text)
                k = int(total.argmin())
                lang = names[k]
                score = float(1 / np.exp2(-np.minimum((total - total[k]) * 8 / _BITS, 60.0)).sum())
                others = np.delete(total, k)
                gap = float((others.min() - total[k]) * 8 / n) if len(others) else 8.0
            out["lang_pred"].append(lang)
            out["score"].append(score)
            out["margin"].append(gap)
            out["rejected"].append(lang == UNKNOWN or gap < margin)
        return out

    schema = T.StructType([
        T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
        T.StructField("margin", T.DoubleType()), T.StructField("rejected", T.BooleanType()),
    ])
    return C.map_text(docs, keep, text_col, schema, classify)
