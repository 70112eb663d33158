"""Toxicity, language and quality: models against plain versions, held-out accuracy, edge cases."""

import collections
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from caseflow.llm import common as C, language, quality, toxicity
from caseflow.llm.queries import QUERIES

BIG = "/root/testdata/sf0.01"


# ---------------------------------------------------------------- toxicity


def plain_kneser_ney(words, order, discount):
    """Interpolated Kneser-Ney over bytes: own counts at the top, shared continuation counts below."""
    own = collections.defaultdict(lambda: [0, 0])
    for w, c in words.items():
        s = b"\x02" + w + b"\x03"
        for i in range(1, len(s)):
            for n in range(2, min(order, i + 1) + 1):
                for k in (0, 1):
                    own[s[i - n + 1 : i + 1]][k] += c[k]
    shared = collections.Counter(g[1:] for g in own)
    counts = {g: c for g, c in own.items() if g[:1] == b"\x02" or len(g) == order}
    for g, n in shared.items():
        counts[g] = [n, n]
    after = collections.defaultdict(list)
    for g, c in counts.items():
        after[g[:-1]].append(c)

    def p(gram, k):
        rest = p(gram[1:], k) if gram else 1 / 257
        if not gram:
            return 1 / 257
        seen = after.get(gram[:-1], [])
        total = sum(c[k] for c in seen)
        if not total:
            return rest
        mine = counts.get(gram, [0, 0])[k]
        kinds = sum(c[k] > 0 for c in seen)
        return (max(mine - discount, 0) + discount * kinds * rest) / total

    def difference(w):
        s = b"\x02" + w + b"\x03"
        out = 0.0
        for i in range(1, len(s)):
            gram = s[max(0, i - order + 1) : i + 1]
            out += math.log(p(gram, 1)) - math.log(p(gram, 0))
        return out

    return difference


def test_the_model_is_kneser_ney(spark):
    rnd = random.Random(5)
    words = {}
    for _ in range(60):
        w = "".join(rnd.choice("abc") for _ in range(rnd.randint(1, 7))).encode()
        words[w] = [rnd.randint(0, 5), rnd.randint(0, 3)]
    words = {w: c for w, c in words.items() if sum(c)}
    df = spark.createDataFrame([(w.decode(), *c) for w, c in words.items()], "word string, c0 bigint, c1 bigint")
    model = toxicity.fit_model(df, order=4)
    plain = plain_kneser_ney(words, 4, toxicity.DISCOUNT)
    for w in [*words, b"abcabc", b"a", b"zz"]:
        assert abs(float(model.differences([w])[0]) - plain(w)) < 1e-3, w


def test_counts_stay_exact_with_many_sequences(spark):
    """Over a million sequences: each keeps a count of its own."""
    rnd = random.Random(6)
    words = {}
    for _ in range(25_000):
        w = "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(11)).encode()
        words[w] = [rnd.randint(0, 5), rnd.randint(0, 3) or 1]
    df = spark.createDataFrame([(w.decode(), *c) for w, c in words.items()], "word string, c0 bigint, c1 bigint")
    plain = plain_kneser_ney(words, toxicity.ORDER, toxicity.DISCOUNT)
    asked = [*list(words)[:40], b"abcabc", b"idiot"]
    got = toxicity.fit_model(df).differences(asked)
    assert max(abs(float(d) - plain(w)) for d, w in zip(got, asked)) < 1e-3


def test_toxicity_held_out(spark):
    got = QUERIES["op8_toxicity"](spark, BIG)
    rows = got.join(C.table(spark, BIG, "labels"), "doc_id").where("held_out").collect()
    assert got.count() == C.table(spark, BIG, "documents").count()
    pos = [r["score"] for r in rows if r["toxic"] == 1]
    neg = [r["score"] for r in rows if r["toxic"] == 0]
    auc = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / len(pos) / len(neg)
    assert auc > 0.85
    assert sum(s >= 0.5 for s in neg) <= 0.1 * len(neg)
    assert got.where("score < 0 or score > 1 or predicted <> cast(score >= 0.5 as int)").count() == 0


def test_toxicity_edges(spark):
    docs = spark.createDataFrame(
        [(i, f"good text number {i} of many words" + (" idiot" if i % 3 == 0 else "")) for i in range(60)]
        + [(100, None), (101, ""), (102, "!!! 123"), (None, "idiot"), (5, "x"), (5, "x")],
        "doc_id bigint, text string",
    ).withColumn("score", F.lit("mine"))
    labels = spark.createDataFrame(
        [(i, int(i % 3 == 0)) for i in range(60)] + [(None, 1), (4, None), (3, 0), (100, 1)], "doc_id bigint, toxic int"
    )
    out = toxicity.score(docs, labels)
    assert out.count() == 66 and out.where("score is null").count() == 0
    none = toxicity.score(docs, labels.where("doc_id < 0"))
    assert {r["score"] for r in none.collect()} == {0.0}
    assert toxicity.score(docs.where("doc_id > 999"), labels).count() == 0
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.where("doc_id = 101").count() == 1


# ---------------------------------------------------------------- language


def test_language_held_out(spark):
    got = QUERIES["op9_language_id"](spark, BIG)
    rows = got.join(C.table(spark, BIG, "documents").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.97 * len(held)
    sure = [r for r in held if not r["rejected"]]
    assert sum(r["lang"] == r["lang_pred"] for r in sure) >= sum(r["lang"] == r["lang_pred"] for r in held) / len(held) * len(sure)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_edges(spark):
    en = "the quick brown fox jumps over the lazy dog and runs away from the hounds "
    de = "der schnelle braune fuchs springt über den faulen hund und läuft davon "
    rows = [(i, (en if i % 2 else de) * 3, "en" if i % 2 else "de") for i in range(40)]
    rows += [(90, None, "en"), (91, "", "en"), (92, "123 !?", "en"), (93, "the lazy dog runs", None), (None, de, "de"), (94, "ü", None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").withColumn("margin", F.lit(1))
    got = {r["doc_id"]: r for r in language.predict(df).collect()}
    assert [got[i]["lang_pred"] for i in (90, 91, 92)] == ["und"] * 3 and got[90]["score"] == 0 and got[90]["rejected"]
    assert got[93]["lang_pred"] == "en" and got[None]["lang_pred"] == "de"
    assert got[94]["lang_pred"] in ("de", "en")
    assert {r["lang_pred"] for r in language.predict(df.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert language.predict(df.where("doc_id > 999")).count() == 0


# ---------------------------------------------------------------- quality


def brute_counts(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    n = collections.Counter(zip(w, w[1:], w[2:]))
    covered = {j for i in range(len(w) - 2) if n[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered)


@pytest.mark.parametrize("text", [None, "", " \n\t", "a", "a a a a", "a b c a b c", "é x y\x0bz\n\né x y\x0bz", "#*$ |<>\r\n%&\r\n%&\r", "a b a b a b a", "\x1c \x85 x"])
def test_base_counts(text):
    assert quality.base_counts(text) == brute_counts(text)


def test_quality_held_out_and_base(spark):
    got = QUERIES["op10_quality"](spark, BIG)
    docs = C.table(spark, BIG, "documents").select("doc_id", "text")
    for r in got.join(docs, "doc_id").limit(400).collect():
        n, chars, symbols, dup, repeat = brute_counts(r["text"])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (n, chars, symbols, dup, repeat)
        assert r["base_failed"] == (n < 50 or 100 * repeat > 50 * n)
        assert not (r["kept"] and r["base_failed"])
    rows = got.join(C.table(spark, BIG, "labels"), "doc_id").where(C.held_out("doc_id") & ~F.col("base_failed")).collect()
    assert sum(r["kept"] == (r["quality"] == 1) for r in rows) >= 0.95 * len(rows)


def test_quality_edges(spark):
    good, bad = "plain words make good reading for everyone here " * 9, "x#| $$ ** zz%% <<>> && " * 20
    rows = [(i, (good if i % 2 else bad) + str(i)) for i in range(80)] + [(100, None), (101, ""), (None, good), (5, good)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("value", F.lit("x"))
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)] + [(None, 1), (6, None)], "doc_id bigint, quality int")
    out = quality.judge(docs, labels)
    assert out.count() == 84 and out.where("kept is null").count() == 0
    assert out.where("doc_id in (100, 101) and not base_failed").count() == 0
    none = quality.judge(docs, labels.where("doc_id < 0"))
    assert none.where("kept = base_failed").count() == 0
    assert quality.judge(docs.where("doc_id > 999"), labels).count() == 0


def test_logistic_fit():
    rnd = np.random.default_rng(0)
    x = rnd.normal(size=(4000, 2))
    y = (rnd.random(4000) < C.sigmoid(x @ [2.0, -1.0] + 0.5)).astype(float)
    w = C.fit_logistic(x, y)
    assert np.allclose(w, [2.0, -1.0, 0.5], atol=0.2)
