"""Token alignment, hard negatives, URL rules: against brute force, and edge cases."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
from caseflow.llm import alignment, hard_negatives, url_filter

# ---------------------------------------------------------------- token alignment

ODD = ["", " ", "  a", "a▁b", "▁", "é", "日本語 text", "<0x41>", "<|endoftext|> a", "</s>", "\n\n\t", "🙂🙃", "a\x00b", "x" * 300]
SCHEMA = "doc_id bigint, text string"


@pytest.fixture(scope="module")
def vocabularies():
    content = [alignment._content(p) for p in (alignment.BYTE_VOCABULARY, alignment.PIECE_VOCABULARY)]
    return alignment.ByteVocabulary(content[0]), alignment.PieceVocabulary(content[1])


def texts(n, seed=0):
    rnd = random.Random(seed)
    words = ["the", "Zeit", "naïve", "antidisestablishment", "3.14159", "foo_bar", "été", "\n", "  ", "日本", "ein", "of", "🙂", "''s"]
    return [" ".join(rnd.choice(words) for _ in range(rnd.randrange(30))) for _ in range(n)]


def plain_alignment(rows):
    """Token by token with the libraries themselves: groups, links, document counts, scores."""
    a = Tokenizer.from_file(alignment.BYTE_VOCABULARY)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=alignment.PIECE_VOCABULARY)
    letters = alignment.byte_alphabet()
    names = {i: t for t, i in a.get_vocab().items()}

    def spans(ids, spelled):
        out, at = [], 0
        for i in ids:
            out.append((i, at, at + len(spelled(i))))
            at += len(spelled(i))
        return out

    spell_a = lambda i: bytes(letters[c] for c in names[i])
    spell_b = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
    made = []
    for doc, text in rows:
        raw = (" " + (text or "")).encode()
        x = spans(a.encode(" " + text, add_special_tokens=False).ids, spell_a) if text else []
        y = spans(b.encode(text), spell_b) if text else []
        if b"".join(spell_a(i) for i, *_ in x) != raw or b"".join(spell_b(i) for i, *_ in y) != raw:
            x, y = [], []
        links = [(i, j) for i, s, e in x for j, t, f in y if s < f and t < e]
        common = sorted({e for *_, e in x} & {e for *_, e in y})
        groups, start = [], 0
        for end in common:
            inside = lambda side: ",".join(str(i) for i, s, e in side if start <= s and e <= end)
            groups.append(f"{inside(x)}|{inside(y)}")
            start = end
        made.append((doc, len(x), len(y), groups, links))
    docs = Counter(p for *_, links in made for p in set(links))
    most = defaultdict(int)
    for (i, _), n in docs.items():
        most[i] = max(most[i], n)
    return sorted(
        (doc, n_a, n_b, len(groups), len(links), sum(docs[p] == most[p[0]] for p in links), sum(docs[p] for p in links),
         hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "")
        for doc, n_a, n_b, groups, links in made
    )


def aligned(docs):
    got = alignment.align(docs, ["doc_id"])
    got = got.withColumn("sha", F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))).drop("groups")
    cols = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "sha"]
    return sorted(tuple(r) for r in alignment.score(got).select(*cols).collect())


def test_alignment_equals_brute_force(spark):
    rows = list(enumerate([*ODD, *texts(60), *texts(20), None]))
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert aligned(docs) == plain_alignment(rows)


def test_alignment_of_the_given_documents_equals_brute_force(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    rows = [r for r in rows if len(r[1] or "") < 3000]  # the brute force is quadratic in a text
    assert aligned(spark.createDataFrame(rows, SCHEMA)) == plain_alignment(rows)


def test_alignment_edges(spark):
    assert aligned(spark.createDataFrame([], SCHEMA)) == []
    zeros = (0,) * 6 + ("",)
    rows = [(1, None), (2, ""), (3, "a▁b")]
    assert aligned(spark.createDataFrame(rows, SCHEMA)) == [(i, *zeros) for i in (1, 2, 3)]
    twice = aligned(spark.createDataFrame([(1, "a b"), (1, "a b"), (2, "a b")], SCHEMA))
    assert twice[0] == twice[1] and twice[0][1:] == twice[2][1:] and twice[0][6] == 3 * twice[0][4]
    clash = spark.createDataFrame([(1, "a b", 5, "x", 7)], "doc_id bigint, text string, n_a int, groups string, _row int")
    assert aligned(clash)[0][1:4] == (2, 2, 2)
    long = "some words of a long text. " * 20_000 + "y" * 100_000
    (got,) = aligned(spark.createDataFrame([(1, long)], SCHEMA))
    assert got[3] > 100_000 and got[5] == got[4]


def test_byte_vocabulary_equals_the_library(vocabularies):
    own = Tokenizer.from_file(alignment.BYTE_VOCABULARY)
    own.encode_special_tokens = True
    points = [chr(c) for c in range(0x3000) if not 0xD800 <= c < 0xE000]
    some = [*ODD, *texts(200, 1), *["".join(points[i : i + 7]) + f" a{points[i]}1 {points[i]}" for i in range(0, len(points), 5)]]
    want = [e.ids for e in own.encode_batch([" " + t for t in some], add_special_tokens=False)]
    assert vocabularies[0].encode(some) == want


def test_irregular_links_alone_are_shuffled(vocabularies):
    """The identity map holds equal bytes only, and most links of plain prose."""
    a, b = vocabularies
    same = alignment.same_bytes(a, b)
    at = np.nonzero(same >= 0)[0]
    assert len(at) > 10_000 and all(a.spelled[i] == b.spelled[same[i]] for i in at.tolist())
    got = alignment.Aligner(a, b)(["The quick brown fox jumps over the lazy dog and the cat."])
    assert sum(got["same_ids_links"].flatten().to_pylist()) > 8 > sum(got["pairs_links"].flatten().to_pylist())


# ---------------------------------------------------------------- hard negatives

VECTORS = "vec_id bigint, embedding array<double>, label int"


def plain_negatives(rows, every=100, k=5, low=80):
    kept = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or x != x or abs(x) == float("inf") for x in v):
            continue
        kept[i] = min(kept.get(i, (label, v)), (label, v))
    whole = {i: [int(np.floor(x * 256)) if abs(x) < 1e200 else int(x) * 256 for x in v] for i, (_, v) in kept.items()}
    out = []
    for anchor in sorted(i for i in kept if i % every == 0):
        dot = lambda i: max(-(2**63) + 1, min(2**63 - 1, sum(x * y for x, y in zip(whole[anchor], whole[i]))))
        scored = sorted((-dot(i), i) for i in kept if i != anchor)
        positives = [(i, -s) for s, i in scored if kept[i][0] == kept[anchor][0]][:k]
        for p, top in positives:
            good = [(i, -s) for s, i in scored if kept[i][0] != kept[anchor][0] and low * top <= -100 * s <= 100 * top]
            out += [(anchor, p, n + 1, i, top, s) for n, (i, s) in enumerate(good[:k])]
    return sorted(out)


def mined(spark, rows, **params):
    return sorted(tuple(r) for r in hard_negatives.mine(spark.createDataFrame(rows, VECTORS), **params).collect())


@pytest.mark.parametrize("cell", [1 << 19, 64])
def test_negatives_equal_brute_force(spark, cell):
    """With one cell, and with a grid of many; small whole components give many ties."""
    rnd = random.Random(cell)
    rows = [(i, [rnd.randrange(-2, 4) / 2 for _ in range(6)], rnd.choice([0, 0, 0, 1, 2])) for i in range(160)]
    got = mined(spark, rows, every=10, cell=cell)
    assert got == plain_negatives(rows, 10) and len(got) > 100


def test_negatives_of_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (0, [1.0, 2.0], 1), (1, [1.0, 2.0], 1), (2, [1.0, 2.0], 2), (3, [1.0, 2.0], None), (4, None, 2),
        (5, [1.0, None], 2), (6, [inf, 1.0], 2), (7, [nan, 1.0], 2), (None, [1.0, 2.0], 2), (8, [], 2),
        (9, [1.0], 3), (9, [1.0, 1.9], 3), (9, [1.0, 1.9], 3), (10, [1.0, 1.7, 5.0], 4), (-100, [1.0, 2.0], 9),
        (100, [-1.0, 0.0], 1), (200, [], 1), (300, [0.001, 0.001], 5), (11, [0.0, 0.0], 5),
    ]
    assert mined(spark, rows) == plain_negatives(rows)
    assert mined(spark, []) == []
    assert mined(spark, [(0, [1.0], 1)]) == [] == mined(spark, [(0, [1.0], 1), (1, [1.0], 2)])
    frame = spark.createDataFrame([(0, [1.0], 1, 5, 6), (1, [1.0], 1, 5, 6), (2, [0.9], 2, 5, 6)], VECTORS + ", id int, score int")
    assert len(hard_negatives.mine(frame).collect()) == 1


def test_scores_are_exact_where_doubles_are_not(spark):
    big = float(1 << 40)
    rows = [(0, [big, 1.0], 1), (1, [big, 1.0], 1), (2, [big, 0.9961], 2), (3, [big, 0.99], 2), (4, [1e300, 0.0], 2), (5, [1e300, 0.0], 1)]
    assert mined(spark, rows) == plain_negatives(rows)


def test_windows_open_in_the_sorted_stream(spark):
    """More pairs than a batch holds, all of one anchor, and negatives tied with their positive."""
    n = 30_000
    rows = [(0, 10**6 + k, 1000 - k, False) for k in range(5)] + [(0, i, 1000 - i // 40, True) for i in range(n)]
    pairs = spark.createDataFrame(rows, hard_negatives._PAIRS).repartition(7)
    got = sorted(tuple(r) for r in hard_negatives.read_windows(pairs, 5, 5, 80).collect())
    want = sorted((0, 10**6 + k, r + 1, 40 * k + r, 1000 - k, 1000 - k) for k in range(5) for r in range(5))
    assert got == want


# ---------------------------------------------------------------- URL rules


def plain_verdict(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, path = rest[:cut], rest[cut:]
        path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for h, p, v in rules:
        if h and v is not None and (host == h.lower() or host.endswith("." + h.lower())) and path.startswith(p or ""):
            best = max(best or (0,), (len(h) + len(p or ""), len(h), h.lower() + (p or ""), v))
    return (host, path, best and best[2], best[3] if best else default)


def judged(spark, urls, rules, **params):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string")
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    got = url_filter.judge(pages, table, ["page_id"], **params)
    return [tuple(r)[1:] for r in sorted(got.collect())]


URLS = [None, "", "no scheme", "://", "http://", "http://COM/", "http://com", "http://xcom/", "http://a.com/x?y#z", "http://a.com?/en/",
        "http://WWW.example.com/en/1", "http://www.example.com/EN/", "http://x.www.example.com/en/", "http://example.com/en", "a://b://c.net/es/",
        "http://net/fr/#/es/", "http://.net/fr/", "http://..com/", "http://É.com/", "http://com./", "http://a.com:80/", "http://u@com/",
        "http://" + "a." * 5000 + "com/" + "x" * 50_000, "http://a\nb.com/\n/"]
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


@pytest.mark.parametrize("params", [{}, {"bits": 1}, {"bits": 5}, {"most_bytes": 0}])
def test_verdicts_equal_brute_force(spark, params):
    """By digests, by digests that collide, and by joins."""
    rnd = random.Random(3)
    labels, tails = ["a", "b", "www", "net", "com", "x-y"], ["", "/", "/a", "/a/b", "/ab", "/é/1"]
    host = lambda: ".".join(rnd.choice(labels) for _ in range(rnd.randrange(1, 4)))
    rules = {(host(), rnd.choice(tails)): rnd.choice(["allow", "block"]) for _ in range(40)}
    rules = [(*k, v) for k, v in rules.items()]
    urls = [*URLS, *[f"http://{host()}{rnd.choice(tails)}{rnd.choice(tails)}{rnd.choice(['', '?q', '#f'])}" for _ in range(300)]]
    for some in (rules, RULES):
        assert judged(spark, urls, some, **params) == [plain_verdict(u, some) for u in urls]


def test_rules_with_nulls_and_repeats(spark):
    rules = [("A.com", "/", "allow"), ("a.com", "/", "block"), (None, "/", "block"), ("b.com", None, "block"), ("", "/", "block"), ("c.com", "/", None)]
    urls = ["http://a.com/x", "http://b.com", "http://c.com/", "http://a.com/x"]
    want = [("a.com", "/x", "a.com/", "block"), ("b.com", "", "b.com", "block"), ("c.com", "/", None, "allow"), ("a.com", "/x", "a.com/", "block")]
    for most in (url_filter.MOST_BYTES, 0):
        assert judged(spark, urls, rules, most_bytes=most) == want
        assert judged(spark, urls, [], most_bytes=most, default="block")[0] == ("a.com", "/x", None, "block")
        assert judged(spark, [], RULES, most_bytes=most) == []
    pages = spark.createDataFrame([(1, "http://com/", "h", "v")], "path int, url string, host string, verdict string")
    got = url_filter.judge(pages.withColumnRenamed("path", "page_id"), spark.createDataFrame(RULES, "host string, path string, verdict string"), ["page_id"])
    assert [tuple(r) for r in got.collect()] == [(1, "com", "/", "com/", "allow")]


def test_digest_file_is_mapped_and_sorted(tmp_path):
    at = tmp_path / "rules.bin"
    at.write_bytes(url_filter.digest_file(RULES))
    array = url_filter.DigestArray(str(at))
    assert isinstance(array.keys, np.memmap) and (np.diff(array.keys.astype(object)) > 0).all() and len(array.keys) == 5
    assert array.find([("net", "/es/"), ("net", "/de/")]) == ["block", None]


def test_digest_columns_come_from_the_operators(spark, data):
    """The registered queries over the given tables."""
    got = entry.queries()["op11_alignment"](spark, data)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    sums = got.agg(F.count("*"), F.min(F.col("n_links") - F.greatest("n_a", "n_b")), F.max(F.col("n_best") - F.col("n_links"))).first()
    assert sums[0] == spark.read.parquet(f"{data}/documents.parquet").count() and sums[1] >= 0 >= sums[2]
