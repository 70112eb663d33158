"""Mixing, near-duplicates, lines, decontamination and the pipeline against brute force."""

import collections
import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from caseflow.llm import common as C, decontamination, line_dedup, mixing, near_dup
from caseflow.llm.components import connected_components
from caseflow.llm.queries import QUERIES

DOCS = "doc_id bigint, text string, source string"


# ---------------------------------------------------------------- mixing


def docs_of(spark, sizes, length=99):
    rows, n = [], 0
    for source, count in sizes.items():
        for _ in range(count):
            rows.append((n, "x" * length, source))
            n += 1
    return spark.createDataFrame(rows, DOCS)


@pytest.mark.parametrize("weights", [None, {"a": 5, "b": 3, "c": 1, None: 2}, {"a": 1, "b": 1}])
def test_every_source_stays_within_a_block_of_its_share(spark, weights):
    """Blocks of one document: slots are a permutation, and shares hold until a source runs out."""
    sizes = {"a": 160, "b": 70, "c": 24, None: 40}
    w = weights and spark.createDataFrame(list(weights.items()), "source string, weight int")
    rows = mixing.mix(docs_of(spark, sizes), w, block_units=100, cycle=50).collect()
    order = [r["source_key"] for r in sorted(rows, key=lambda r: (r["mix_slot"], r["mix_offset"]))]
    assert sorted(r["mix_slot"] for r in rows) == list(range(294))
    assert len({r["doc_id"] for r in rows}) == 294
    key = lambda s: "-" if s is None else f"={s}"
    want = {key(s): (weights or {}).get(s, 1) if weights else math.isqrt(n) for s, n in sizes.items()}
    total = sum(want.values())
    share, rest = {k: 50 * x // total for k, x in want.items()}, {}
    for k in sorted(want, key=lambda k: (-(50 * want[k] % total), k))[: 50 - sum(share.values())]:
        share[k] += 1
    slots = sum(share.values())
    first_out = min(sizes[s] / share[key(s)] for s in sizes)
    until = math.floor(sum(min(sizes[s], share[key(s)] * first_out) for s in sizes))
    seen = collections.Counter()
    for at, k in enumerate(order[:until], 1):
        seen[k] += 1
        assert all(abs(seen[x] - at * share[x] / slots) < 1 for x in share), at
    assert rest == {}


def test_a_share_survives_when_others_run_out(spark):
    rows = mixing.mix(docs_of(spark, {"a": 300, "b": 300, "c": 10}), None, block_units=100, cycle=30).collect()
    tail = [r["source_key"] for r in sorted(rows, key=lambda r: r["mix_slot"])][-200:]
    assert abs(tail.count("=a") - 100) <= 1


def test_mixing_edges(spark):
    rows = [(1, None, "a"), (1, None, "a"), (2, "", None), (None, "y" * 500, "a"), (3, "z" * 100_000, "b")]
    df = spark.createDataFrame(rows, DOCS).withColumn("mix_slot", F.lit("mine"))
    out = mixing.mix(df, block_units=64, cycle=10)
    assert out.count() == 5 and out.where("mix_slot is null or mix_offset < 0").count() == 0
    laid = mixing.in_mix_order(df, block_units=64, cycle=10)
    assert laid.columns == df.columns and sorted(map(str, laid.collect())) == sorted(map(str, df.collect()))
    assert mixing.mix(df.where("doc_id > 9")).count() == 0
    assert mixing.in_mix_order(df.where("doc_id > 9")).count() == 0


def test_stages_of_the_main_path_are_native(spark, data):
    for out in (mixing.mix(C.table(spark, data, "documents")), QUERIES["op6_line_dedup"](spark, data)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "ExternalRDD"))


# ---------------------------------------------------------------- near-duplicates


def brute_classes(texts, k, num, den):
    sets = {}
    for i, t in texts:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        w = [x for x in __import__("re").findall(r"[^\x20\x09-\x0D]+", low)]
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in itertools.combinations(sorted(sets), 2):
        both = len(sets[i] & sets[j])
        if sets[i] and sets[j] and den * both >= num * (len(sets[i]) + len(sets[j]) - both):
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in sets}


def found(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()}


def test_op5_matches_brute_force(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()
    assert found(QUERIES["op5_near_duplicates"](spark, data)) == brute_classes([tuple(r) for r in docs], 3, 85, 100)


@pytest.mark.parametrize("block", [1000, 12])
def test_a_family_of_copies_near_the_threshold(spark, monkeypatch, block):
    """Copies with many small changes, copies of copies, and halves: links not through the centre count."""
    monkeypatch.setattr(near_dup, "BLOCK", block)
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    base = [rnd.choice(words) for _ in range(120)]
    texts = []
    for n in range(60):
        w = list(base)
        for at in rnd.sample(range(120), rnd.randint(0, 12)):
            w[at] = rnd.choice(words[:40])
        texts.append(w)
    for w in texts[:20]:
        v = list(w)
        v[rnd.randrange(120)] = "copy"
        texts.append(v)
    texts += [base[:60], base[:59], base[60:]]
    rows = [(i, " ".join(w)) for i, w in enumerate(texts)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert found(near_dup.near_duplicates(df, 3, 85, 100)) == brute_classes(rows, 3, 85, 100)


def test_near_duplicate_edges(spark):
    rows = [(1, None, "k"), (2, "", "k"), (3, "A b", "k"), (4, "a\tB", "k"), (5, "Ä b", "k"), (6, " a b c ", "k"), (6, " a b c ", "k"), (None, "a b", "k"), (7, "a b c", "k")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, component_id string")
    out = near_dup.near_duplicates(df, 3, 85, 100)
    assert found(out.where("doc_id is not null")) == {
        1: (0, 1, True), 2: (0, 2, True), 3: (1, 3, True), 4: (1, 3, False), 5: (1, 5, True), 6: (1, 6, True), 7: (1, 6, False),
    }
    assert out.count() == 9 and out.where("doc_id is null").first()["kept"] is True
    kept = near_dup.drop_near_duplicates(df, k=3, num=85, den=100)
    assert kept.columns == df.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "2", "3", "5", "6", "None"]
    assert near_dup.near_duplicates(df.where("doc_id > 9"), 3, 85, 100).count() == 0


def test_tables_reach_the_threshold():
    for t in (0.8, 0.85, 0.9):
        half = near_dup.half_tables(t)
        assert 2 * (1 - t**near_dup.ROWS) ** half <= 2 * near_dup.MISS


def test_components(spark):
    rnd = random.Random(1)
    links = [(rnd.randrange(400), rnd.randrange(400)) for _ in range(300)] + [(0, i) for i in range(500, 700)] + [(i, i + 1) for i in range(800, 840)]
    df = spark.createDataFrame(links + [(5, 5), (None, 3)], "a bigint, b bigint")
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {r["node"]: r["component"] for r in connected_components(df, "a", "b").collect()}
    assert got == {x: find(x) for pair in links for x in pair if pair[0] != pair[1]}
    assert connected_components(df.where("a > 9999"), "a", "b").count() == 0


# ---------------------------------------------------------------- lines


def brute_lines(rows, least):
    sites = collections.defaultdict(set)
    for _, t, s in rows:
        for line in (t or "").split("\n"):
            if line.strip(" \t\n\x0b\f\r") and s is not None:
                sites[line.strip(" \t\n\x0b\f\r")].add(s)
    bad = {x for x, s in sites.items() if len(s) >= least}
    out = []
    for i, t, _ in rows:
        lines = t.split("\n") if t is not None else []
        kept = [x for x in lines if x.strip(" \t\n\x0b\f\r") not in bad]
        out.append((i, len(lines), len(lines) - len(kept), None if t is None else "\n".join(kept)))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [2, 3, 7])
def test_lines_match_brute_force(spark, least):
    rnd = random.Random(least)
    pool = [f"line {i}" for i in range(30)] + ["", "  ", " line 3\t"]
    rows = [(i, "\n".join(rnd.choice(pool) for _ in range(rnd.randint(0, 6))), rnd.choice("abcdefgh")) for i in range(60)]
    rows += [(90, None, "a"), (91, "", "b"), (92, "line 1\nline 1", None), (None, "line 2\nx", "c"), (None, "line 2\nx", "c")]
    df = spark.createDataFrame(rows, DOCS).withColumn("n_lines", F.lit(0))
    got = sorted((tuple(r) for r in line_dedup.drop_boilerplate(df, min_sites=least).collect()), key=str)
    assert got == brute_lines(rows, least)
    assert line_dedup.drop_boilerplate(df.where("doc_id > 999")).count() == 0


def test_only_lines_near_the_threshold_are_counted_exactly(spark):
    """With many sites the sketch is off by a little; the answer is not."""
    rows = [(F.lit(f"l{n}"), n) for n in (95, 99, 100, 101, 150, 600)]
    parts = [spark.range(n).select(F.xxhash64(x).alias("h1"), F.lit(0).alias("h2"), F.col("id").cast("string").alias("site")) for x, n in rows]
    df = parts[0]
    for p in parts[1:]:
        df = df.unionByName(p)
    assert line_dedup.boilerplate(df.union(df), 100).count() == 4


# ---------------------------------------------------------------- decontamination

ITEM = "A train leaves Boston at 9 with 30 passengers and travels 120 km before it reaches Albany with 30 passengers on board"


def hits(spark, docs, items=((1, ITEM),)):
    d = spark.createDataFrame(list(docs), "doc_id bigint, text string").withColumn("item_id", F.lit("x"))
    b = spark.createDataFrame(list(items), "item_id bigint, text string")
    return {(r["doc_id"], r["item_id"]): r["run_tokens"] for r in decontamination.matches(d, b).collect()}


def test_copies_and_new_parameters_are_caught(spark):
    changed = ITEM.replace("Boston", "Chicago").replace("30", "45").replace("120", "999").replace("Albany", "Detroit")
    mixed = ITEM.replace("30", "45", 1)  # the two 30s differ now: another question
    docs = [
        (1, "Some words come first. " + ITEM + " and more."),
        (2, changed),
        (3, ITEM.lower()),
        (4, "A train leaves. It is late, and nobody knows why it travels at all with so many passengers on board"),
        (5, None),
        (6, ""),
        (7, ITEM.upper()),
        (8, "*** " + ITEM.replace(" ", " *** ")),
        (9, mixed.replace("Boston", "Here")),
        (None, ITEM),
        (1, ITEM),
    ]
    got = hits(spark, docs)
    assert set(got) == {(1, 1), (2, 1), (3, 1), (7, 1), (8, 1)}
    assert got[(2, 1)] == len(ITEM.split())


def test_parts_and_short_items(spark):
    words = ITEM.split()
    items = [(1, ITEM), (2, "what is the capital city of France"), (3, "yes or no"), (4, None), (5, "")]
    docs = [(1, " ".join(words[:13])), (2, " ".join(words[:12])), (3, "Tell me, what is the capital city of Spain now"), (4, "yes or no")]
    assert set(hits(spark, docs, items)) == {(1, 1), (3, 2)}
    assert hits(spark, docs, []) == {}
    assert hits(spark, []) == {}


def test_planted_passages(spark, data):
    """Every document of the table that holds a whole item, and no other."""
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{data}/benchmark.parquet").collect()
    plain = lambda t: " ".join("".join(c if c.isalnum() else " " for c in t.lower()).split())
    want = {(d["doc_id"], b["item_id"]) for d in docs for b in items if f" {plain(b['text'])} " in f" {plain(d['text'])} "}
    got = {(r["doc_id"], r["item_id"]) for r in QUERIES["op7_decontamination"](spark, data).collect()}
    assert want and got == want
    left = decontamination.decontaminate(C.table(spark, data, "documents"), C.table(spark, data, "benchmark"))
    assert left.columns == C.table(spark, data, "documents").columns
    assert {r["doc_id"] for r in left.collect()} == {d["doc_id"] for d in docs} - {i for i, _ in want}


# ---------------------------------------------------------------- pipeline


def test_stages_hand_on_documents(spark, data):
    docs = C.table(spark, data, "documents")
    columns, sizes = docs.columns, [docs.count()]
    odd = docs.limit(0).unionByName(spark.createDataFrame([(None, None, None, None, None), (10**9, "", None, None, 0)], docs.schema))
    docs = docs.unionByName(odd)
    for name, stage in P.STAGES[:-1]:
        docs = C.stored(stage(spark, docs, data), f"test-{name}")
        assert docs.columns == columns
        assert docs.where("doc_id is null").count() == 1 and docs.where("doc_id = 1000000000").count() == 1
        sizes.append(docs.count())
    assert sizes[-1] == sizes[-2] < sizes[0]
    assert found(near_dup.near_duplicates(docs.where("text <> ''"), 5, 80, 100)).keys() == {
        k for k, v in found(near_dup.near_duplicates(docs.where("text <> ''"), 5, 80, 100)).items() if v[2]
    }
    packed = P.STAGES[-1][1](spark, docs, data)
    ids = {i for r in packed.select("doc_ids").collect() for i in r[0]}
    assert ids == {r[0] for r in docs.select("doc_id").collect()}


def test_empty_documents_pass_every_stage(spark, data):
    docs = C.table(spark, data, "documents").where("doc_id < 0")
    for name, stage in P.STAGES:
        docs = C.stored(stage(spark, docs, data), f"empty-{name}")
        assert docs.count() == 0
