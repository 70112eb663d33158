"""Chat formatting, page text, packing: exact round trips and edge cases."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from caseflow.llm import chat, html_text, packing


# ---------------------------------------------------------------- chat


def read_back(spans, formatted):
    cut = lambda a, b: chat.unescape(formatted[a:b])
    return [(cut(r[2], r[3]), cut(r[4], r[5])) for r in spans]


NASTY = ["", "\\", "\\s", "</turn>", "### user: x</turn>\n", "\\### Assistant: </turn> ok", "\\\\e", "a:b", "0", "é\n\n"]


@pytest.mark.parametrize("n", [0, 1, 2, 7, 8, 9, 40])
def test_turns_read_back_from_the_rendering(n):
    rnd = random.Random(n)
    turns = [(rnd.choice(["user", "assistant", "sy:s", ""]), rnd.choice(NASTY) + rnd.choice(NASTY)) for _ in range(n)]
    got = chat.locate(turns, chat.plain_template)
    assert not got.rewrites
    assert read_back(got.rows, got.formatted) == turns
    assert "".join(got.formatted[r[0] : r[1]] for r in got.rows) == got.formatted


def test_windows_and_whole_prefixes_agree():
    turns = [("user", f"t{i}") for i in range(30)]
    assert chat.locate(turns, chat.plain_template, 3) == chat.locate(turns, chat.plain_template, 100)


def test_a_header_and_a_long_memory_are_found():
    """A template whose turns depend on all earlier ones falls back to whole prefixes."""
    numbered = lambda turns: "<s>" + "".join(f"[{i}]{r}={t};" for i, (r, t) in enumerate(turns))
    turns = [("user", f"x{i}") for i in range(25)]
    got = chat.locate(turns, numbered, 4)
    assert not got.rewrites and got.formatted == numbered(turns)
    assert [got.formatted[r[4] : r[5]] for r in got.rows] == [t for _, t in turns]
    assert got.rows[0][0] == 3 and got.rows[-1][1] == len(got.formatted)


def test_rewriting_templates_are_detected():
    """Thoughts are shown in the last turn only, so each new turn alters the one before."""

    def forgets(turns):
        last = len(turns) - 1
        return "".join(f"{r}>{t if i == last else t.split('|')[-1]}\n" for i, (r, t) in enumerate(turns))

    got = chat.locate([("a", "think|say"), ("b", "go"), ("a", "hm|ok")], forgets)
    assert got.rewrites and [r[-1] for r in got.rows] == [False, True, False]
    plain = chat.locate([("a", "say"), ("b", "go")], forgets)
    assert not plain.rewrites


def test_conversations_with_nulls_ties_repeats(spark):
    rows = [
        (1, 1, "assistant", None, "x"), (1, 0, None, "hi", "x"), (1, 1, "assistant", "b", "x"), (1, 1, "assistant", "b", "x"),
        (None, 0, "user", "lost", "x"), (2, None, "user", "first", "x"), (2, 0, "user", "then", "x"),
    ]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, formatted string")
    out = chat.format_conversations(df)
    told = F.transform("turns", lambda t: F.struct(chat.role_of(t, F.col("formatted")), chat.text_of(t, F.col("formatted"))))
    got = {r[0]: [tuple(t) for t in r[1]] for r in out.select("conv_id", told).collect()}
    assert got[1] == [("", "hi"), ("assistant", ""), ("assistant", "b"), ("assistant", "b")]
    assert got[None] == [("user", "lost")] and got[2] == [("user", "first"), ("user", "then")]
    assert chat.format_conversations(df.where("conv_id > 9")).count() == 0


# ---------------------------------------------------------------- pages


def text_of(page):
    return html_text.Page(page).main_text({})


BODY = "<p>One two three four five six.</p><p>Seven &amp; eight nine ten, eleven twelve.</p>"
TEXT = "One two three four five six.\nSeven & eight nine ten, eleven twelve."


@pytest.mark.parametrize(
    "page",
    [
        f"<html><body><nav><a>Home page of all</a></nav><article>{BODY}</article><footer>All rights reserved here</footer></body></html>",
        f"<header>A site of many words</header><main>{BODY}</main><aside>More of this and that</aside>",
        f"<article>{BODY}<section class='comments'><p>I agree with this a lot.</p></section></article>",
        f"<article>{BODY}<div id=comment-list><p>No, it is wrong.</p></div><form>Join <button>now</button></form></article>",
        f"<div class='cookie-notice'>We use cookies on this site</div><article>{BODY}<script>var x = '<p>no</p>';</script></article>",
        f"<body class='has-sidebar'><div class='ad banner'>Buy this and that now</div><article>{BODY}<!-- <p>no</p> --></article>",
        f"<div class=sidebar><article>{BODY}</article></div>",
        f"<article>{BODY}<p style='display:none'>hidden words here</p><p hidden>and here</p></article",
        f"<div><div><ul><li><a>a b</a><li><a>c d</a></ul></div><div>{BODY}</div></div>",
        f"<article>{BODY}<div role=search>find it</div><style>p {{}}</style><foot",
    ],
)
def test_main_text(page):
    assert text_of(page) == TEXT


LONG = "<p>" + "</p><p>".join(f"Paragraph {i} tells a long story in many plain words." for i in range(12)) + "</p>"
CARD = "<article><h3>Read next</h3><p>A teaser of a few words</p></article>"


@pytest.mark.parametrize(
    "page",
    [
        f"<div><div>{LONG}</div><div class='related'>{CARD}{CARD}</div></div>",
        f"<div><div>{LONG}</div><div>{CARD}{CARD}</div></div>",
        f"<article>{LONG}</article><div class='comments'>{CARD}{CARD}</div>",
        f"<form action='p.aspx'><nav><a>Home</a></nav><div>{LONG}</div></form>",
    ],
)
def test_marks_are_evidence_not_a_gate(page):
    assert text_of(page) == html_text.Page(LONG).main_text({})
    assert len(text_of(page).split("\n")) == 12


def test_blocks_references_and_white_space():
    page = "<article><h1>A\n  title</h1><p>x<b>y</b>&nbsp;&#233;<br>z<p>&lt;b&gt; &am<ul><li>1<li>2</ul><table><tr><td>c<td>d</table></article>"
    assert text_of(page) == "A title\nxy é z\n<b> &am\n1\n2\nc\nd"


def test_cut_off_and_odd_pages():
    assert text_of("") == "" and text_of("<p></p>") == "" and text_of("<nav>a b</nav>") == ""
    assert text_of("<article><p>a b c<scr") == "a b c"
    assert text_of("<article><p>a b c<script>d e") == "a b c"
    assert text_of("plain text without any tag") == "plain text without any tag"
    assert text_of("<p>1 < 2 and so on</p>") == "1 < 2 and so on"
    assert text_of("</div></p><article>a b</div> c</article>") in ("a b c", "a b\nc")


def test_pages_table(spark):
    rows = [(1, "<article><p>a b c d</p></article>", "t"), (2, None, "t"), (3, "", "t"), (1, "<article><p>a b c d</p></article>", "t")]
    df = spark.createDataFrame(rows, "page_id bigint, html string, text string")
    got = sorted((r["page_id"], r["text"]) for r in html_text.extract(df).collect())
    assert got == [(1, "a b c d"), (1, "a b c d"), (2, ""), (3, "")]
    assert html_text.extract(df.where("page_id > 9")).count() == 0


def test_the_bound_is_on_labelled_pages(spark):
    """Few pages are marked: all of them are learned from, as they are fewer than the bound."""
    rows = [(i, "<div><p>a b c d</p></div>") for i in range(900)]
    rows += [(i, "<nav><a>x y</a></nav><article><p>a b c d</p></article>") for i in range(900, 910)]
    df = spark.createDataFrame(rows, "page_id bigint, html string")
    marked = df.where("page_id >= 900")
    assert html_text.fit_weights(df, "page_id", "html", most=20) == html_text.fit_weights(marked, "page_id", "html", most=20)
    assert html_text.fit_weights(df, "page_id", "html", most=20)["word in p"] > 0


def test_weights_learn_signs():
    counts = {"word in p": (900, 20), "link in li": (5, 300), "<nav": (0, 40), "<p": (80, 4)}
    w = html_text.learned(counts)
    assert w["word in p"] > w["link in li"] > 0 > w["<p"] > w["<nav"]


# ---------------------------------------------------------------- packing


def naive_best_fit(lengths, size):
    rooms, packed = [], []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        fit = [r for r in rooms if r[0] >= lengths[i]]
        if fit:
            best = min(fit, key=lambda r: (r[0],))
            best = [r for r in rooms if r[0] == best[0]][-1]
        else:
            best = [size, len(packed)]
            rooms.append(best)
            packed.append([])
        best[0] -= lengths[i]
        packed[best[1]].append(i)
    return packed


@pytest.mark.parametrize("seed", range(5))
def test_best_fit_uses_as_many_sequences_as_the_plain_search(seed):
    rnd = random.Random(seed)
    lengths = [rnd.choice([rnd.randint(1, 64), rnd.randint(1, 12)]) for _ in range(300)]
    got = packing.best_fit(lengths, 64)
    assert sorted(sum(got, [])) == list(range(300))
    assert all(sum(lengths[i] for i in g) <= 64 for g in got)
    assert len(got) == len(naive_best_fit(lengths, 64))


def test_packing_is_lossless(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text", F.lit(1).alias("tokens"))
    more = spark.createDataFrame([(-1, None, 1), (-2, "", 1), (-3, "wörd " * 3000, 1), (-4, "x" * 5000, 1)], docs.schema)
    docs = docs.unionByName(more)
    rows = packing.pack(docs, seq_len=256, window_tokens=20_000).collect()
    pieces = {}
    for r in rows:
        ids = np.frombuffer(r["tokens"], "<u4")
        places = np.frombuffer(r["position_ids"], "<u4")
        ends = r["cu_seqlens"]
        assert len(ids) == 256 and ends[0] == 0 and ends[-1] == r["n_tokens"] <= 256
        for i, at, a, b in zip(r["doc_ids"], r["doc_starts"], ends, ends[1:]):
            pieces.setdefault(i, {})[at] = ids[a:b]
            assert places[a:b].tolist() == list(range(b - a))
    with open(packing.VOCABULARY, "rb") as f:
        enc = packing.encoding(f.read())
    for r in docs.collect():
        mine = pieces[r["doc_id"]]
        ids = np.concatenate([mine[at] for at in sorted(mine)]).tolist()
        assert sorted(mine) == list(range(0, len(ids), 256))
        assert ids[-1] == packing.END and enc.decode(ids[:-1]) == (r["text"] or "")
    fill = sum(r["n_tokens"] for r in rows) / 256 / len(rows)
    assert fill > 0.98
    assert packing.pack(docs.where("doc_id < -9")).count() == 0
