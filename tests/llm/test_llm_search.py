"""Ranked search, tokenizer alignment and HTML text against plain-Python versions."""

from __future__ import annotations

import hashlib
import html
import math
import re
from collections import Counter

import numpy as np
import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from brute import LOWER
from conftest import SF_SMALL
from halokin.llm import alignment, html_text, queries, search

BPE, MODEL = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


# ------------------------------------------------------------------ op11

def ranked(docs, items, k=10):
    """Rows (item, rank, doc_id, score), sorted; docs and items are (id, text)."""
    found = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    found = [(i, c) for i, c in found if c]
    n_docs, total = len(found), sum(sum(c.values()) for _, c in found)
    df = Counter(t for _, c in found for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in found:
            m = 100 - 90 + (90 * sum(c.values()) * n_docs) // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
                    for t in set(TERM.findall((text or "").translate(LOWER))) if t in c)
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()), key=repr)


def test_search_equals_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in queries.table(spark, SF_SMALL, "documents").collect()]
    items = [(r["item_id"], r["text"]) for r in queries.table(spark, SF_SMALL, "benchmark").collect()]
    assert rows_of(queries.op11_ranked_search(spark, SF_SMALL)) == ranked(docs, items)


def test_search_odd_rows(spark):
    same = [(50 - k, "Alpha beta gamma") for k in range(40)]  # ties beyond the tenth
    docs = [*same, (None, "alpha only here"), (None, "alpha only here"), (7, "beta " * 3000 + "delta"), (7, "delta delta"), (100, None), (101, ""), (102, " .,; "),
            (103, "ünïcode ÄÖ漢 x1"), (104, "zeta")]
    items = [(1, "alpha, BETA"), (1, "alpha, BETA"), (None, "delta gamma"), (3, None), (4, ""), (5, "nowhere"), (6, "ünïcode ÄÖ漢"), (7, "beta beta gamma zeta")]
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'x' AS term", "1 AS block").repartition(3)
    q = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "2 AS score", "3 AS rank")
    want = ranked(docs, items)
    for shard, block in ((search.SHARD, search.BLOCK_BYTES), (60, 30)):
        index = search.build_index(d, shard_bytes=shard)
        assert rows_of(search.search(index, q, block_bytes=block)) == want
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert search.search(search.build_index(empty), q).count() == 0
    assert search.search(search.build_index(d), spark.createDataFrame([], "item_id long, text string")).count() == 0
    assert search.search(search.build_index(empty.union(spark.createDataFrame([(1, None)], empty.schema))), q).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.data())
def test_treap_search(data):
    rows, cols = data.draw(st.integers(1, 40)), data.draw(st.integers(1, 70))
    cells = data.draw(st.dictionaries(st.tuples(st.integers(0, rows - 1), st.integers(0, cols - 1)), st.integers(1, 9), min_size=1, max_size=200))
    r, c, v = (np.array(x) for x in zip(*[(a, b, value) for (a, b), value in cells.items()]))
    treap = search.Treap.unpacked(search.Treap.build(r, c, v).packed())
    wanted = data.draw(st.lists(st.dictionaries(st.integers(0, rows - 1), st.integers(1, 4), min_size=1, max_size=6), min_size=1, max_size=4))
    query, row, weight = (np.array(x) for x in zip(*[(q, t, w) for q, terms in enumerate(wanted) for t, w in terms.items()]))
    k = data.draw(st.integers(1, 6))
    got = search.best_first(treap, query, row, weight, np.zeros(len(wanted), np.int64), k, batch=data.draw(st.integers(1, 5)))
    for q, terms in enumerate(wanted):
        score = Counter()
        for (a, b), value in cells.items():
            if a in terms:
                score[b] += terms[a] * value
        mine = sorted((-int(s), int(b)) for g, b, s in zip(*got) if g == q)
        assert mine[:k] == sorted((-s, b) for b, s in score.items())[:k]


# ------------------------------------------------------------------ op12

def aligned(rows):
    """What ``alignment.align`` returns, by the libraries."""
    a_lib, b_lib = Tokenizer.from_file(BPE), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    a_lib.encode_special_tokens = True
    printed = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte = {chr(b): b for b in printed} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in printed)}
    a_bytes = lambda i: bytes(byte[c] for c in a_lib.id_to_token(i))
    b_bytes = lambda i: bytes([int(b_lib.id_to_piece(i)[1:-1], 16)]) if b_lib.is_byte(i) else b_lib.id_to_piece(i).replace("▁", " ").encode()
    found, count = {}, Counter()
    for key, text in rows:
        if not text:
            continue
        ids = a_lib.encode(" " + text, add_special_tokens=False).ids, b_lib.encode(text)
        raw = [[f(i) for i in x] for f, x in zip((a_bytes, b_bytes), ids)]
        if any(b"".join(r) != (" " + text).encode() for r in raw):
            continue
        end_a, end_b = (np.cumsum([len(t) for t in r]).tolist() for r in raw)
        at = {e: j for j, e in enumerate(end_b)}
        cut = [(i + 1, at[e] + 1) for i, e in enumerate(end_a) if e in at]
        links = [(ids[0][i - 1], ids[1][j - 1]) for i, j in cut]
        groups = [",".join(map(str, ids[0][i:k])) + "|" + ",".join(map(str, ids[1][j:m])) for (i, j), (k, m) in zip([(0, 0), *cut], cut)]
        found[key] = (len(ids[0]), len(ids[1]), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest())
        count.update(links)
    top: Counter = Counter()
    for (_, b), n in count.items():
        top[b] = max(top[b], n)
    return {key: (0, 0, 0, 0, 0, 0, "") if key not in found else
            (*found[key][:3], len(x := found[key][3]), sum(count[p] == top[p[1]] for p in x), sum(count[p] for p in x), found[key][4]) for key, _ in rows}


def test_alignment_equals_the_libraries(spark):
    odd = [None, "", "a▁b", "x <|endoftext|> y</s> <0x41>", "  ", "\n", "é漢👍 " * 300, "same text", "same text", "I'm  here\t 12345 \x00", "long " * 400_000]
    docs = [(r["doc_id"], r["text"]) for r in queries.table(spark, SF_SMALL, "documents").collect()] + [(-1 - k, t) for k, t in enumerate(odd)]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'c' AS chunk", "doc_id + 1 AS row", "0 AS n_a", "1 AS links").repartition(3)
    got = alignment.align(df, BPE, MODEL)
    assert got.columns == ["doc_id", "chunk", "row", "links", *alignment.ADDED]
    rows = got.collect()
    assert len(rows) == len(docs) and all((r["chunk"], r["row"], r["links"]) == ("c", r["doc_id"] + 1, 1) for r in rows)
    assert {r["doc_id"]: tuple(r[c] for c in alignment.ADDED) for r in rows} == aligned(docs)


def test_alignment_of_empty_tables(spark):
    assert alignment.align(spark.createDataFrame([], "doc_id long, text string"), BPE, MODEL).count() == 0
    only = alignment.align(spark.createDataFrame([(None,), ("a",)], "text string"), BPE, MODEL).collect()
    assert sorted(r["n_links"] for r in only) == [0, 1]


def test_benchmark_blocks_are_searched_one_at_a_time(spark):
    from halokin.llm import decontam

    docs, items = (queries.table(spark, SF_SMALL, t) for t in ("documents", "benchmark"))
    docs = docs.select("doc_id", "text")
    whole, cut = decontam.mark_passages(docs, items), decontam.mark_passages(docs, items, block_bytes=2000)
    assert cut._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    key = lambda r: (r["doc_id"], r["n_hit"], r["items"], [tuple(s) for s in r["spans"]])
    assert sorted(map(key, cut.collect())) == sorted(map(key, whole.collect()))


# ------------------------------------------------------------------ op13

S = "The quick brown fox jumps over the lazy dog near the river bank, and then it runs home again."


def texts(spark, pages):
    df = spark.createDataFrame(list(enumerate(pages)), "page_id long, html string").selectExpr("*", "'old' AS text", "'u' AS words").repartition(2)
    out = html_text.extract(df)
    assert out.columns == ["page_id", "words", "text", "n_chars"]
    rows = sorted(out.collect())
    assert all(r["n_chars"] == len(r["text"]) for r in rows)
    return [r["text"] for r in rows]


def test_the_labelled_table_is_learned():
    x, y = html_text.labelled_blocks()
    assert len(y) < 200 and (html_text.DecisionTree(x, y)(x) == y).mean() > 0.97


def test_html_layouts(spark):
    chrome = ('<div id="top-menu"><a href=x>Home</a> <a href=y>About us</a></div><div class="cookie-notice">We use cookies on this site for all of you.</div>',
              f'<div id="comments"><h3>Comments</h3><p>Bob: {S} {S}</p></div><div class="siteFooter"><div id=footer>Copyright 2020 by us.</div></div>')
    body = f'<h1>A title</h1><p>{S}</p><p>Short one.</p><div class="ad">Buy now! {S}</div><p>{S}&nbsp;&lt;end&gt; &amp;c&copy</p>'
    want = f"A title\n{S}\nShort one.\n{S} <end> &c©"
    pages = [f'<html><head><title>T</title></head><body>{chrome[0]}<div class="content">{body}</div>{chrome[1]}</body></html>',
             f"{chrome[0]}<article>{body}</article>{chrome[1]}",
             f"<header><h1>Site</h1><nav><ul><li><a href=a>A</a><li><a href=b>B</a></ul></nav></header><main>{body}<form>Name <input><textarea>{S}</textarea>"
             f"<button>Send</button></form></main><aside><p>{S}</p></aside><footer>{S}</footer>",
             f'<body><table><tr><td><a href=1>One</a><td><a href=1>Two</a></table><h2>Plain title</h2><p>{S} {S}<p>{S}<p>Ok.<p>{S}<hr><a href=z>Back</a>',
             f'<ARTICLE><P>{S}<SCRIPT>var t="</p>";</SCRIPT><STYLE>p{{}}</STYLE><!-- <p>{S}</p> --> in\n\t <b>b</b>old<BR>x</ARTICLE>',
             None, "", "<!-- open", "<script>" + S, "<p", "plain " + S, f"<div><p>{S}</div></div></p>{S}", "<div>" * 50_000 + S, f"<article><p>{'word ' * 200_000}</p></article>"]
    assert texts(spark, pages) == [want, want, want, f"Plain title\n{S} {S}\n{S}\nOk.\n{S}", f"{S} in bold x", "", "", "", "", "", "plain " + S, f"{S}\n{S}", S,
                                   ("word " * 200_000).strip()]
    assert html_text.extract(spark.createDataFrame([], "page_id long, html string")).count() == 0


def test_html_of_the_given_pages(spark):
    """The template's article, cut out by its tags."""
    def article(page):
        inner = page[page.index("<article>") + 9: page.index("</article>")]
        blocks = (" ".join(html.unescape(re.sub("<br>", " ", b).replace("<b>", "").replace("</b>", "")).split()) for b in re.split("</?(?:p|h1)>", inner))
        return "\n".join(b for b in blocks if b)

    pages = {r["page_id"]: r["html"] for r in queries.table(spark, SF_SMALL, "pages").collect()}
    got = {r["page_id"]: r["text"] for r in queries.op13_html_text(spark, SF_SMALL).collect()}
    assert got == {k: article(p) for k, p in pages.items()}


# ------------------------------------------------------------------ op8, in steps

def test_backoff_exchange_in_steps(spark, monkeypatch):
    """With small chunks, parts and steps: the same scores, and requests that follow the text, not its square."""
    from halokin.llm import lm

    docs = queries.table(spark, SF_SMALL, "documents").select("doc_id", "text").where("length(text) < 3000").limit(60)
    key = lambda df: sorted((r["doc_id"], r["n_words"], r["n_backoff"], round(r["log_score"], 6)) for r in df.collect())
    kept, written = lm.materialize, []

    def counting(df, tag):
        out = kept(df, tag)
        written.append((tag, out.count()))
        return out

    monkeypatch.setattr(lm, "CHUNK", 3000)
    monkeypatch.setattr(lm, "materialize", counting)
    each = []
    for times in (1, 2, 4):
        many = docs.crossJoin(spark.range(times)).selectExpr("doc_id * 10 + id AS doc_id", "text")
        want = key(lm.lm_scores(many))
        written.clear()
        got = key(lm.lm_scores(many, part_bytes=3000, least_parts=1, fan_bits=2))
        assert got == want
        chunks = dict(written)["lm-chunks"]
        steps = [n for tag, n in written if tag in ("lm-requests", "lm-answers")]
        assert len(steps) >= 3 and all(n <= 4 * chunks + 64 for n in steps), (chunks, steps)
        each.append(sum(steps) / len(steps) / chunks)
    assert each[-1] <= 1.3 * each[0]
