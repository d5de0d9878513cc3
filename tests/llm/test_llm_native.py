"""URL filter, pseudonyms, and the pipeline."""

from __future__ import annotations

import datetime
import hashlib
import random

import duckdb
import public_tokenizers
import pytest
import sentencepiece

import brute
import corpus_pipeline
from conftest import SF_SMALL
from halokin.llm import oracles, pii, quality, queries, urls

KEY = "test"


# ------------------------------------------------------------------ URLs

URLS = [None, "", "no scheme/x", "https://A.Example.ORG/es/1?x#y", "http://example.org/en/1", "http://example.org/en/2", "http://notexample.org/es/",
        "http://example.org", "http://x.com/fr/a", "http://x.com/de/a", "http://com/fr/", "http://www.x.net/a/?utm_source=f&b=1", "http://x.net/a?b=1",
        "http://x.net/a", "http://x.net/a", "ftp://x.net/q?utm_source=z#/org/", "://", "http://y.net/#utm_source=1"]


def test_urls_match_sql(spark, tmp_path):
    pages = spark.createDataFrame([(i, u, "h", "k") for i, u in enumerate(URLS)], "page_id long, url string, html string, verdict string")
    pages.write.parquet(str(tmp_path / "pages.parquet"))
    for source in (f"{tmp_path}/pages.parquet/*.parquet", f"{SF_SMALL}/pages.parquet"):
        con = duckdb.connect()
        con.execute(f"CREATE VIEW pages AS SELECT * FROM '{source}'")
        want = con.execute(oracles.URL_FILTER).fetchall()
        cols = [d[0] for d in con.description]
        got = queries.op7_url_filter(spark, str(tmp_path) if source.startswith(str(tmp_path)) else SF_SMALL).select(*cols).collect()
        assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_url_rules_and_list(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    listed = spark.createDataFrame([("x.net/a?b=1",), ("x.net/a?b=1",), (None,)], "canonical string")
    for blocks in (1, 1 << 20):
        got = {r.page_id: r for r in urls.filter_urls(pages, listed, queries.URL_RULES, max_blocks=blocks).collect()}
        assert {i for i, r in got.items() if r.verdict == "block"} == {3, 4, 9, 11, 12}
        assert {i: r.rule for i, r in got.items() if r.rule} == {3: "example.org/es/", 4: "example.org/en/1", 5: "org/", 6: "org/", 8: "com/fr/", 9: "com/de/", 10: "com/fr/"}
        assert got[0].host == got[0].path == "" and got[3].host == "a.example.org" and got[3].path == "/es/1"
    assert {r.verdict for r in urls.filter_urls(pages, listed.limit(0), ()).collect()} == {"allow"}
    assert urls.filter_urls(pages.limit(0), listed, queries.URL_RULES).count() == 0


# ------------------------------------------------------------------ pseudonyms

VALID = {
    "card": ["4041894974608795", "4111 1111 1111 1111", "4111-1111-1111-1111", "378282246310005"],
    "iban": ["DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432"],
    "ssn": ["123-45-6789"], "ip": ["70.123.182.155", "0.0.0.0"], "phone": ["+1 (988) 555-2485", "+49 170 1234567"],
    "date": ["1999-02-28", "29.02.2000", "31/12/1800"], "email": ["dikcoc.41@mail7.example.com", "A.b-9@x.org"],
}
INVALID = ["4041894974608796", "DE88 3704 0044 0532 0130 00", "000-45-6789", "123-00-6789", "256.1.1.1", "2021-02-29", "1799-01-01", "31.04.2020",
           "x@y", "12345", "version 4.0.", "1234567890123456789012"]


def python_feistel(digits: str, kind: str) -> str:
    """The same network in Python, for digits."""
    u = len(digits) // 2
    a, b, ma, mb = int(digits[:u]), int(digits[u:]), 10**u, 10 ** (len(digits) - u)
    f = lambda i, x: int(hashlib.sha256(f"{KEY}|{kind}{len(digits)}|{i}|{x}|{KEY}".encode()).hexdigest()[:15], 16)
    for i in range(1, pii.ROUNDS + 1):
        if i % 2:
            a = (a + f(i, b) % ma) % ma
        else:
            b = (b + f(i, a) % mb) % mb
    return f"{a:0{u}d}{b:0{len(digits) - u}d}"


def luhn(d: str) -> bool:
    return sum(x if k % 2 == 0 else (2 * x) // 10 + 2 * x % 10 for k, x in enumerate(map(int, reversed(d)))) % 10 == 0


def test_pseudonyms(spark):
    rows = [(k, v) for k, vs in VALID.items() for v in vs]
    df = spark.createDataFrame([(i, f"see {v}, or {v}. {'x' * i}", "n") for i, (_, v) in enumerate(rows)], "doc_id long, text string, pii string")
    got = {r.doc_id: r for r in pii.pseudonymise(df, KEY).collect()}
    for i, (kind, v) in enumerate(rows):
        (k, value, new), again = got[i].pii
        assert (k, value) == (kind, v) and tuple(again) == (k, value, new) and new != v
        assert got[i].text == f"see {new}, or {new}. {'x' * i}" and got[i][f"n_{kind}"] == 2
        form = lambda s: "".join("9" if c.isdigit() else "a" if c.islower() and kind == "email" and "@" not in s else c for c in s)
        if kind not in ("ip", "email"):
            assert form(new) == form(v)
        digits = "".join(c for c in new if c.isdigit())
        if kind == "card":
            old = "".join(c for c in v if c.isdigit())
            assert luhn(digits) and digits[:-1] == python_feistel(old[:-1], "card")
        if kind == "iban":
            flat = new.replace(" ", "")
            assert int("".join(str(int(c, 36)) for c in flat[4:] + flat[:4])) % 97 == 1
        if kind == "ip":
            assert all(0 <= int(o) <= 255 for o in new.split("."))
        if kind == "date":
            y, m, d = (new[:4], new[5:7], new[8:]) if new[4] == "-" else (new[6:], new[3:5], new[:2])
            assert datetime.date(int(y), int(m), int(d)) and 1800 <= int(y) < 2200
        if kind == "email":
            assert new.split("@")[1] == v.split("@")[1] and len(new) == len(v)
        if kind == "phone":
            assert new.split()[0] == v.split()[0]
    out = pii.pseudonymise(df, KEY)
    back = pii.pseudonymise(out.select("doc_id", "text"), KEY, decrypt=True)
    assert {r.doc_id: r.text for r in back.collect()} == {r.doc_id: r.text for r in df.collect()}
    assert {r.text for r in pii.pseudonymise(df, "other key").collect()}.isdisjoint({r.text for r in got.values()})


def test_pseudonyms_are_a_permutation(spark):
    """All values of a small format map one to one."""
    days = [(datetime.date(2000, 1, 1) + datetime.timedelta(k)).isoformat() for k in range(1500)]
    df = spark.createDataFrame([(d,) for d in days], "text string")
    assert len({r.text for r in pii.pseudonymise(df, KEY).collect()}) == 1500
    df = spark.range(2000).selectExpr("concat('10.0.', id div 250, '.', id % 250) AS text")
    assert pii.pseudonymise(df, KEY).distinct().count() == 2000


def test_invalid_and_missing_values_stay(spark):
    texts = [*INVALID, None, "", "plain words only", "a@", "1" * 5000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in pii.pseudonymise(df, KEY).collect()}
    assert [got[i].text for i in range(len(texts))] == texts and all(r.pii == [] for r in got.values())
    assert pii.pseudonymise(df.limit(0), KEY).count() == 0


CARD, MORE = "4111 1111 1111 1111", ["743-555-3824", "743.555.3824", "ES91 2100 0418 4502 0005 1332", "AT61 1904 3002 3457 3201", "BE68 5390 0754 7034"]
BESIDE = [("in 2023 {} ok", CARD), ("2023-{}", CARD.replace(" ", "-")), ("{} 2023", CARD), ("12 {} 7", CARD), ("2023-{}", "123-45-6789"),
          ("2020-01-01-{}", "2021-01-01"), ("EUR {} EUR", CARD), ("\ufdd0 1234 {} \ufdd1\ufdd2", CARD), ("DE12 {}", "GB82 WEST 1234 5698 7654 32"),
          *((form, v) for v in MORE + ["GB82WEST12345698765432", "70.123.182.155", "+1 988 555 2485"]
            for form in ("{} EUR", "{} BIC 12", "{} 2001", "2023 {}", "SWIFT {} X"))]


def test_a_failed_candidate_hides_nothing(spark):
    df = spark.createDataFrame([(i, form.format(v)) for i, (form, v) in enumerate(BESIDE)], "doc_id long, text string")
    got = {r.doc_id: r for r in pii.pseudonymise(df, KEY).collect()}
    for i, (form, v) in enumerate(BESIDE):
        new = {value: p for _, value, p in got[i].pii}
        assert v in new and new[v] != v and (len(new) > 1 or got[i].text == form.format(new[v])), (form, v, got[i])
    phone_and_card = spark.createDataFrame([("+49 30 1234567 " + CARD,), (CARD + " " + CARD,)], "text string")
    assert [[(k, v) for k, v, _ in r.pii] for r in pii.pseudonymise(phone_and_card, KEY).collect()] == [
        [("phone", "+49 30 1234567"), ("card", CARD)], [("card", CARD), ("card", CARD)]]


# ------------------------------------------------------------------ pipeline


def test_pipeline_matches_brute_force(spark):
    """The learned rules are taken from the library; everything else is done in plain Python."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    rules = quality.learn_rules(quality.text_stats(docs), labels)
    kept = {r.doc_id for r in quality.apply_rules(quality.text_stats(docs), rules).where("kept").collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id in kept]
    lined = brute.dedup_lines(rows)
    rows = [(i, t) for i, (n, e, m, t) in lined.items() if n == 0 or e + m < n]
    components = brute.near_components(rows, 5, 80)
    rows = [r for r, (i, _, c) in zip(rows, components) if i == c]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(corpus_pipeline.MODEL))
    want = {i: sp.encode(t) for i, (_, _, _, t) in brute.passages(rows, items).items()}
    got = corpus_pipeline.run(spark, SF_SMALL)
    assert {r.doc_id: r.ids for r in got.collect()} == want and got.count() == len(want)


@pytest.mark.parametrize("stage", range(5))
def test_stages_take_odd_rows(spark, stage, tmp_path):
    """Nulls in any column, repeats and an empty table; all but the last keep the columns."""
    name, run = corpus_pipeline.STAGES[stage]
    rng = random.Random(stage)
    text = " ".join(rng.choice(["one", "two", "three", "four", "five"]) + str(rng.randint(0, 50)) for _ in range(80))
    rows = [(1, text, "en", "s", 5), (1, text, "en", "s", 5), (2, None, None, None, None), (None, "q " + text, None, "s", 3), (3, "", "", "", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(1, None, None), (None, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(None, "a b"), (1, None), (2, "")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    out = run(spark, docs, str(tmp_path))
    assert out.count() >= 1 and run(spark, docs.limit(0), str(tmp_path)).count() == 0
    if stage < 4:
        assert out.columns == docs.columns
    if name == "near_dedup":
        assert sorted((r.doc_id for r in out.collect()), key=repr) == [1, 2, 3]
