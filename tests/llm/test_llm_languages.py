"""Language mixtures against a plain-Python version, and odd rows."""

from __future__ import annotations

import math
from collections import Counter

import pytest

from conftest import SF_SMALL
from halokin.llm import langid, queries


def grams(text: str) -> list[int]:
    """Buckets of the byte trigrams of a text whose non-letters are spaces, runs of spaces single."""
    out = bytearray()
    for b in b" " + text.lower().encode("utf-8", "replace") + b" ":
        b = b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
        if b != 0x20 or not out or out[-1] != 0x20:
            out.append(b)
    codes = [out[i] << 16 | out[i + 1] << 8 | out[i + 2] for i in range(len(out) - 2)]
    return [((c * 0x9E3779B1) & 0xFFFFFFFF) >> (32 - 15) for c in codes]


def learned(rows: list[tuple[str | None, str | None]]) -> tuple[list[str], list[list[float]]]:
    """(languages, by language the log probability of each bucket)."""
    counts: dict[str, Counter] = {}
    for text, lang in rows:
        if text is not None and lang is not None:
            counts.setdefault(lang, Counter()).update(grams(text) if text else [])
    langs = sorted(k for k, c in counts.items() if c)
    out = []
    for lang in langs:
        total = sum(counts[lang].values()) + 0.1 * 2 ** 15
        out.append([math.log((counts[lang][b] + 0.1) / total + 1e-9) for b in range(2 ** 15)])
    return langs, out


def em(p: list[list[float]], n: list[float], share: list[float]) -> tuple[list[float], float]:
    total = sum(n)
    mix = lambda row, s: sum(x * y for x, y in zip(row, s))
    for _ in range(60):
        new = [0.0] * len(share)
        for row, k in zip(p, n):
            m = mix(row, share)
            for j, x in enumerate(row):
                new[j] += share[j] * x * k / m
        new = [x / total for x in new]
        done = max(abs(a - b) for a, b in zip(new, share)) < 1e-4
        share = new
        if done:
            break
    return share, sum(k * math.log(mix(row, share)) for row, k in zip(p, n))


def proportions(text: str, model: list[list[float]]) -> list[float]:
    """Of each language: EM over all, then without the least ones as long as the penalised likelihood does not fall."""
    found = sorted(Counter(grams(text)).items())
    logs = [[m[b] for m in model] for b, _ in found]
    p, n = [[math.exp(x - max(row)) for x in row] for row in logs], [float(k) for _, k in found]
    penalty = 0.5 * math.log(max(2.0, sum(n) / 3))
    chosen = list(range(len(model)))
    share, like = em(p, n, [1 / len(model)] * len(model))
    while len(chosen) > 1:
        least = [s <= max(min(share), 1e-3) for s in share]
        if all(least):
            least = [k != share.index(max(share)) for k in range(len(share))]
        rest = [c for c, gone in zip(chosen, least) if not gone]
        kept = [s for s, gone in zip(share, least) if not gone]
        part = [[row[c] for c in rest] for row in p]
        new, new_like = em(part, n, [k / sum(kept) for k in kept]) if len(rest) > 1 else ([1.0], sum(k * math.log(row[0]) for row, k in zip(part, n)))
        if (new_like - like) / 3 + penalty * sum(least) < 0:
            break
        chosen, share, like = rest, new, new_like
    return [share[chosen.index(k)] if k in chosen else 0.0 for k in range(len(model))]


def test_mixtures_equal_plain_python(spark):
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in queries.table(spark, SF_SMALL, "documents").where("length(text) < 1500").collect()]
    odd = ["", None, " 12, 3 ", "é", "the and of " * 3 + "der die und nicht " * 3, "Ünïcode", "a"]
    rows += [(10_000 + k, t, None) for k, t in enumerate(odd)] + [(20_000, "whose lang is null", None), (20_001, None, "en"), (20_002, "", "zz")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    langs, model = langid.train(df)
    names, want = learned([(t, lang) for _, t, lang in rows])
    assert langs == names and max(abs(a - b) for k, column in enumerate(want) for a, b in zip(model[:, k], column)) < 1e-9
    got = {r["doc_id"]: r for r in langid.identify(df.drop("lang"), (langs, model)).collect()}
    assert len(got) == len(rows)
    for k, text, _ in rows:
        if not text or not any(map(str.isalpha, text)):
            assert (got[k]["lang_pred"], got[k]["score"], got[k]["langs"]) == ("und", 0.0, [])
            continue
        share = proportions(text, want)
        found = {x["lang"]: x["share"] for x in got[k]["langs"]}
        assert {names[j] for j, s in enumerate(share) if s > 0} == set(found), text
        assert all(found[names[j]] == pytest.approx(s, abs=1e-4) for j, s in enumerate(share) if s > 0)
        assert got[k]["lang_pred"] == max(found, key=lambda x: (found[x], -names.index(x))) and got[k]["score"] == pytest.approx(max(share), abs=1e-4)


def test_ties_and_very_long_texts(spark):
    """Languages that learned the same are equally likely: the first by name; 3 MB of one language are that language."""
    same = [(1, "alpha beta gamma", "b"), (2, "alpha beta gamma", "a")]
    model = langid.train(spark.createDataFrame(same, "doc_id long, text string, lang string"))
    got = langid.identify(spark.createDataFrame([(1, "alpha beta"), (2, "alpha beta")], "doc_id long, text string"), model).collect()
    assert {r["lang_pred"] for r in got} == {"a"} and got[0]["score"] == got[1]["score"]
    model = langid.train(spark.createDataFrame([(1, "the cat and the dog " * 20, "en"), (2, "der hund und die katze " * 20, "de")], "doc_id long, text string, lang string"))
    long = spark.createDataFrame([(1, "the dog and the cat " * 150_000), (2, None)], "doc_id long, text string")
    assert {r["doc_id"]: r["lang_pred"] for r in langid.identify(long, model).collect()} == {1: "en", 2: "und"}


def test_callers_columns_keep_their_names(spark):
    """Columns with the names of helpers come through the functions that return the caller's rows."""
    from halokin.llm import lines, minhash, pii, quality

    docs = queries.table(spark, SF_SMALL, "documents").where("doc_id < 120")
    labels = queries.table(spark, SF_SMALL, "labels")
    extra = ["__rid", "__gone", "__maybe", "__block", "__w0", "__W3", "kept", "rid", "__found", "__marked"]
    more = docs.selectExpr("*", *[f"concat('{c}', doc_id) AS `{c}`" for c in extra])
    key = lambda r: (r["doc_id"], r["text"])
    for f in (lambda d: quality.filter_documents(d, labels), lines.dedup_lines, minhash.one_of_each, lambda d: pii.pseudonymise(d, "k")):
        plain, own = f(docs).collect(), f(more)
        assert set(extra) <= set(own.columns)
        rows = own.collect()
        assert sorted(map(key, rows), key=repr) == sorted(map(key, plain), key=repr)
        assert all(r[c] == f"{c}{r['doc_id']}" for r in rows for c in extra)
    named = docs.withColumnRenamed("doc_id", "kept")
    assert minhash.one_of_each(named, id_col="kept").count() == minhash.one_of_each(docs).count()
