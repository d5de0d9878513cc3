"""Language identification as a mixture (operator 3).

A document is taken as a mixture of languages, each a distribution over hashed byte
trigrams of its letters. Training counts trigrams by language over all documents with
a known language: tasks sum into a table of a fixed number of buckets, and Spark adds
the tables up. For each document, expectation-maximisation estimates the proportions
of the languages; languages are then removed, the least one first, as long as the
penalised likelihood rises (half of log n for each language, with every trigram counted
as a third, as neighbours overlap in two of three bytes). The prediction is the language
with the largest proportion, its score that proportion.

The model has ``BUCKETS`` numbers for each language, whatever the size of the corpus.

Defined results: null text, or text without a letter, is ``und`` with score 0 and no
languages. So is any text if nothing could be learned. Ties go to the language first
in order. Rows are independent, so repeats get equal results. Null languages teach nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textbytes as tb

BUCKETS = 1 << 15
#: Added to every count.
SMOOTHING = 0.1
#: Part of a trigram's probability that any language may have.
FLOOR = 1e-9
OVERLAP = 3
MAX_STEPS = 60

_LETTERS = np.full(256, 0x20, np.uint8)
_LETTERS[0x61:0x7B] = np.arange(0x61, 0x7B)
_LETTERS[0x80:] = np.arange(0x80, 0x100)


def trigrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(buckets of all trigrams, offsets of the texts). Lower-cased; what is not a letter counts as a
    space, and runs of spaces as one."""
    raw = [(b" " + t.lower().encode("utf-8", "replace") + b" ") if t else b"" for t in texts]
    off = np.concatenate(([0], np.cumsum([len(r) for r in raw])))
    b = _LETTERS[np.frombuffer(b"".join(raw), np.uint8)]
    n = len(b)
    if n < 3:
        return np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    keep = np.ones(n, bool)
    keep[1:] = (b[1:] != 0x20) | (b[:-1] != 0x20)
    keep[off[:-1][off[:-1] < n]] = True
    total = np.concatenate(([0], np.cumsum(keep)))
    b, off = b[keep].astype(np.uint32), total[off]
    code = b[:-2] << np.uint32(16) | b[1:-1] << np.uint32(8) | b[2:]
    bucket = ((code * np.uint32(0x9E3779B1)) >> np.uint32(32 - BUCKETS.bit_length() + 1)).astype(np.int64)
    inside = np.ones(n := len(b), bool)  # a trigram starts at each byte but the last two of its text
    ends = off[1:][off[1:] > off[:-1]]
    inside[ends - 1] = False
    inside[np.maximum(ends - 2, 0)] = False
    inside = inside[: n - 2]
    count = np.concatenate(([0], np.cumsum(inside)))
    return bucket[inside], count[np.minimum(off, n - 2)]


def train(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """(languages, log probabilities by bucket and language) from all rows with text and language."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            _, size = tb.utf8(batch.column("text"))
            langs = np.array(batch.column("lang").to_pylist(), object)
            for i, j in tb.pieces(size):
                texts = batch.column("text").slice(i, j - i).to_pylist()
                bucket, off = trigrams(texts)
                owner = np.repeat(langs[i:j], np.diff(off))
                for lang in set(langs[i:j]):
                    total[lang] = total.get(lang, 0) + np.bincount(bucket[owner == lang], minlength=BUCKETS)
        for lang, n in total.items():
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some), pa.string()), pa.array(some), pa.array(n[some])], ["lang", "bucket", "n"])

    some = docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")
    got = some.mapInArrow(run, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(set(got["lang"]))
    counts = np.full((BUCKETS, len(langs)), SMOOTHING)
    counts[got["bucket"].to_numpy(np.int64), np.searchsorted(np.array(langs, object), got["lang"].to_numpy(object)) if langs else []] += got["n"].to_numpy(float)
    return langs, np.log(counts / counts.sum(0) + FLOOR) if langs else np.zeros((BUCKETS, 0))


def _em(p: np.ndarray, n: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, float]:
    """(proportions, log likelihood) of the columns of ``p`` with trigram counts ``n``, from start ``share``."""
    total = n.sum()
    for _ in range(MAX_STEPS):
        mixed = p @ share
        new = share * (p.T @ (n / mixed)) / total
        done = np.abs(new - share).max() < 1e-4
        share = new
        if done:
            break
    return share, float(n @ np.log(p @ share))


def mixture(bucket: np.ndarray, log_p: np.ndarray) -> np.ndarray:
    """Proportion of each language in a text with these trigrams; 0 for languages left out."""
    which, n = np.unique(bucket, return_counts=True)
    logs = log_p[which]
    top = logs.max(1)
    p, n = np.exp(logs - top[:, None]), n.astype(float)  # the likelihood is relative to each trigram's best language
    penalty = 0.5 * np.log(max(2.0, n.sum() / OVERLAP))
    chosen = np.arange(log_p.shape[1])
    share = np.full(len(chosen), 1 / len(chosen))
    share, like = _em(p, n, share)
    while len(chosen) > 1:
        # languages with next to no part go at once; the likelihood of the rest is found anew
        least = share <= max(share.min(), 1e-3)
        least = least if not least.all() else np.arange(len(share)) != share.argmax()
        rest, kept = chosen[~least], share[~least]
        new, new_like = _em(p[:, rest], n, kept / kept.sum()) if len(rest) > 1 else (np.ones(1), float(n @ np.log(p[:, rest[0]])))
        if (new_like - like) / OVERLAP + penalty * least.sum() < 0:
            break
        chosen, share, like = rest, new, new_like
    out = np.zeros(log_p.shape[1])
    out[chosen] = share
    return out


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray], *, text_col: str = "text") -> DataFrame:
    """``docs`` (text column left out) with lang_pred, score and langs (array of (lang, share), largest
    share first). Columns of these names are replaced."""
    langs, log_p = model
    log_p = log_p.astype(np.float32)
    added = ("lang_pred", "score", "langs")
    kept = [f for f in docs.schema if f.name not in (*added, text_col)]
    names = [f.name for f in kept]
    kind = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))

    def one(text: str | None, bucket: np.ndarray, logs: np.ndarray) -> tuple[str, float, list]:
        if not langs or not len(bucket) or not any(map(str.isalpha, text)):
            return "und", 0.0, []
        share = mixture(bucket, logs)
        order = np.argsort(-share, kind="stable")
        return langs[order[0]], float(min(1.0, share[order[0]])), [{"lang": langs[k], "share": float(share[k])} for k in order if share[k] > 0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs = log_p.astype(np.float64)
        for batch in batches:
            _, size = tb.utf8(batch.column("__text"))
            for i, j in tb.pieces(size):
                texts = batch.column("__text").slice(i, j - i).to_pylist()
                bucket, off = trigrams(texts)
                said = [one(t, bucket[a:b], logs) for t, a, b in zip(texts, off.tolist(), off[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(i, j - i) for c in names] + [pa.array([s[0] for s in said], pa.string()),
                     pa.array([s[1] for s in said], pa.float64()), pa.array([s[2] for s in said], kind)], names + list(added))

    schema = T.StructType(kept + [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField(
        "langs", T.ArrayType(T.StructType([T.StructField("lang", T.StringType()), T.StructField("share", T.DoubleType())])))])
    return docs.select(*names, F.col(text_col).alias("__text")).mapInArrow(run, schema)


def held_out(doc_id: str | Column) -> Column:
    """True for the fifth of the documents that never teaches: crc32 of the id's text divisible by 5."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id) % 5 == 0, F.lit(False))
