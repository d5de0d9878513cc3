"""What operators 4 and 12 take of time and memory."""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F

from halokin.llm import alignment, lines
from halokin.llm import textbytes as tb

BPE, MODEL = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def test_lines_are_cut_into_words_once_and_without_a_lambda(spark):
    docs = spark.createDataFrame([(1, 1, "A b\tc\n \x0b\r\n\nd")], "rid long, doc long, text string")
    occ = lines._occurrences(docs, 2)
    plan = occ._jdf.queryExecution().optimizedPlan().toString()
    assert "transform(" not in plan and plan.count("lower(") == 1
    assert [(r["line"], r["n"]) for r in occ.orderBy("line").collect()] == [(0, 3), (3, 1)]
    words = F.array(F.lit("a"), F.lit("b"), F.lit("c"))
    assert occ.where((F.col("line") == 0) & (F.col("h1") == F.xxhash64(words))).count() == 1


def test_a_chunk_is_encoded_by_pieces(monkeypatch):
    monkeypatch.setattr(tb, "PIECE", 10)
    monkeypatch.setattr(tb.pieces, "__defaults__", (10,))
    seen = []

    def encode(data, off):
        seen.append(len(data))
        return data.astype(np.uint32), np.diff(off)

    texts = pa.array(["abcd", None, "", "efghij", "k" * 25, "lm"], pa.large_string())
    got = alignment._encoded_lists(encode, texts)
    assert seen == [10, 25, 2]
    assert [bytes(x).decode() for x in got.to_pylist()] == ["abcd", "", "", "efghij", "k" * 25, "lm"]
    assert alignment._encoded_lists(encode, pa.array([], pa.large_string())).to_pylist() == []


def test_a_chunk_is_aligned_in_steps(monkeypatch):
    aligner = alignment.Aligner(BPE, MODEL)
    words = "the cat sat on the mat and the cat ran été ▁ x".split(" ")
    texts = pa.array([" ".join(words[i % 5: 4 + i % 9]) if i % 7 else None for i in range(60)] + ["", "the cat " * 40], pa.string())
    whole = alignment._chunk(aligner, texts)
    steps = []
    real = aligner.align
    monkeypatch.setattr(alignment, "STEP", 100)
    monkeypatch.setattr(aligner, "align", lambda text: steps.append(len(text)) or real(text))
    cut = alignment._chunk(aligner, texts)
    assert len(steps) > 5 and sum(steps) == len(texts)
    for c in whole[0]:
        assert whole[0][c].to_pylist() == cut[0][c].to_pylist()
    assert whole[3].tolist() == cut[3].tolist()

    def linked(found):
        pairs = found[1].to_pydict()
        return [(pairs["a"][k], pairs["b"][k], pairs["count_all"][k]) for k in found[2].tolist()]

    assert linked(whole) == linked(cut) and len(whole[1]) == len(cut[1])


def test_lines_with_a_word_are_counted_without_a_lambda(spark):
    texts = [None, "", "\n\n", "a", "a\n", " \t\nx y\n\n \x0b\x0c\r\nz", "\r\n", "\u00a0\n\u2028 b\r\nc", "\x85\n\x1c"]
    got = lines.dedup_lines(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    plan = got.select("n_lines")._jdf.queryExecution().optimizedPlan().toString()
    assert "rlike" not in plan.lower()
    want = [sum(any(c not in " \t\n\x0b\x0c\r" for c in x) for x in (t or "").split("\n")) for t in texts]
    assert [r["n_lines"] for r in got.orderBy("doc_id").collect()] == want


def test_variants_are_counted_by_one_hash(spark, monkeypatch):
    made = {}
    real = lines.materialize
    monkeypatch.setattr(lines, "materialize", lambda df, tag: made.setdefault(tag, real(df, tag)))
    near = "one two three four five six seven eight nine"
    texts = [near, near.replace("five", "FOUR"), near + " ten", "one two three four five other words end this line", near]
    got = lines.dedup_lines(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert made["line-variants"].columns == ["v1"]
    assert [(r["n_exact"], r["n_near"]) for r in got.orderBy("doc_id").collect()] == [(0, 0), (0, 1), (0, 1), (0, 0), (1, 0)]


def test_slices_hold_no_batch_while_the_next_is_read():
    held = []

    def batches():
        before = pa.total_allocated_bytes()
        for _ in range(3):
            held.append(pa.total_allocated_bytes() - before)
            yield pa.RecordBatch.from_pydict({"text": ["x" * 1000] * 1000 + [None, ""]})

    rows = []
    for own in tb.slices(batches(), "text", 300_000):
        rows.append(own.num_rows)
        del own
    assert sum(rows) == 3006 and len(rows) == 12 and max(held) < 100_000
