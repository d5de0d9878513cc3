"""Quality rules (operator 1): a learned decision list over text statistics.

1. ``text_stats`` computes the statistics of every whole text with SQL functions.
2. ``learn_rules`` runs sequential covering on the labelled rows. A rule grows one
   threshold condition at a time, by the largest information gain on two thirds of
   the rows; it is then pruned to the prefix that does best on the other third, and
   stays if that third confirms it. The rows that it covers go, and the next rule
   grows. Every step is one Spark aggregation whose result has a fixed number of
   rows (statistics x thresholds), whatever the number of labels.
3. ``apply_rules`` turns the ordered list into one CASE expression.

Defined results: null or empty text has zero words and fails the base rule. Rows are
judged one by one, so repeated rows and equal ids each get their verdict. Without
labels no rule is learned and the base rule alone decides. Labels that are null, or
whose document is missing, teach nothing. Input columns other than the named ones
are not read.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .bloom import drop_keys
from .names import BLOOM, set_aside

SPACE = r"[\x20\x09-\x0D]+"
#: Statistics that conditions may test; each is a ratio, so that it means the same for any length of text.
FEATURES = ("mean_word_len", "symbol_ratio", "dup_line_ratio", "repeat_ratio", "upper_ratio", "bang_ratio", "digit_ratio",
            "words_per_line")
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


class Condition(NamedTuple):
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        c = F.col(self.feature)
        return c > F.lit(self.threshold) if self.above else c <= F.lit(self.threshold)


class LearnedRule(NamedTuple):
    """Reject what fulfils all conditions; rejected and kept labelled rows that confirmed it."""
    conditions: tuple[Condition, ...]
    bad: int
    good: int

    def column(self) -> Column:
        out = self.conditions[0].column()
        for c in self.conditions[1:]:
            out = out & c.column()
        return out


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeat_words(words: Column) -> Column:
    """Words that lie in a 3-word window found at least twice in the text.

    Windows are compared by 64-bit hash. Texts without a repeated window, nearly all,
    stop at the count of distinct hashes; the others sort (hash, position) pairs."""
    hashes = F.when(F.size(words) >= 3, F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
    )).otherwise(F.array().cast("array<bigint>"))

    def covered(p: Column) -> Column:
        return F.aggregate(F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3)))),
                           F.lit(0), lambda a, x: a + x)

    def repeated(s: Column) -> Column:
        at = F.filter(s, lambda x, k: F.coalesce(x["h"] == F.get(s, k - 1)["h"], F.lit(False))
                      | F.coalesce(x["h"] == F.get(s, k + 1)["h"], F.lit(False)))
        return _let(F.sort_array(F.transform(at, lambda x: x["i"])), covered)

    return _let(hashes, lambda hs: F.when(F.size(F.array_distinct(hs)) == F.size(hs), F.lit(0)).otherwise(
        _let(F.sort_array(F.transform(hs, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), repeated))).cast("long")


def text_stats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: the id, the carried columns, the five base counts, ``base_failed`` and FEATURES."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    left = lambda pattern: F.length(F.regexp_replace(F.col("text"), pattern, ""))
    split = docs.select(id_col, *carry, text.alias("text")).select(
        id_col, *carry, "text",
        F.array_remove(F.split("text", SPACE), "").alias("words"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    counts = split.select(
        id_col, *carry,
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length("text") - left(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("words")).alias("n_repeat_words"),
        F.size("lines").alias("n_lines"),
        left(r"[^A-ZÀ-ÖØ-Þ]+").alias("n_upper"),
        (F.length("text") - F.length(F.replace(F.col("text"), F.lit("!"), F.lit("")))).alias("n_bang"),
        left(r"[^0-9]+").alias("n_digits"),
    )
    ratio = lambda a, b: F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b).cast("double")), F.lit(0.0))
    return counts.select(
        id_col, *carry, *BASE,
        ((F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))).alias("base_failed"),
        ratio("word_chars", "n_words").alias("mean_word_len"), ratio("n_symbols", "word_chars").alias("symbol_ratio"),
        ratio("n_dup_lines", "n_lines").alias("dup_line_ratio"), ratio("n_repeat_words", "n_words").alias("repeat_ratio"),
        ratio("n_upper", "word_chars").alias("upper_ratio"), ratio("n_bang", "n_words").alias("bang_ratio"),
        ratio("n_digits", "word_chars").alias("digit_ratio"), ratio("n_words", "n_lines").alias("words_per_line"),
    )


def _gain(p: float, n: float, p0: float, n0: float) -> float:
    """FOIL gain of going from p0 / n0 covered bad and good rows to p / n."""
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p else 0.0


def _thresholds(rows: DataFrame, n: int) -> dict[str, list[float]]:
    """Midpoints between neighbouring distinct quantiles, so that a cut leaves a margin on both sides."""
    at = [i / (n + 1) for i in range(n + 2)]
    row = rows.agg(*[F.percentile_approx(f, at, 10000).alias(f) for f in FEATURES]).first()
    values = {f: sorted(set(row[f] or ())) for f in FEATURES}
    return {f: [(a + b) / 2 for a, b in zip(v, v[1:])] for f, v in values.items()}


def _bin(value: Column, cuts: list[float]) -> Column:
    """How many of the thresholds ``value`` is above."""
    return F.size(F.filter(F.lit([float(t) for t in cuts]) if cuts else F.array().cast("array<double>"), lambda t: t < value))


def _grow(rows: DataFrame, cuts: dict[str, list[float]], max_conditions: int) -> tuple[Condition, ...]:
    """Conditions in the order of their gain on ``rows`` (columns FEATURES and bad 0/1)."""
    rule: tuple[Condition, ...] = ()
    while len(rule) < max_conditions:
        covered = rows.where(LearnedRule(rule, 0, 0).column()) if rule else rows
        bins = F.array(*[F.struct(F.lit(f).alias("f"), _bin(F.col(f), cuts[f]).alias("b")) for f in FEATURES])
        got = (covered.select(F.explode(bins).alias("x"), "bad").groupBy("x.f", "x.b")
               .agg(F.sum("bad").alias("p"), F.sum(1 - F.col("bad")).alias("n")).collect())
        by = {f: {r["b"]: (r["p"], r["n"]) for r in got if r["f"] == f} for f in FEATURES}
        p0, n0 = (sum(x[i] for x in by[FEATURES[0]].values()) for i in (0, 1))
        if not p0 or not n0:
            break
        best = (0.0, None)
        for f in FEATURES:
            p = n = 0
            for i, t in enumerate(cuts[f]):
                dp, dn = by[f].get(i, (0, 0))  # bin i: above i thresholds, so at most threshold i
                p, n = p + dp, n + dn
                best = max(best, (_gain(p, n, p0, n0), Condition(f, False, float(t))),
                           (_gain(p0 - p, n0 - n, p0, n0), Condition(f, True, float(t))), key=lambda x: x[0])
        if best[1] is None or best[0] <= 1e-9:
            break
        rule += (best[1],)
    return rule


def _prune(rows: DataFrame, rule: tuple[Condition, ...]) -> LearnedRule | None:
    """The prefix with the best (bad - good) / (bad + good) on the held-out rows; the shorter one in a tie."""
    prefixes = [LearnedRule(rule[: i + 1], 0, 0) for i in range(len(rule))]
    sums = [F.sum(F.when(r.column(), x).otherwise(0)) for r in prefixes for x in (F.col("bad"), 1 - F.col("bad"))]
    got = [x or 0 for x in rows.agg(*[s.alias(f"s{i}") for i, s in enumerate(sums)]).first()]
    scored = [LearnedRule(r.conditions, got[2 * i], got[2 * i + 1]) for i, r in enumerate(prefixes)]
    return max(scored, key=lambda r: ((r.bad - r.good) / max(1, r.bad + r.good), -len(r.conditions)), default=None)


def learn_rules(stats: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", label_col: str = "quality", n_thresholds: int = 40,
                max_conditions: int = 3, max_rules: int = 12, min_precision: float = 0.9, min_support: int = 3) -> list[LearnedRule]:
    """Ordered rules that reject; learned from all labelled rows that pass the base rule.

    A rule stays if at least ``min_support`` held-out rows fulfil it and a share of
    ``min_precision`` of them is labelled bad (0)."""
    known = labels.select(F.col(id_col), F.col(label_col).alias("label")).where(F.col("label").isin(0, 1))
    rows = materialize(stats.where(~F.col("base_failed")).join(known, id_col).select(
        *FEATURES, (1 - F.col("label")).cast("long").alias("bad"),
        (F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(3)) == 0).alias("held")), "quality-train")
    cuts = _thresholds(rows, n_thresholds)
    rules: list[LearnedRule] = []
    rest = rows
    while len(rules) < max_rules:
        grown = _grow(rest.where(~F.col("held")), cuts, max_conditions)
        rule = _prune(rest.where("held"), grown) if grown else None
        if rule is None or rule.bad < min_support or rule.bad < min_precision * (rule.bad + rule.good):
            break
        rules.append(rule)
        rest = rest.where(~rule.column())
    return rules


def apply_rules(stats: DataFrame, rules: list[LearnedRule]) -> DataFrame:
    """``stats`` with ``rule`` (number of the first rule that rejects, else null) and ``kept``."""
    first = F.lit(None).cast("int")
    for i, r in reversed(list(enumerate(rules))):
        first = F.when(r.column(), F.lit(i)).otherwise(first)
    return stats.withColumn("rule", first).withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def quality_verdicts(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **learn) -> DataFrame:
    """Learn from the labelled documents, judge all: id, BASE, base_failed, FEATURES, rule, kept."""
    stats = materialize(text_stats(docs, id_col=id_col, text_col=text_col), "quality-stats")
    return apply_rules(stats, learn_rules(stats, labels, id_col=id_col, **learn))


@set_aside("__rid", *BLOOM)
def filter_documents(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **learn) -> DataFrame:
    """The rows of ``docs`` that the rules keep. Texts are shuffled only where a row goes."""
    rows = docs.withColumn("__rid", F.xxhash64(id_col, text_col))
    stats = materialize(text_stats(rows, id_col=id_col, text_col=text_col, carry=("__rid",)), "quality-stats")
    judged = apply_rules(stats, learn_rules(stats, labels, id_col=id_col, **learn))
    gone = materialize(judged.where("NOT kept").select("__rid").distinct(), "quality-gone")
    return drop_keys(rows, "__rid", gone).drop("__rid")
