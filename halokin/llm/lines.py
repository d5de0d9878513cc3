"""Line deduplication by deletion neighbourhoods (operator 4).

A line is the sequence of its words (lower-cased; white space only separates). A line
is removed if an earlier line of the corpus, in the order of document id and line, has
the same words, or, if both have at least ``MIN_WORDS`` words, words at an edit distance
of one: one word inserted, deleted or replaced. Lines without a word stay.

1. Each line's words become hashes; equal lines are counted and their earliest found by
   aggregation, so a line that fills a third of the corpus costs its partial sums.
2. Deletion variants (the line without its i-th word, for every i, and the whole line)
   are emitted only for lines that can have a neighbour: as one edit leaves the first or the
   second half as it is, such a line shares the hash of a half with another. This
   condition is exact. Equal variants meet by hash.
3. Lines that meet in a variant at the same place differ in at most that word, and a
   whole line that meets a variant lacks one word. So each line's earliest neighbour is
   a minimum over its groups: no pairs are made. The edit distance to it is then verified
   on the words themselves.
4. Texts are joined only where a line goes; others pass through unshuffled. Blocked
   Bloom filters of bounded size choose what is shuffled; exact joins decide.

All of it is SQL functions. The work for a line's variants grows with the square of its
words.

Defined results: null text stays null. A text without words stays as it is. Rows that
repeat a document (same id and text) are one document and get the same text; other rows of
equal id are ordered by a hash of the text; null ids come last. An empty table gives no rows.
Other columns pass through; columns with the names of the added ones are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .bloom import Bloom
from .names import BLOOM, set_aside

MIN_WORDS = 8
SPACE = r"[\x20\x09-\x0D]+"
LAST = (1 << 63) - 1
KEYS = ("k0", "k1", "k2", "k3")


def line_words(line: Column) -> Column:
    return F.array_remove(F.split(F.lower(line), SPACE), "")


def _half_keys(words: Column, n: Column) -> list[Column]:
    """Hashes of the halves by which a line of n words meets one of n - 1, n or n + 1 words."""
    out = []
    for s in (n, n - 1):  # the smaller number of words of a pair
        head = F.floor(s / 2).cast("int")
        out += [F.xxhash64(F.lit("head"), F.slice(words, F.lit(1), head)),
                F.xxhash64(F.lit("tail"), F.slice(words, n - (s - head) + 1, s - head))]
    return out


def _occurrences(docs: DataFrame, min_words: int) -> DataFrame:
    """(rid, doc, line, n, h1, h2, k0..k3) of every line with a word."""
    lines = docs.select("rid", "doc", F.posexplode(F.split("text", "\n")).alias("line", "t"))
    # by a character of a word, not by the number of words: Spark filters first, and would cut each line into words twice.
    # Words are hashed as they are; a lambda that turns them into numbers would keep the projection from being compiled
    words = lines.where(F.col("t").rlike(r"[^\x20\x09-\x0D]")).select("rid", "doc", "line", line_words(F.col("t")).alias("w"))
    hashed = words.select("rid", "doc", "line", F.size("w").alias("n"), "w")
    keys = [F.when(F.col("n") >= min_words, k).alias(c) for c, k in zip(KEYS, _half_keys(F.col("w"), F.col("n")))]
    return hashed.select("rid", "doc", "line", "n", F.xxhash64("w").alias("h1"), F.xxhash64(F.lit("2"), "w").alias("h2"), *keys)


def _neighbourly(lines: DataFrame) -> DataFrame:
    """(h1, h2, first) of the lines that share the hash of a half with another line."""
    keys = lines.where(F.col(KEYS[0]).isNotNull()).select("h1", "h2", "first", F.explode(F.array_distinct(F.array(*KEYS))).alias("key"))
    shared = materialize(keys.groupBy("key").count().where("count > 1").select("key"), "line-keys")
    meet = Bloom(shared, "key", shared.count()).keep(keys, "key").join(shared, "key")
    return materialize(meet.select("h1", "h2", "first").distinct(), "line-candidates")


def _variants(lines: DataFrame) -> DataFrame:
    """(v1, v2, at, h1, h2, first) of every deletion variant; at is -1 for the whole line."""
    hashed = lines.select("h1", "h2", "first", F.transform("words", lambda x: F.xxhash64(x)).alias("w"))
    each = hashed.select("h1", "h2", "first", "w", F.explode(F.sequence(F.lit(-1), F.size("w") - 1)).alias("at"))
    rest = F.when(F.col("at") < 0, F.col("w")).otherwise(_without(F.col("w"), F.col("at")))
    return each.select("h1", "h2", "first", "at", rest.alias("rest")).select(
        F.xxhash64("rest").alias("v1"), F.xxhash64(F.lit("2"), "rest").alias("v2"), "at", "h1", "h2", "first")


def _without(words: Column, at: Column) -> Column:
    return F.when(at < 0, words).otherwise(
        F.concat(F.slice(words, F.lit(1), F.greatest(at, F.lit(0))), F.slice(words, F.greatest(at, F.lit(0)) + 2, F.size(words))))


def _near(candidates: DataFrame) -> DataFrame:
    """(h1, h2) of the lines with an earlier line at distance one. ``candidates``: h1, h2, first, words."""
    variants = _variants(candidates)
    # by one hash: the other is only computed of what is left; a variant that has no equal in both is alone in the groups below
    shared = materialize(variants.groupBy("v1").count().where("count > 1").select("v1"), "line-variants")
    met = materialize(Bloom(shared, "v1", shared.count()).keep(variants, "v1").join(shared, "v1"), "line-met")
    own = F.struct("first", "h1", "h2", "at")
    lowest = met.groupBy("v1", "v2", "at").agg(F.min(own).alias("low"))
    # for a deletion: the earliest with the same place, or the whole line; for a whole line: the earliest deletion
    whole = lowest.where("at < 0").select("v1", "v2", F.col("low").alias("whole"))
    cut = lowest.where("at >= 0").groupBy("v1", "v2").agg(F.min("low").alias("low"))
    deletion = lowest.where("at >= 0").join(whole, ["v1", "v2"], "left").select("v1", "v2", "at", F.least("low", "whole").alias("best"))
    entire = whole.join(cut, ["v1", "v2"]).select("v1", "v2", F.lit(-1).alias("at"), F.col("low").alias("best"))
    earlier = met.join(deletion.union(entire), ["v1", "v2", "at"]).where(F.col("best.first") < F.col("first"))
    pairs = earlier.groupBy("h1", "h2").agg(F.min(F.struct("best", "at")).alias("x")).select(
        "h1", "h2", F.col("x.at").alias("at"), F.col("x.best.h1").alias("g1"), F.col("x.best.h2").alias("g2"), F.col("x.best.at").alias("to"))
    words = candidates.select("h1", "h2", "words")
    both = pairs.join(words, ["h1", "h2"]).join(words.select(
        F.col("h1").alias("g1"), F.col("h2").alias("g2"), F.col("words").alias("other")), ["g1", "g2"])
    same_place = (F.col("at") == F.col("to")) | (F.col("at") < 0) | (F.col("to") < 0)
    return both.where(same_place & (_without(F.col("words"), F.col("at")) == _without(F.col("other"), F.col("to")))).select("h1", "h2")


@set_aside("__rid", "__gone", *BLOOM)
def dedup_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the lines removed from the text, and n_lines (with a word), n_exact, n_near (removed as equal to, or
    one edit from, an earlier line; both counts as exact)."""
    added = ("n_lines", "n_exact", "n_near")
    rows = docs.drop(*[c for c in added if c in docs.columns]).withColumn("__rid", F.xxhash64(id_col, text_col))
    slim = rows.where(F.col(text_col).isNotNull()).select(
        F.col("__rid").alias("rid"), F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("doc"), F.col(text_col).alias("text"))

    occ = materialize(_occurrences(slim, min_words), "line-occurrences")
    place = F.struct("doc", "rid", "line")
    lines = materialize(occ.groupBy("h1", "h2").agg(
        F.min(place).alias("first"), F.count("*").alias("c"), *[F.min(k).alias(k) for k in KEYS]), "line-distinct")

    chosen = _neighbourly(lines)
    wanted = materialize(chosen.groupBy(F.col("first.rid").alias("rid")).agg(
        F.collect_list(F.struct(F.col("first.line").alias("line"), "h1", "h2", "first")).alias("at")), "line-wanted")
    texts = Bloom(wanted, "rid", wanted.count()).keep(slim.select("rid", "text"), "rid").join(wanted, "rid")
    found = texts.select(F.split("text", "\n").alias("t"), F.explode("at").alias("x")).select(
        "x.h1", "x.h2", "x.first", line_words(F.get("t", F.col("x.line"))).alias("words"))
    candidates = materialize(found.dropDuplicates(["h1", "h2"]), "line-texts")
    near = materialize(_near(candidates).withColumn("near", F.lit(True)), "line-near")

    gone = materialize(lines.select("h1", "h2", "first", "c").join(near, ["h1", "h2"], "left").where("c > 1 OR near"), "line-gone")
    hits = Bloom(gone, "h1", gone.count()).keep(occ.select("rid", "doc", "line", "h1", "h2"), "h1").join(gone, ["h1", "h2"])
    exact = F.col("first") != place
    removed = materialize(hits.select("rid", "line", exact.alias("exact"), F.col("near")).where("exact OR near").distinct()
                          .groupBy("rid").agg(F.collect_list("line").alias("__gone"), F.count_if("exact").alias("n_exact"),
                                              F.count_if(~F.col("exact")).alias("n_near")), "line-removed")

    some, none = Bloom(removed, "rid", removed.count()).split(rows, "__rid")
    some = some.join(removed.withColumnRenamed("rid", "__rid"), "__rid", "left")
    none = none.withColumns({"__gone": F.lit(None).cast("array<int>"), "n_exact": F.lit(0).cast("long"), "n_near": F.lit(0).cast("long")})
    out = some.unionByName(none)
    kept = F.array_join(F.filter(F.split(text_col, "\n"), lambda x, i: ~F.array_contains("__gone", i)), "\n")
    # a match goes from the first character of a word to the end of its line; a lambda over the lines would be interpreted
    n_lines = F.regexp_count(F.coalesce(text_col, F.lit("")), F.lit(r"[^\x20\x09-\x0D][^\n]*")).cast("long")
    return out.withColumns({
        "n_lines": n_lines, "n_exact": F.coalesce("n_exact", F.lit(0)), "n_near": F.coalesce("n_near", F.lit(0)),
        text_col: F.when(F.col("__gone").isNull(), F.col(text_col)).otherwise(kept)}).drop("__rid", "__gone")
