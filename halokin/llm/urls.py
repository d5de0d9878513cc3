"""URL filter (operator 7): path rules first, then a listed-URL check.

The listed canonical URLs are folded into a blocked Bloom filter (``bloom``). The
filter has a fixed upper size, so it is broadcast; only pages that it lets through ("possible
hits") reach the exact hash join with the list, which removes false positives.
A longer list than the filter is sized for only means more possible hits, never a
wrong verdict. DataFrame functions only.

Defined results: a null URL, or one without ``://``, has empty host and path, no
rule, no canonical URL, and is allowed. Repeated rows are judged alike, each on its
own. An empty list or page table gives no blocked or no rows. Only the two named
columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import string
from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import bloom


class UrlRule(NamedTuple):
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


def split_url(url: Column) -> tuple[Column, Column, Column]:
    """(host, path, query) of a URL column; empty strings where there is none."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), string.ascii_uppercase, string.ascii_lowercase)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    query = F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1)
    return host, path, query


def canonical(host: Column, path: Column, query: Column) -> Column:
    """Host without a leading ``www.``, path without trailing slashes, and the query
    without ``utm_`` parameters; null where the host is empty."""
    params = F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.startswith("utm_"))
    tail = F.when(F.size(params) > 0, F.concat(F.lit("?"), F.array_join(params, "&"))).otherwise("")
    url = F.concat(F.regexp_replace(host, r"^www\.", ""), F.regexp_replace(path, "/+$", ""), tail)
    return F.when(host != "", url)


def rule_columns(host: Column, path: Column, rules: Iterable[UrlRule]) -> tuple[Column, Column]:
    """(rule text, its verdict) of the longest fitting rule; null without one."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), len(r.host), r.text)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        text = F.when(fits, F.lit(r.text)).otherwise(text)
        verdict = F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return text, verdict


def filter_urls(pages: DataFrame, listed: DataFrame, rules: Iterable[UrlRule], *, id_col: str = "page_id",
                url_col: str = "url", max_blocks: int = bloom.MAX_BLOCKS) -> DataFrame:
    """Judge every page.

    ``listed`` has one string column ``canonical`` (repeats and nulls are ignored).
    Returns page id, host, path, rule, verdict (``allow`` / ``block``), canonical.
    """
    host, path, query = split_url(F.col(url_col))
    urls = pages.select(F.col(id_col), host.alias("host"), path.alias("path"), query.alias("query"))
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    judged = urls.select(id_col, "host", "path", rule.alias("rule"), verdict.alias("by_rule"),
                         canonical(F.col("host"), F.col("path"), F.col("query")).alias("canonical"))

    keys = materialize(listed.select("canonical").where(F.col("canonical").isNotNull()).distinct(), "url-list")
    listing = bloom.Bloom(keys, "canonical", keys.count(), max_blocks)
    probed = listing.mark(judged, "canonical", "listed").withColumn("possible", F.col("listed") & F.col("by_rule").isNull())

    out = [F.col(id_col), "host", "path", "rule"]
    passed = probed.where(~F.col("possible")).select(
        *out, F.coalesce("by_rule", F.lit("allow")).alias("verdict"), "canonical")
    exact = probed.where(F.col("possible")).join(keys.withColumn("found", F.lit(True)), "canonical", "left")
    return passed.unionByName(exact.select(
        *out, F.when(F.col("found"), "block").otherwise("allow").alias("verdict"), "canonical"))
