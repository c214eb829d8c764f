"""URL filter: a weighted vocabulary counted by an Aho-Corasick automaton, under host and path rules.

A term counts where neither neighbour is a letter or digit of ASCII, so ``win`` does not count in
``windows`` but does in ``casino-win``. One strict term rejects a URL; so do ``SOFT_HITS`` different
soft terms, however often each occurs. A rule that fits the URL decides before the vocabulary does.
"""
from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_columns, free_name, strings

STRICT = ("adult", "camgirls", "casino", "escort", "hentai", "malware", "phishing", "porn", "spam",
          "viagra", "warez", "xxx")
SOFT = ("ads", "bet", "bets", "bonus", "cheap", "clickbait", "coupon", "crack", "dating", "farm", "free",
        "gambling", "keygen", "loan", "loans", "lottery", "pills", "poker", "sex", "slots", "torrent",
        "track", "win")
SOFT_HITS = 2


@dataclass(frozen=True)
class Rule:
    """Allows or blocks a host and its subdomains below a path."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (Rule("com", "/", "allow"), Rule("example.com", "/en/", "block"), Rule("www.example.com", "/en/", "allow"),
         Rule("net", "/es/", "block"), Rule("net", "/fr/", "block"))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lowered; else empty."""
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Name of the longest rule that fits; null if none does."""
    fits = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):      # the last that fits wins
        fits = F.when(((host == rule.host) | F.endswith(host, F.lit("." + rule.host)))
                      & F.startswith(path, F.lit(rule.path)), F.lit(rule.name)).otherwise(fits)
    return fits


def scanner(strict: tuple[str, ...] = STRICT, soft: tuple[str, ...] = SOFT):
    """A function from a URL to its numbers of different strict and soft terms."""
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for term in {*strict, *soft}:
        automaton.add_word(term, term)
    automaton.make_automaton()
    hard, mild = frozenset(strict), frozenset(soft)
    word = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")
    low = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}

    def scan(url: str) -> tuple[int, int]:
        url = url.translate(low)
        found = set()
        for end, term in automaton.iter(url):
            before, after = url[end - len(term):end - len(term) + 1], url[end + 1:end + 2]
            if (end < len(term) or before not in word) and after not in word:
                found.add(term)
        return len(found & hard), len(found & mild)
    return scan


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: tuple[Rule, ...] = RULES,
               strict: tuple[str, ...] = STRICT, soft: tuple[str, ...] = SOFT, soft_hits: int = SOFT_HITS) -> DataFrame:
    """(page_id, url, host, path, rule, strict_hits, soft_hits, verdict) of each row.

    A null URL, or one without ``://``, has an empty host and path and fits no rule; the vocabulary
    still judges what text there is (null: none, so allowed). Repeated rows come back as often, null
    ids stay null, an empty table gives none; other columns are not looked at.
    """
    urls = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"))

    def setup():
        scan = scanner(strict, soft)

        def compute(part: pa.RecordBatch) -> list[pa.Array]:
            hits = [scan(u) for u in strings(part.column("url"))]
            return [pa.array([h[i] for h in hits], pa.int32()) for i in range(2)]
        return compute

    fields = [T.StructField("strict_hits", T.IntegerType()), T.StructField("soft_hits", T.IntegerType())]
    seen = add_columns(urls, setup, fields, text_col="url")
    seen = seen.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    seen = seen.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    decided = {r.name: r.verdict for r in rules}
    by_terms = F.when((F.col("strict_hits") >= 1) | (F.col("soft_hits") >= soft_hits), "block").otherwise("allow")
    verdict = F.when(F.col("rule").isNull(), by_terms)
    for name, v in decided.items():
        verdict = verdict.when(F.col("rule") == name, F.lit(v))
    return seen.withColumn("verdict", verdict).select(
        "page_id", "url", "host", "path", "rule", "strict_hits", "soft_hits", "verdict")


def keep_allowed(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", **how) -> DataFrame:
    """The rows of ``pages`` whose URL is allowed, with all their columns."""
    mark, url = free_name(pages, "verdict"), free_name(pages, "judged_url")
    allowed = (judge_urls(pages.select(id_col, url_col).distinct(), id_col, url_col, **how).filter("verdict = 'allow'")
               .select(F.col("url").alias(url), F.lit(True).alias(mark)).distinct())
    return pages.join(allowed, pages[url_col].eqNullSafe(allowed[url]), "left_semi")
