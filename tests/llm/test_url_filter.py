import re

import pytest

from tests.oracle_util import duck
from vitrine.llm import queries, url_filter as u

URLS = [None, "", "no scheme casino", "http://EXAMPLE.com/en/x", "http://www.example.com/en/x", "http://a.www.example.com/en/",
        "http://notexample.com/en/", "https://x.net/es/1", "https://x.net/fr?x", "https://x.net/fr/#a", "net://net/es/",
        "http://a.org/free-bets", "http://a.org/free/free", "http://a.org/windows", "http://a.org/win?bets", "http://casino.org",
        "http://mycasino.org", "http://CASINO-x.org", "http://user@com:80/p://q", "://com/", "http://com", "http://com?/x", "http://ÄCOM.com/É",
        "http://a.org/\nxxx", "http://a\nb.com/c", "http://a.org/ads_track", "x://y://z.com/a", "http://a.org/bet bets", "http://é.org/ébet-ads"]


def slow(url):
    text = url or ""
    host = path = ""
    if "://" in text:
        rest = text[text.index("://") + 3:]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in u.RULES if ("." + host).endswith("." + r.host) and path.startswith(r.path)]
    rule = max(fits, key=lambda r: len(r.name), default=None)
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)

    def has(term):
        return any((i == 0 or low[i - 1] not in "abcdefghijklmnopqrstuvwxyz0123456789")
                   and low[i + len(term):i + len(term) + 1] not in set("abcdefghijklmnopqrstuvwxyz0123456789")
                   for i in range(len(low)) if low.startswith(term, i))
    hard, mild = sum(map(has, u.STRICT)), sum(map(has, u.SOFT))
    verdict = rule.verdict if rule else "block" if hard or mild >= u.SOFT_HITS else "allow"
    return host, path, rule.name if rule else None, hard, mild, verdict


def test_against_slow_and_sql(spark, tmp_path):
    pages = spark.createDataFrame([(i, x, "v", "h") for i, x in enumerate([*URLS, URLS[3]])], "page_id long, url string, verdict string, host string")
    got = {r.page_id: (r.host, r.path, r.rule, r.strict_hits, r.soft_hits, r.verdict) for r in u.judge_urls(pages).collect()}
    assert got == {i: slow(x) for i, x in enumerate([*URLS, URLS[3]])}
    pages.coalesce(1).write.parquet(str(tmp_path / "p"))
    import duckdb

    con = duckdb.connect()
    con.sql(f"create view pages as select * from '{tmp_path}/p/*.parquet'")
    rows = con.sql("select page_id, host, path, rule, strict_hits, soft_hits, verdict from (" + queries.SQL["op3_url_filter"] + ")").fetchall()
    assert {r[0]: r[1:] for r in rows} == got


def test_keep_allowed(spark):
    pages = spark.createDataFrame([(1, None, 1), (None, "http://a.org", 2), (3, "http://xxx.org", 3), (3, "http://a.org", 4), (3, "http://a.org", 4)],
                                  "page_id long, url string, verdict int")
    assert sorted(r.verdict for r in u.keep_allowed(pages).collect()) == [1, 2, 4, 4]
    assert u.keep_allowed(pages).columns == pages.columns
    assert u.judge_urls(pages.filter("false")).count() == 0


def test_whole_table(spark):
    at = "/root/testdata/sf0.001"
    rows = duck(at).sql("select page_id, host, path, rule, strict_hits, soft_hits, verdict from (" + queries.SQL["op3_url_filter"] + ")").fetchall()
    got = queries.op3_url_filter(spark, at).select("page_id", "host", "path", "rule", "strict_hits", "soft_hits", "verdict")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(rows, key=str)
