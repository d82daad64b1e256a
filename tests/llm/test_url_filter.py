"""The trie and the join against a plain scan over all rules."""

import random

from tripwise.llm import url_filter as uf
from tripwise.llm.queries import QUERIES, URL_RULES


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:]
    return host, path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]


def plain(url, rules, default="allow"):
    host, path = split(url)
    fits = [((len(h) + len(p), h.count("."), v == "block"), h + p, v) for h, p, v in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(None, None, default))
    return host, path, best[1], best[2]


def urls(seed=3, n=400):
    rng = random.Random(seed)
    hosts = ["a.example.net", "EXAMPLE.com", "example.org", "notexample.com", "x.y.net", "net", "b.org", "ünï.net", ""]
    paths = ["", "/", "/en/", "/en", "/en/x/y", "/de/1", "/de", "/fr/a/", "/fr", "//", "/e", "/enx/"]
    ends = ["", "?q=/de/", "#/en/", "?a#b"]
    return [None, "", "no scheme", "x://", "http://net/\n/en/", "http://h://net/"] + [
        f"{rng.choice(['http', 'https'])}://{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(ends)}" for _ in range(n)]


RULES = URL_RULES + [("example.com", "/de", "allow"), ("example.com", "/e", "block"), ("org", "/", "block"),
                     ("org", "/", "allow"), ("b.org", "", "allow"), ("y.net", "/en/x", "block")]


def test_trie_and_join_equal_a_scan(spark):
    u = urls()
    df = spark.createDataFrame([(i, x, "clash") for i, x in enumerate(u)], "page_id long, url string, host string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    for given, table in ((URL_RULES, rules.limit(4)), (RULES, rules)):
        want = {i: plain(x, given) for i, x in enumerate(u)}
        for out in (uf.judge(df, given), uf.judge_by_join(df, spark.createDataFrame(given, table.schema))):
            got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in out.collect()}
            assert got == want


def test_empty_repeated_and_size_check(spark, tmp_path):
    schema = "page_id long, url string, html string"
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/a/pages.parquet")
    assert QUERIES["op1_url_filter"](spark, f"{tmp_path}/a").count() == 0
    spark.createDataFrame([(1, "http://x.net/", "")] * 3 + [(None, None, None)], schema).write.parquet(f"{tmp_path}/b/pages.parquet")
    rows = QUERIES["op1_url_filter"](spark, f"{tmp_path}/b").collect()
    assert sorted((r.rule or "", r.verdict) for r in rows) == [("", "allow")] + [("net/", "block")] * 3
    try:
        uf.judge(spark.createDataFrame([], schema), [("h" * 1000, "/" + str(i), "block") for i in range(40_000)])
    except ValueError as e:
        assert "judge_by_join" in str(e)
    else:
        raise AssertionError("no size check")


def test_a_column_named_like_the_helper_stays(spark):
    df = spark.createDataFrame([("http://a.net/x", "kept")], "url string, __hit string")
    rules = spark.createDataFrame([("net", "/", "block")], "host string, path string, verdict string")
    for out in (uf.judge(df, [("net", "/", "block")]), uf.judge_by_join(df, rules)):
        row = out.first()
        assert (row["__hit"], row["rule"], row["verdict"]) == ("kept", "net/", "block")
