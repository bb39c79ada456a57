from touchline.llm import urlfilter

PAGES = "page_id long, url string, html string"


def judge(spark, urls, rules=None):
    df = spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)], PAGES)
    rules = urlfilter.default_rules(spark) if rules is None else rules
    return {r.page_id: r for r in urlfilter.filter_urls(df, rules).collect()}


def test_contract_rules(spark):
    got = judge(spark, [
        "http://a.example.net/en/x?q#f", "https://EXAMPLE.net/EN/", "http://example.net", "http://xnet/", "http://net/a",
        "http://shop.example.com/de/1", "http://example.com/fr/", "https://a.org/fr/b", "no scheme/net/", None,
        "http://cheap-pills.shop.com/", "x://y.org?z=/fr/", "http://example.net:80/en/"])
    rules = [got[i].rule for i in range(13)]
    assert rules == ["example.net/en/", "net/", None, None, "net/", "example.com/de/", None, "org/fr/",
                     None, None, None, None, None]
    assert [got[i].verdict for i in range(13)] == ["allow", "block", "allow", "allow", "block", "block", "allow",
                                                   "allow", "allow", "allow", "block", "allow", "allow"]
    assert (got[8].host, got[8].path, got[9].host, got[9].path) == ("", "", "", "")
    assert (got[1].host, got[1].path, got[11].host, got[11].path) == ("example.net", "/EN/", "y.org", "")


def test_every_rule_is_found_by_its_token(spark):
    """Against running every expression on every URL."""
    import re
    rules = spark.createDataFrame([
        ("||ads.", "block", "pattern"), ("/banner/", "block", "pattern"), ("*x*y*", "block", "pattern"),
        ("track^", "block", "pattern"), ("|http://start", "block", "pattern"), ("end|", "block", "pattern"),
        ("good/", "allow", "host"), ("a.b|c/", "block", "host")], urlfilter.RULE_SCHEMA)
    urls = ["http://ads.a.com/", "http://b.ads.com/", "http://loads.com/", "http://q/banner/z", "http://q/xbannery/",
            "http://q/my-track?x", "http://start/", "http://q/the-end", "http://good/path", "http://q/xay", "", "track"]
    compiled = urlfilter.compile_rules(rules).collect()
    got = judge(spark, urls, rules)
    for i, url in enumerate(urls):
        fits = {r.rule for r in compiled if r.kind == "pattern" and re.search(r.regex, url.lower())}
        assert (got[i].pattern_rule in fits) if fits and got[i].rule is None else got[i].pattern_rule is None, url


def test_repeated_rows_empty_tables_and_extra_columns(spark):
    df = spark.createDataFrame([(1, "http://net/", "h")] * 3 + [(None, "http://net/", None)], PAGES)
    df = df.selectExpr("*", "'x' AS host", "'y' AS rule", "'z' AS tokens", "1 AS token")
    assert [r.verdict for r in urlfilter.filter_urls(df, urlfilter.default_rules(spark)).collect()] == ["block"] * 4
    assert urlfilter.filter_urls(df.limit(0), urlfilter.default_rules(spark)).count() == 0
    none = spark.createDataFrame([], urlfilter.RULE_SCHEMA)
    assert {r.verdict for r in urlfilter.filter_urls(df, none).collect()} == {"allow"}
