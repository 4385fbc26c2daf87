from __future__ import annotations

from marketloom.llm import url_filter

PAGES = "page_id bigint, url string, host string, rule string"


def judged(spark, urls, rules, **options):
    pages = spark.createDataFrame([(i, u, "clash", "clash") for i, u in enumerate(urls)], PAGES)
    listed = spark.createDataFrame(rules, "host string, path string, verdict string")
    rows = url_filter.judge_urls(pages, listed, **options).orderBy("page_id").collect()
    return [(r.host, r.path, r.rule, r.verdict) for r in rows]


def test_rules(spark):
    urls = [
        "http://WWW.Example.com/en/1?x#y",
        "https://blog.example.com/en/1",
        "http://example.com/fr/",
        "http://a.net/es/x",
        "http://example.com",
        "http://notexample.com/en/",
        "x://?q",
        "no scheme",
        None,
        "http://com/",
        "http://b.org/en/",
        "http://a.b://c.net/fr/",
    ]
    assert judged(spark, urls, url_filter.RULES) == [
        ("www.example.com", "/en/1", "www.example.com/en/", "allow"),
        ("blog.example.com", "/en/1", "example.com/en/", "block"),
        ("example.com", "/fr/", "com/", "allow"),
        ("a.net", "/es/x", "net/es/", "block"),
        ("example.com", "", None, "allow"),
        ("notexample.com", "/en/", "com/", "allow"),
        ("", "", None, "allow"),
        ("", "", None, "allow"),
        ("", "", None, "allow"),
        ("com", "/", "com/", "allow"),
        ("b.org", "/en/", None, "allow"),
        ("a.b:", "//c.net/fr/", None, "allow"),
    ]


def test_full_filter_changes_nothing(spark):
    """With a filter of one block everything is a possible hit and the join decides."""
    urls = [f"http://h{i}.net/p{i % 7}/" for i in range(200)]
    rules = [(f"h{i}.net", "/p", "block") for i in range(0, 200, 3)] + [("h3.net", "/p", "allow"), (None, "/", "block")]
    small = judged(spark, urls, rules, bits_per_key=0)
    assert small == judged(spark, urls, rules)
    assert [v for *_, v in small] == ["block" if i % 3 == 0 else "allow" for i in range(200)]


def test_empty_list_and_empty_table(spark):
    assert judged(spark, ["http://a.com/"], [], default="block") == [("a.com", "/", None, "block")]
    assert judged(spark, [], url_filter.RULES) == []
