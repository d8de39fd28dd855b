import re

from clipledger.llm import url_filter as U
from tests.llm.cases import real_rows

RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def parse(url):
    if url is None or "://" not in url:
        return "", ""
    m = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.S)
    return re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2]


def ruled(host, path):
    best = None
    for verdict, h, p in RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            if best is None or len(h + p) > len(best[0]):
                best = (h + p, verdict)
    return best


URLS = [
    None, "", "no scheme", "http://", "http://A.Example.NET/en/1", "https://example.net/en", "https://example.net/de/5",
    "ftp://x.org/fr/a?b#c", "http://x.org?fr/", "http://net", "http://net/", "http://subnet/", "http://É.NET/x", "x://y://z.net/a",
    "http://example.com/de/1", "http://notexample.com/de/1", "http://a.example.com/de", "http://h/a\nb?c", "http://org/fr/",
]


def test_rules(spark):
    rows = [(k, url, "x", "y") for k, url in enumerate(URLS)] + [(1000 + r[0], r[1], "x", "y") for r in real_rows("pages")]
    rows += rows[-3:]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, look string")
    found = U.judge_urls(pages).collect()
    assert len(found) == len(rows)
    wanted = {key: url for key, url, *_ in rows}
    for r in found:
        host, path = parse(wanted[r.page_id])
        rule = ruled(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule and rule[0])
        if rule:
            assert r.verdict == rule[1]
        assert r.verdict in ("allow", "block")


def judged(spark, rows):
    pages = spark.createDataFrame(rows, "page_id long, url string, bad int")
    return {r.page_id: (r.template, r.verdict) for r in U.judge_urls(pages, (), label="bad").collect()}


def test_pure_template_is_rejected_and_others_are_not(spark):
    rows = [(k, f"http://a.b/spam/{k}.html", 1) for k in range(6)] + [(10, "http://a.b/spam/777.html", None)]
    rows += [(20 + k, f"http://a.b/news/{k}", 0) for k in range(6)] + [(30, "http://a.b/news/5", None)]
    rows += [(40, "http://a.b/other/1", None), (41, "http://c.d/spam/1.html", None), (42, "http://a.b/spam/x/1.html", None)]
    rows += [(50 + k, f"http://a.b/mixed/{k}", k % 2) for k in range(8)] + [(60, "http://a.b/mixed/9", None)]
    rows += [(70 + k, f"http://few.b/x/{k}", 1) for k in range(2)]
    found = judged(spark, rows)
    assert found[10] == ("/spam/*.html", "block")
    assert [found[k][1] for k in (30, 40, 41, 42, 60, 70)] == ["allow"] * 6


def test_similar_branches_share_labels(spark):
    """Two labelled pages say little alone; with their siblings, which look alike, they do."""
    rows = [(k, f"http://a.b/w{k % 5}/{k}", 1) for k in range(10)] + [(100 + k, f"http://a.b/w{k}/99", None) for k in range(5)]
    found = judged(spark, rows)
    assert {found[100 + k][1] for k in range(5)} == {"block"}
    # A branch that differs stays apart.
    rows += [(200 + k, f"http://a.b/good/{k}", 0) for k in range(12)]
    found = judged(spark, rows)
    assert {found[200 + k][1] for k in range(12)} == {"allow"}


def test_many_children_become_one_variable(spark):
    rows = [(k, f"http://a.b/user/{'abcdefghij'[k % 10]}{'klmnopqrst'[k // 10]}/page", 1) for k in range(60)]
    found = judged(spark, rows + [(99, "http://a.b/user/zz/page", None)])
    assert found[0] == ("/user/*/page", "block") and found[99] == ("/user/*/page", "block")


def test_empty_and_native(spark):
    out = U.judge_urls(spark.createDataFrame([], "page_id long, url string"))
    assert out.collect() == []
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))


def test_turns_are_stored(spark):
    rows = [(k, f"http://a.b/x{k}/y{k}/{k}", k % 2) for k in range(40)]
    pages = spark.createDataFrame(rows, "page_id long, url string, bad int")
    plan = U.judge_urls(pages, (), label="bad")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") <= 10  # 127 when every turn held the ones before three times
    assert plan.count("Generate posexplode") == 0
