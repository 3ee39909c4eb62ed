from fleetgauge.llm import urls
from fleetgauge.llm.search_queries import URL_RULES

SCHEMA = "page_id long, url string, host string, path string, n long"


def judged(spark, rows, outcomes=(), **more):
    pages = spark.createDataFrame([(i, u, "h", "p", 1) for i, u in rows], SCHEMA)
    marks = spark.createDataFrame(list(outcomes), "id long, bad int")
    return {r.page_id: r for r in urls.judge_urls(pages, marks, URL_RULES, **more).collect()}


def test_parts_and_rules(spark):
    rows = [
        (1, "HTTP://WWW.Example.NET/en/x?q=http://a/b"), (2, "https://example.net/fr/"), (3, "https://a.example.com/de/x#y"), (4, "https://a.example.com/dex"),
        (5, "http://x.org/fr/1"), (6, "http://net"), (7, None), (8, "no scheme/en"), (9, ""), (10, "http://"), (11, "http://notexample.com/de/"), (12, "x://example.net/en/?a://b"),
    ]
    got = judged(spark, rows)
    assert [(got[i].host, got[i].path) for i in (1, 6, 7, 8, 9, 10)] == [("www.example.net", "/en/x"), ("net", ""), ("", ""), ("", ""), ("", ""), ("", "")]
    assert [got[i].rule for i in range(1, 13)] == [
        "example.net/en/", "net/", "example.com/de/", None, "org/fr/", None, None, None, None, None, None, "example.net/en/",
    ]
    assert [got[i].verdict for i in range(1, 7)] == ["allow", "block", "block", "allow", "allow", "allow"]


def test_rates_shrink_and_block(spark):
    rows = [(i, f"http://bad{i % 4}.spam.com/{i}") for i in range(400)] + [(1000 + i, f"http://good{i % 40}.fine.com/{i}") for i in range(400)]
    rows += [(5000, "http://new.spam.com/x"), (5001, "http://new.fine.com/x")]
    outcomes = [(i, int(i % 10 != 0)) for i in range(400)] + [(1000 + i, 0) for i in range(400)] + [(None, 1), (3, None), (7, 0), (9_999, 1)]
    got = judged(spark, rows, outcomes)
    assert got[1].verdict == "block" and got[1001].verdict == "allow" and got[5001].verdict == "allow"
    assert got[5001].bad_rate < 0.1 < 0.5 < got[5000].bad_rate < got[1].bad_rate + 0.2  # a new host takes its domain's rate
    assert got[5000].n_labelled == 0


def test_suffixes_of_two_labels(spark):
    hosts = ["a.b.co.uk", "co.uk", "uk", "", "u:p@x.example.com:8080", "x.y.z"]
    df = spark.createDataFrame([(h,) for h in hosts], "host string")
    got = [tuple(r) for r in df.select(*urls.domain_and_suffix("host")).collect()]
    assert got == [("b.co.uk", "co.uk"), ("co.uk", "co.uk"), ("uk", "uk"), ("", ""), ("example.com", "com"), ("y.z", "z")]


def test_empty_tables_and_repeated_rows(spark):
    assert judged(spark, []) == {}
    pages = spark.createDataFrame([(1, "http://a.com/", "", "", 0)] * 3, SCHEMA)
    none = spark.createDataFrame([], "id long, bad int")
    assert [r.verdict for r in urls.judge_urls(pages, none, URL_RULES).collect()] == ["allow"] * 3


def test_addresses_last_dots_and_own_suffixes(spark):
    hosts = ["10.0.0.1", "192.168.0.1:80", "example.com.", "a.example.com.:8080", "[::1]:80", "[2001:db8::1]", "1.2.3", "x.y.co.kr", "300.1.1.1.de"]
    df = spark.createDataFrame([(h,) for h in hosts], "host string")
    got = [tuple(r) for r in df.select(*urls.domain_and_suffix("host", ["co.kr"])).collect()]
    assert got == [
        ("10.0.0.1", "10.0.0.1"), ("192.168.0.1", "192.168.0.1"), ("example.com", "com"), ("example.com", "com"), ("[::1]", "[::1]"),
        ("[2001:db8::1]", "[2001:db8::1]"), ("2.3", "3"), ("y.co.kr", "co.kr"), ("1.de", "de"),
    ]
    rows = [(i, "http://10.0.0.1/x") for i in range(50)] + [(100 + i, "http://192.168.0.1/") for i in range(50)] + [(200 + i, f"http://ok{i}.net.x/") for i in range(50)]
    got = judged(spark, rows, [(i, 1) for i in range(50)] + [(200 + i, 0) for i in range(50)])
    assert got[1].verdict == "block" and got[101].verdict == "allow"
