import random

from nestmetrics.llm.url_filter import RULES, judge_urls


def slow(url, rules, default="allow"):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1].split("#")[0].split("?")[0]
        host, slash, path = rest.partition("/")
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        path = slash + path
    best = None
    for h, p, v in rules:
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            if best is None or (len(h + p), len(h)) > (len(best[0] + best[1]), len(best[0])):
                best = (h, p, v)
    return host, path, best and best[0] + best[1], best[2] if best else default


URLS = [
    None, "", "x", "http://", "http://COM/a", "https://www.Example.com/en/1?x#y", "http://example.com", "http://a.example.com/en/",
    "http://b.net/es/", "http://net/fr/1", "ftp://.com/", "http://example.com#/en/", "http://a://b/c", "http://example.com?x/en/",
    "http://" + "a." * 3000 + "net/fr/" + "x" * 50_000, "http://näive.net/es/ö",
]


def test_urls_match_a_plain_loop_by_index_and_by_join(spark):
    pages = spark.createDataFrame([(i, u, "old") for i, u in enumerate(URLS + URLS[4:6])], "page_id long, url string, verdict string")
    expected = {i: slow(u, RULES) for i, u in enumerate(URLS + URLS[4:6])}
    for most in (1000, 2):
        got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in judge_urls(pages, RULES, max_indexed=most).collect()}
        assert got == expected


def test_many_random_rules(spark):
    rnd = random.Random(4)
    names = ["a", "b", "ab", "c"]
    host = lambda n: ".".join(rnd.choice(names) for _ in range(rnd.randint(1, n)))
    path = lambda n: "".join("/" + rnd.choice(names) for _ in range(rnd.randint(0, n)))
    rules = list({(h, p): (h, p, rnd.choice(["allow", "block"])) for h, p in ((host(3), path(2)) for _ in range(60))}.values())
    urls = [f"http://{host(5)}{path(4)}" for _ in range(300)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in judge_urls(pages, rules, default="block").collect()}
    assert got == {i: slow(u, rules, "block") for i, u in enumerate(urls)}


def test_empty_pages_and_empty_rules(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert judge_urls(pages, RULES).count() == 0
    one = spark.createDataFrame([(1, "http://a/b")], "page_id long, url string")
    assert judge_urls(one, []).first()["verdict"] == "allow"
