import re

from kontor.llm import urls

SPECIAL = [
    "http://EXAMPLE.org/es/x", "https://www.example.org/en/1?x=1#y", "http://a.b.example.org/es", "ftp://com/fr/", "http://x.com/de/1",
    "http://xcom/de/1", "no scheme", "", None, "://", "a://b://c/d", "http://h?q=/p", "http://h#f/p", "http://É.com/de/É", "http://x.net/p/",
    "https://www.x.net/p?utm_source=a", "http://x.net/p#top", "http://x.net/p?b=2&a=1&ref=z", "http://x.net/p?a=1&b=2", "http://y.net/\nz",
]


def plain(url, listed):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        raw = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(raw) :])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in raw)
    fits = [r for r in urls.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.name), default=None)
    return host, path, best and best.name, best.verdict if best else "block" if listed else "allow"


def test_verdicts_equal_the_plain_rules(spark):
    rows = [(i, u, "x") for i, u in enumerate(SPECIAL)] + [(3, SPECIAL[14], "x"), (None, SPECIAL[14], "x")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, host string")
    listed = spark.createDataFrame([("x.net/p",), ("x.net/p",), (None,), ("x.net/p?a=1&b=2",)], "url string")
    hit = {14, 15, 16, 17, 18}
    got = urls.judge(pages, listed).collect()
    assert len(got) == len(rows)
    ids = {u: i for i, u in enumerate(SPECIAL)}
    want = [(p, *plain(u, ids[u] in hit)) for p, u, _ in rows]
    assert sorted(map(str, ((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got))) == sorted(map(str, want))


def test_empty_list_and_pages(spark):
    none = spark.createDataFrame([], "url string")
    pages = spark.createDataFrame([(1, "http://x.net/p")], "page_id bigint, url string")
    assert [r.verdict for r in urls.judge(pages, none).collect()] == ["allow"]
    assert urls.judge(pages.where("page_id = 2"), none).collect() == []


def test_filter_has_no_false_negative_and_few_false_positives(spark):
    listed = spark.range(4000).selectExpr("concat('h/', id) AS url")
    others = spark.range(4000, 24000).selectExpr("concat('h/', id) AS url")
    blocks = urls.blocks_for(4000)
    assert urls.possible_hits(listed, listed, blocks).count() == 4000
    assert urls.possible_hits(others, listed, blocks).count() < 200
    assert urls.bloom_filter(listed, blocks).count() <= blocks


def test_only_possible_hits_reach_the_list(spark):
    listed = spark.createDataFrame([("hot.net/p",), ("x.net/p",)], "url string")
    rows = [(i, "http://hot.net/p") for i in range(600)] + [(i, None) for i in range(600, 1200)]
    rows += [(i, f"http://y{i}.net/") for i in range(1200, 1800)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string")
    looked_up = urls.with_possible_hit(pages.select(urls.canonical(pages.url).alias("url")), listed, urls.blocks_for(2))
    passed = [r.url for r in looked_up.where("possible").collect()]
    assert passed.count("hot.net/p") == 600 and None not in passed and len(passed) < 650
    got = urls.judge(pages, listed).collect()
    assert sorted(r.page_id for r in got) == list(range(1800))
    assert {r.page_id for r in got if r.listed} == set(range(600))


def test_a_large_filter_gives_the_same_without_broadcast(spark, monkeypatch):
    listed = spark.range(300).selectExpr("concat('h', id, '.net/p') AS url")
    pages = spark.range(900).selectExpr("id AS page_id", "if(id % 7 = 0, null, concat('http://h', id % 500, '.net/p')) AS url")
    want = sorted(map(str, urls.judge(pages, listed).collect()))
    monkeypatch.setattr(urls, "MAX_BROADCAST_BYTES", 0)
    assert sorted(map(str, urls.judge(pages, listed).collect())) == want
    assert sum("listed=True" in r for r in want) == sum(i % 7 != 0 and i % 500 < 300 for i in range(900))
