import re

import numpy as np

from ledgerlens.llm import url_filter as U

RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "a.example.org/es/x"),
         ("block", "com/"), ("allow", "com/"), ("allow", "b.com/"), ("block", "*spam"), ("allow", "*spam"), ("allow", "*good"),
         ("other", "net/"), ("block", None)]
URLS = ["http://EXAMPLE.org/es/1", "https://a.example.org/es/xyz?q=1", "http://example.org/en/12#f", "http://example.org/en/2",
        "ftp://org", "http://org/", "http://notorg/", "http://x.notexample.org/es/", "http://www.spam.net/", "http://good.net/a",
        "http://b.com/x", "http://ab.com/x", "http://b.com", "no scheme", "", None, "http://", "://com/x", "http:///only/path",
        "http://user@b.com/x", "http://b.com:80/x", "http://ß.org/ü/🙂", "a://b://com/", "http://x.org/a\nb", "http://.com/",
        "http://com./", "http://a..org/", "x" * 5000 + "://org/" + "y" * 100_000, "http://EXÄMPLE.com/"]


def expected(url, rules):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1], m[2]) if m else ("", "")
    host = re.sub("[A-Z]", lambda c: c[0].lower(), host)
    best, labels = (0, 0, None, None), []
    for action, rule in rules:
        if rule is None or action not in ("allow", "block"):
            continue
        if rule.startswith("*"):
            labels += [action] * (rule[1:] in host.split("."))
            continue
        cut = rule.index("/")
        if (host == rule[:cut] or host.endswith("." + rule[:cut])) and path.startswith(rule[cut:]):
            best = max(best, (len(rule), cut, rule, action), key=lambda x: (x[0], x[1], x[3] or ""))
    return host, path, best[2], best[3] or max(labels, default="allow")


def frame(spark, urls):
    return spark.createDataFrame([(i, u, "own") for i, u in enumerate(urls)], "page_id long, url string, verdict string")


def judged(spark, urls, rules, **more):
    table = spark.createDataFrame(rules, "action string, rule string")
    out = U.url_filter(spark, frame(spark, urls), table, **more)
    assert out.columns == ["page_id", "url", "verdict", "__url"]
    return {r.page_id: tuple(r["__url"]) for r in out.collect()}


def test_rules_against_brute_force(spark):
    want = {i: expected(u, RULES) for i, u in enumerate(URLS)}
    assert judged(spark, URLS, RULES) == want
    assert judged(spark, URLS, RULES, segment=3) == want  # several arrays


def test_many_rules(spark):
    rules = [("block" if i % 3 else "allow", f"h{i}.example/{'p' * (i % 5)}") for i in range(3000)]
    urls = [f"http://w.h{i}.example/{'p' * (i % 7)}/x" for i in range(0, 3200, 17)]
    assert judged(spark, urls, rules, segment=500) == {i: expected(u, rules) for i, u in enumerate(urls)}


def test_colliding_digests_decide_nothing():
    class Same:
        digests = np.array([-3, 7, 7, 7], np.int64)
        texts = ["low", "1", "a", "2", "b", "3", "c", "4"]

        def text(self, i):
            return self.texts[i]

    digests = U.Digests([])
    digests.arrays, digests.first = [Same()], np.array([], np.int64)
    assert digests.find(["a", "b", "c", "d"], lambda _: 7) == ["2", "3", "4", None]


def test_defined_cases(spark):
    assert judged(spark, [], RULES) == {}
    free = judged(spark, URLS, [("allow", None)])
    assert {v[2:] for v in free.values()} == {(None, "allow")}


def test_digest_is_the_one_of_spark(spark):
    import xxhash
    from pyspark.sql import functions as F
    for text in ("", "a", "example.org/es/", "ß" * 40):
        want = spark.range(1).select(F.xxhash64(F.lit(text)).alias("h")).first()["h"]
        assert np.array([xxhash.xxh64_intdigest(text.encode(), U.SEED)], np.uint64).view(np.int64)[0] == want
