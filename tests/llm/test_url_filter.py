import random
import re

from dayflow.llm import url_filter as U
from dayflow.llm.queries import URL_RULES, constant_rows


def brute(url, rules):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "", re.S)
    host, path = (m[1], m[2]) if m else ("", "")
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0]))
            and path.startswith(r[1])]
    best = max(fits, key=lambda r: (len(r[0]) + len(r[1]), len(r[0])), default=None)
    return host, path, best and best[0] + best[1], best[2] if best else "allow"


URLS = [None, "", "nohost", "http://", "http://com", "http://com/", "HTTP://WWW.Example.COM/en/x?q#f",
        "https://example.com/en/1", "http://a.www.example.com/en/", "http://xexample.com/en/",
        "http://example.com.evil/en/", "http://m.net/es/1", "http://net/fr/", "http://net/de/",
        "x://y://z.com/a", "http://a.com?x=/en/", "http://ÄX.com/", "http://.com/", "http://com./",
        "http://a..com/", "http://example.com/EN/", "http://com0/", "http://co/", "http://example.com\n/en/"]


def judged(spark, urls, rules):
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = U.judge(df, constant_rows(spark, "host path verdict", tuple(rules))).collect()
    return [(r.host, r.path, r.rule, r.verdict) for r in sorted(got, key=lambda r: r.page_id)]


def test_contract_rules(spark):
    assert judged(spark, URLS, URL_RULES) == [brute(u, URL_RULES) for u in URLS]


def test_random_nested_rules(spark):
    r = random.Random(3)
    host = lambda n: ".".join(r.choice(["a", "b", "aa", "c-d"]) for _ in range(n))
    path = lambda n: "/" + "".join(r.choice("xy/") for _ in range(n))
    rules = {(host(r.randint(1, 3)), path(r.randint(0, 2))): r.choice(["allow", "block"])
             for _ in range(60)}
    rules = [(h, p, v) for (h, p), v in rules.items()]
    urls = [f"http://{host(r.randint(1, 4))}{path(r.randint(0, 4))}" for _ in range(400)]
    assert judged(spark, urls, rules) == [brute(u, rules) for u in urls]


def test_odd_tables(spark):
    df = spark.createDataFrame([(1, "http://a.com/", "mine", 3)] * 2,
                               "page_id long, url string, host string, verdict int")
    rules = constant_rows(spark, "host path verdict", URL_RULES)
    out = U.judge(df, rules)
    assert out.columns == ["page_id", "url", "host", "path", "rule", "verdict"]
    assert [(r.host, r.rule) for r in out.collect()] == [("a.com", "com/")] * 2
    assert U.judge(df.filter("false"), rules).count() == 0
    assert U.judge(df, rules.filter("false")).first().verdict == "allow"
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_many_path_rules_and_small_cells(spark, monkeypatch):
    """Thousands of path rules on one host, groups dealt to several cells."""
    import time
    monkeypatch.setattr(U, "CELL_ROWS", 50)
    r = random.Random(9)
    path = lambda: "/" + "/".join(r.choice("abcdefgh") * r.randint(1, 2) for _ in range(r.randint(0, 5)))
    rules = {("com", path()): r.choice(["allow", "block"]) for _ in range(300)}
    rules |= {(f"h{i % 4}.com", path()): r.choice(["allow", "block"]) for i in range(300)}
    rules = [(h, p, v) for (h, p), v in rules.items()]
    urls = [f"http://x{i % 9}.h{i % 5}.com{path()}" for i in range(600)]
    assert judged(spark, urls, rules) == [brute(u, rules) for u in urls]
    monkeypatch.undo()
    many = spark.range(4000).selectExpr("'com' as host", "concat('/p', id, '/') as path", "'block' as verdict")
    pages = spark.range(20_000).selectExpr("id as page_id", "concat('http://a', id % 70, '.com/p', id, '/x') as url")
    began = time.monotonic()
    got = U.judge(pages, many).groupBy("verdict").count().collect()
    assert {x.verdict: x["count"] for x in got} == {"block": 4000, "allow": 16_000}
    assert time.monotonic() - began < 40
