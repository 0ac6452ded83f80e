from pyspark.sql import functions as F

from tableferry.llm.host_trust import host_of, judge, matched_rule, path_of, spread

SCHEMA = "page_id long, url string, html string, rule string"


def test_host_path_and_rule(spark):
    urls = {
        "HTTP://WWW.Example.COM/en/A?x#y": ("www.example.com", "/en/A", "www.example.com/en/"),
        "http://a.example.com/en/": ("a.example.com", "/en/", "example.com/en/"),
        "http://notexample.com/en/": ("notexample.com", "/en/", "com/"),
        "http://example.com": ("example.com", "", None),
        "http://x.net/es/1#/fr/": ("x.net", "/es/1", "net/es/"),
        "http://x.net/FR/": ("x.net", "/FR/", None),
        "x.com/a": ("", "", None),
        "a://b.com?c://d/e": ("b.com", "", None),
        "a\n://b.com/\nc": ("b.com", "/\nc", "com/"),
        None: ("", "", None),
    }
    frame = spark.createDataFrame([(u,) for u in urls], "url string").select("url", host_of(F.col("url")).alias("h"), path_of(F.col("url")).alias("p"))
    got = {r.url: (r.h, r.p, r.rule) for r in frame.withColumn("rule", matched_rule(F.col("h"), F.col("p"))).collect()}
    assert got == urls


def test_walk_equals_power_iteration_by_hand(spark):
    links = {("a", "b"): 2, ("a", "c"): 1, ("b", "c"): 1, ("c", "a"): 5}
    frame = spark.createDataFrame([(s, t, n) for (s, t), n in links.items()], "source string, target string, n long")
    seeds = spark.createDataFrame([("trust", "a", 1.0), ("distrust", "c", 1.0)], "kind string, host string, weight double")
    got = {(r.kind, r.host): r.score for r in spread(spark, seeds, frame, rounds=4).collect()}
    for kind, start, edges in (("trust", "a", links), ("distrust", "c", {(t, s): n for (s, t), n in links.items()})):
        now = {start: 1.0}
        for _ in range(4):
            after = {start: 0.15}
            for (s, t), n in edges.items():
                out = sum(m for (x, _), m in edges.items() if x == s)
                after[t] = after.get(t, 0) + 0.85 * now.get(s, 0) * n / out
            now = after
        assert all(abs(got[kind, h] - v) < 1e-9 for h, v in now.items() if v)


def test_links_decide_where_no_rule_does(spark):
    link = lambda *hosts: "".join(f'<a href="http://{h}/x">x</a>' for h in hosts)
    rows = [
        (1, "http://good.com/a", link("friend.org"), "r"),
        (2, "http://bad.net/es/a", None, "r"),
        (3, "http://shady.org/a", link("bad.net"), "r"),
        (4, "http://friend.org/a", "", "r"),
        (5, "http://unknown.org/", "", "r"),
        (6, None, None, None),
        (6, None, None, None),
    ]
    got = sorted((r.page_id, r.rule, r.verdict) for r in judge(spark, spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == [(1, "com/", "allow"), (2, "net/es/", "block"), (3, None, "block"), (4, None, "allow"), (5, None, "allow"), (6, None, "allow"), (6, None, "allow")]
    assert judge(spark, spark.createDataFrame([], SCHEMA)).count() == 0


def test_distrust_walks_a_long_chain_from_a_minor_share(spark):
    link = lambda url: f'<a href="{url}">x</a>'
    rows = [(i, f"http://h{i}.org/", link(f"//h{i + 1}.org/x" if i % 2 else f"http://h{i + 1}.org/"), "r") for i in range(1, 30)]
    rows += [(30, "http://h30.org/", link("//some.net/a?u=http://h1.org/"), "r")]
    rows += [(40 + i, f"http://some.net/{'es' if i < 2 else 'en'}/{i}", None, "r") for i in range(5)]  # 2 of 5 pages blocked
    got = {r.page_id: r.verdict for r in judge(spark, spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == dict.fromkeys([r[0] for r in rows], "block")


def test_walk_ends_converged(spark):
    links = spark.createDataFrame([("a", "b", 1), ("b", "a", 1)], "source string, target string, n long")
    seeds = spark.createDataFrame([("trust", "a", 1.0)], "kind string, host string, weight double")
    got = {r.host: r.score for r in spread(spark, seeds, links).collect()}
    assert abs(got["a"] - 0.15 / (1 - 0.85**2)) < 1e-4 and abs(got["b"] - 0.85 * got["a"]) < 2e-4
