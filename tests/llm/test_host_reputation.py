from compare import connect, differences, run_sql
from pyspark.sql import functions as F

from barloom.llm import host_reputation as H
from barloom.llm.queries import op10_host_reputation


def judged(pages, **more):
    return {r.page_id: r for r in H.judge(pages, F.col("bad"), **more).collect()}


def pages(spark, rows):
    made = [(i, u, b) for i, (u, b) in enumerate(rows)]
    return spark.createDataFrame(made, "page_id long, url string, bad long").selectExpr("*", "'x' AS host", "'y' AS path", "'z' AS lower", "1 AS n")


def test_sql_agrees(spark, sf_dir):
    assert not differences(op10_host_reputation(spark, sf_dir).toArrow(), run_sql(connect(sf_dir), H.ORACLE))


def test_rules_and_parts(spark):
    urls = {
        "http://a.COM/x?q": ("a.com", "/x", "com/"),
        "http://a.com?x": ("a.com", "", None),
        "https://Example.com/en/1#t": ("example.com", "/en/1", "example.com/en/"),
        "https://www.example.com/en/1": ("www.example.com", "/en/1", "www.example.com/en/"),
        "https://a.www.example.com/en/": ("a.www.example.com", "/en/", "www.example.com/en/"),
        "https://notexample.com/en/": ("notexample.com", "/en/", "com/"),
        "ftp://x.net/es/y": ("x.net", "/es/y", "net/es/"),
        "ftp://x.net/ES/y": ("x.net", "/ES/y", None),
        "no scheme/en/": ("", "", None),
        "http://É.org/a://b": ("É.org", "/a://b", None),
        None: ("", "", None),
    }
    got = judged(pages(spark, [(u, 0) for u in urls]))
    assert [(got[i].host, got[i].path, got[i].rule) for i in range(len(urls))] == list(urls.values())
    verdicts = {"com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "net/es/": "block", None: "allow"}
    assert all(r.verdict == verdicts[r.rule] for r in got.values())


def test_hosts_are_shrunk(spark):
    rows = [("http://bad.one.org/p", 1)] * 40 + [("http://new.one.org/p", 1)] + [("http://good.two.org/p", 0)] * 300 + [("http://rare.two.org/p", 1)]
    rows += [(f"http://h{i}.two.org/", i % 20 == 0) for i in range(100)]
    got = {r.host: r.verdict for r in judged(pages(spark, [(u, int(b)) for u, b in rows])).values()}
    assert got["bad.one.org"] == "block"  # many bad pages
    assert got["rare.two.org"] == "allow"  # one bad page under a good domain
    assert got["good.two.org"] == "allow"


def test_edges(spark):
    none = judged(pages(spark, [("http://a.org/", None), ("http://b.org/", None)]))
    assert [r.verdict for r in none.values()] == ["allow", "allow"]
    assert judged(pages(spark, [])) == {}
    twice = H.judge(pages(spark, [("http://a.org/" + "x" * 300_000, 1)]).union(pages(spark, [("http://a.org/", 1)])), F.col("bad"))
    assert twice.count() == 2
    assert [r[0] for r in spark.createDataFrame([("",), (None,), ("<p>" + "abc def " * 30,), ("*** " * 30 + "abc " * 30,)], "h string").select(H.bad_page(F.col("h"))).collect()] == [1, None, 0, 1]


def test_suffixes_and_domains(spark):
    hosts = {"a.b.co.uk": ("co.uk", "b.co.uk"), "x.y.com": ("com", "y.com"), "y.com:80": ("com", "y.com"), "1.2.3.4": ("4", "1.2.3.4"), "localhost": ("localhost", "localhost"), "": ("", "")}
    df = spark.createDataFrame([(h,) for h in hosts], "h string").select("h", H.suffix_of(F.col("h")), H.domain_of(F.col("h")))
    assert {r[0]: (r[1], r[2]) for r in df.collect()} == hosts


def test_a_page_is_read_once(spark, monkeypatch):
    counted = []
    monkeypatch.setattr(H, "stored", lambda df, purpose: counted.append(df) or df)
    made = pages(spark, [("http://a.org/", 1)]).withColumn("html", F.concat(F.lit("<p>"), "url"))
    H.judge(made.repartition(2), H.bad_page(F.col("html")))
    plan = counted[0]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("<script") == 1, plan
    odd = {"a" * 49: 1, "a" * 50: 0, "*" * 6 + "a" * 54: 0, "*" * 6 + "a" * 53: 1, "𝔸" * 50: 0, "<script>x</script>" + "日本" * 25: 0, "_" * 7 + "é 1" * 60: 1}
    got = spark.createDataFrame([(t,) for t in odd], "h string").select("h", H.bad_page(F.col("h"))).collect()
    assert {r[0]: r[1] for r in got} == odd
