import re

from pyspark.sql import functions as F

from tableflow.llm.url_filter import RULES, bloom_blocks, canonical, filter_urls

URLS = [
    "http://A.Example.com/en/x", "https://www.example.com/en/", "https://example.com/fr/", "http://x.net/es/1",
    "http://net/fr/", "http://x.org/Listed/?utm_source=a#f", "https://www.x.org/Listed", "x.org/Listed", None, "",
    "http://x.org/listed", "ftp://x.org/Listed?ref=b&utm_medium=c", "http://x.org/Listed?page=2", "http://badnet/es/",
    "http://a://b/c", "http://notexample.com/en/", "http://x.org?/Listed", "http://x.org/Listed//?",
]
LISTED = ["http://www.x.org/Listed/", "http://y.org/", None, "no-scheme", "http://x.org/Listed"]


def parts(url):
    found = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)(?:\?([^#]*))?", url or "")
    if not found:
        return "", "", ""
    return found[1].lower(), found[2], found[3] or ""


def key(url):
    host, path, query = parts(url)
    kept = [p for p in query.split("&") if p and not re.match(r"^(utm_[^=]*|ref|gclid|fbclid)(=.*)?$", p)]
    return re.sub(r"^www\.", "", host) + path.rstrip("/") + ("?" + "&".join(kept) if kept else "")


def brute_force(rows):
    listed = {key(u) for u in LISTED if parts(u)[0]}
    out = []
    for page_id, url in rows:
        host, path, _ = parts(url)
        fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        rule = max(fits, key=lambda r: len(r.text), default=None)
        verdict = rule.verdict if rule else "block" if host and key(url) in listed else "allow"
        out.append((page_id, host, path, rule.text if rule else None, verdict))
    return sorted(out, key=str)


def test_verdicts_are_those_of_brute_force(spark):
    rows = [(k, url) for k, url in enumerate(URLS)] + [(5, URLS[5]), (None, URLS[6])]
    pages = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "1 as host", "2 as block", "3 as w0")
    listed = spark.createDataFrame([(u,) for u in LISTED], "url string")
    got = filter_urls(pages, listed)
    assert sorted(map(tuple, got.drop("possible").collect()), key=str) == brute_force(rows)
    assert got.where("verdict = 'block' and rule is null and not possible").count() == 0


def test_empty_list_and_empty_pages(spark):
    pages = spark.createDataFrame([(1, "http://x.org/a")], "page_id long, url string")
    empty = spark.createDataFrame([], "url string")
    assert [r["verdict"] for r in filter_urls(pages, empty).collect()] == ["allow"]
    assert filter_urls(pages.limit(0), pages.select("url")).count() == 0


def test_filter_passes_all_listed_and_few_others(spark):
    listed = spark.range(3000).select(F.concat(F.lit("http://a.org/"), "id").alias("url"))
    pages = spark.range(6000).select(F.col("id").alias("page_id"), F.concat(F.lit("http://a.org/"), "id").alias("url"))
    got = filter_urls(pages, listed, ()).groupBy("verdict", "possible").count().collect()
    counts = {(r["verdict"], r["possible"]): r["count"] for r in got}
    assert counts[("block", True)] == 3000 and ("block", False) not in counts
    assert counts.get(("allow", True), 0) < 60


def test_a_block_has_one_row(spark):
    urls = spark.range(500).select(canonical(F.concat(F.lit("http://a.org/"), "id")).alias("listed_url"))
    assert bloom_blocks(urls, 4).count() == 4
