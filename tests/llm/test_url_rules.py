import re

import pytest

from check_queries import compare
from conftest import SF
from trawl.llm.queries import ORACLES, QUERIES, URL_RULES
from trawl.llm.url_rules import UrlRule, glob_rule, host_rule, judge_urls


def test_query_equals_sql(spark):
    assert compare(spark, SF, QUERIES["op2_url_rules"], ORACLES["op2_url_rules"])[0] is None


def test_main_path_has_no_python(spark):
    plan = QUERIES["op2_url_rules"](spark, SF)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|Exchange", plan.split("== Physical Plan ==")[1])


URLS = {
    "https://a.net/x": ("a.net", "/x", "net/", "block"),
    "https://A.NET/x": ("a.net", "/x", "net/", "block"),
    "https://a.net": ("a.net", "", None, "allow"),
    "https://a.net?q=/": ("a.net", "", None, "allow"),
    "https://www.example.net/en/1": ("www.example.net", "/en/1", "example.net/en/", "allow"),
    "https://example.net/EN/1": ("example.net", "/EN/1", "net/", "block"),
    "https://badexample.net/en/1": ("badexample.net", "/en/1", "net/", "block"),
    "https://example.com/de/#f": ("example.com", "/de/", "example.com/de/", "block"),
    "http://casino-win.com/": ("casino-win.com", "/", None, "block"),
    "http://m.casino-win.org/fr/": ("m.casino-win.org", "/fr/", "org/fr/", "allow"),
    "http://x.net:80/": ("x.net:80", "/", None, "allow"),
    "no scheme.net/": ("", "", None, "allow"),
    "a://b.net/://c.org/fr/": ("b.net", "/://c.org/fr/", "net/", "block"),
    "https://x.com/\nline.exe": ("x.com", "/\nline.exe", None, "block"),
    "": ("", "", None, "allow"),
    None: ("", "", None, "allow"),
    "https://x.net/" + "long/" * 50_000: ("x.net", "/" + "long/" * 50_000, "net/", "block"),
}


def test_verdicts(spark):
    rows = [(i, u, "old") for i, u in enumerate([*URLS, "https://a.net/x"])] + [(None, None, None)]
    judged = judge_urls(spark.createDataFrame(rows, "page_id int, url string, verdict string"), URL_RULES)
    assert judged.columns == ["page_id", "url", "host", "path", "rule", "pattern", "verdict"]
    found = judged.collect()
    assert len(found) == len(rows)
    for r in found:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == URLS[r["url"]], r["url"]


def test_every_rule_is_found_whatever_its_rarest_token(spark):
    rules = [glob_rule("block", f"*/shop{i}-*.html") for i in range(2500)]  # several indexes
    urls = spark.createDataFrame([(f"http://h.com/a/shop{i}-z.html",) for i in range(0, 2600, 100)], "url string")
    found = {r["url"]: r["pattern"] for r in judge_urls(urls, rules).collect()}
    assert all((found[u] is not None) == (int(re.search(r"shop(\d+)", u)[1]) < 2500) for u in found)


def test_allowing_pattern_outweighs_blocking(spark):
    rules = [glob_rule("block", "*/ads/*"), glob_rule("allow", "*/ads/own/*")]
    urls = spark.createDataFrame([("http://h/ads/own/1",), ("http://h/ads/1",)], "url string")
    assert [r["verdict"] for r in judge_urls(urls, rules).collect()] == ["allow", "block"]


def test_columns_of_any_name_stay(spark):
    names = ["_host", "_path", "_target", "_tokens", "_hits", "_named", "_general", "__url_host", "host"]
    rows = spark.createDataFrame([("http://a.net/", *names)], ", ".join(f"{c} string" for c in ["url", *names]))
    row = judge_urls(rows, [host_rule("block", "net/")]).first().asDict()
    assert {c: row[c] for c in names[:-1]} == {c: c for c in names[:-1]}
    assert row["host"] == "a.net" and row["verdict"] == "block" and len(row) == len(names) + 1 + 4


def test_empty_table(spark):
    assert judge_urls(spark.createDataFrame([], "url string"), URL_RULES).count() == 0


def test_rule_errors():
    with pytest.raises(ValueError):
        host_rule("block", "net")
    with pytest.raises(ValueError):
        glob_rule("block", "*a*")
    with pytest.raises(ValueError):
        UrlRule("x", "hide", "x", ("x",))
