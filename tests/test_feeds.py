"""Feeds, sitemaps and answers with JSON."""

from pyspark.sql import functions as F

from quarryline.functions import values as vl
from quarryline.sources import files


def test_an_index_names_its_first_sitemaps(spark, tmp_path):
    url = lambda u, d: f"<url><loc>{u}</loc><lastmod>{d}</lastmod></url>"
    for i in range(4):
        rows = [(url("http://a.b/same", f"2024-01-0{i + 1}"),), (url(f"http://a.b/{i}", "2024-02-01"),), ("<url><lastmod>2024</lastmod></url>",)]
        files.write_xml(spark.createDataFrame(rows, "x string"), f"{tmp_path}/m{i}", "urlset")
    index = spark.createDataFrame([(f"<sitemap><loc>{tmp_path}/m{i}</loc></sitemap>",) for i in range(4)], "x string")
    files.write_xml(index.coalesce(1), f"{tmp_path}/index", "sitemapindex")
    found = {r.loc: r.lastmod for r in files.read_sitemap_index(spark, f"{tmp_path}/index", most=3).collect()}
    assert found == {"http://a.b/same": "2024-01-03", "http://a.b/0": "2024-02-01", "http://a.b/1": "2024-02-01", "http://a.b/2": "2024-02-01"}
    assert {r.loc for r in files.read_sitemap_index(spark, f"{tmp_path}/m1").collect()} == {"http://a.b/same", "http://a.b/1"}


def test_json_of_answers(spark):
    rows = [('{"a":1}', '{"a":1}'), ('```json\n{"a":{"b":2}}\n```', '{"a":{"b":2}}'), ("well: {\"a\": \"}\"} ok", '{"a": "}"}'), ("{cut", None), ("[1]", None), ("", None), (None, None), ("{} and {}", None)]
    frame = spark.createDataFrame([(i, r[0]) for i, r in enumerate(rows)], "id int, t string")
    assert {r.id: r.j for r in frame.select("id", vl.repaired_json(F.col("t")).alias("j")).collect()} == {i: r[1] for i, r in enumerate(rows)}
