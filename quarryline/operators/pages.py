"""Article bodies from the structured data of pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarryline.functions import text as tx
from quarryline.workspace import Workspace

_SCRIPT = r"""(?is)<script[^>]+type=["']application/ld\+json["'][^>]*>(.*?)</script>"""


def json_ld_bodies(pages: DataFrame, page_id: str, html: str, least: int = 120) -> DataFrame:
    """``page_id, place, body``: the article bodies of the JSON-LD in pages, in the
    order in which a walk meets them.

    Arrays, and the ``@graph`` array of an object, are walked to any depth; a body
    is a string ``articleBody`` of an object that is reached so.  Scripts that are no
    JSON, and other values, are passed over.  Bodies are freed of markup, and those
    of fewer than ``least`` characters go.  Each round of ``VARIANT`` steps goes one
    level down for all pages at once; there are as many as the deepest nesting.
    """
    work = Workspace(pages.sparkSession, "pages")
    scripts = pages.select(F.col(page_id), F.posexplode(F.regexp_extract_all(html, F.lit(_SCRIPT), F.lit(1))).alias("p", "json"))
    nodes = scripts.select(page_id, F.array("p").alias("path"), F.try_parse_json("json").alias("node")).where("node is not null")
    found = None
    while True:
        kind = F.schema_of_variant("node")
        nodes = work.keep(nodes.where(kind.startswith("ARRAY") | kind.startswith("OBJECT")).select(page_id, "path", "node", kind.startswith("ARRAY").alias("many")), "nodes")
        if nodes.isEmpty():
            break
        told = F.try_variant_get("node", "$.articleBody", "variant")
        body = nodes.where(~F.col("many") & (F.schema_of_variant(told) == "STRING")).select(page_id, "path", F.try_variant_get("node", "$.articleBody", "string").alias("body"))
        found = body if found is None else found.union(body)
        inside = F.when(F.col("many"), F.try_variant_get("node", "$", "array<variant>")).otherwise(F.try_variant_get("node", "$['@graph']", "array<variant>"))
        nodes = nodes.select(page_id, "path", F.posexplode(inside).alias("i", "node")).select(page_id, F.array_append("path", F.col("i")).alias("path"), "node").where("node is not null")
    if found is None:
        return nodes.select(page_id, F.lit(0).cast("long").alias("place"), F.lit("").alias("body"))
    clean = found.select(page_id, "path", tx.strip_html(F.col("body")).alias("body")).where(F.length("body") >= least)
    of_page = F.array_sort(F.collect_list(F.struct("path", "body")))  # a page's own bodies
    each = clean.groupBy(page_id).agg(of_page.alias("b")).select(page_id, F.posexplode("b").alias("i", "b"))
    return each.select(page_id, (F.col("i") + 1).cast("long").alias("place"), "b.body")
