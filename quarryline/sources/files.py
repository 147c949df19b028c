"""Scans and sinks with the rules of a ledger."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def _missing(error: Exception) -> bool:
    return "PATH_NOT_FOUND" in str(error)


def read_json_dataset(spark: SparkSession, path: str, schema: StructType, record_path: str | None = None, strict: bool = False) -> DataFrame:
    """The records of a JSON document, or of the array at a dotted path in it.

    Not strict: a missing or invalid file is an empty table.
    """
    from pyspark.errors import AnalysisException

    top = schema
    for part in reversed((record_path or "").split(".") if record_path else []):
        from pyspark.sql.types import ArrayType

        top = StructType([StructField(part, ArrayType(top) if top is schema else top)])
    reader = spark.read.schema(top).option("multiLine", True).option("mode", "FAILFAST" if strict else "DROPMALFORMED")
    try:
        rows = reader.json(path)  # a missing path is told at once
    except AnalysisException as error:
        if strict or not _missing(error):
            raise
        return spark.createDataFrame([], schema)
    return rows.select(F.explode(record_path).alias("r")).select("r.*") if record_path else rows


def read_ledger(spark: SparkSession, path: str, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """The good lines of a JSON-lines ledger, and the bad ones as text."""
    broken = StructField("_corrupt", StringType())
    rows = spark.read.schema(StructType([*schema.fields, broken])).option("columnNameOfCorruptRecord", "_corrupt").json(path)
    # the corrupt column can't be read alone from text, so lines are parsed once more for the report
    lines = spark.read.text(path)
    parsed = lines.select("value", F.from_json("value", StructType([*schema.fields, broken]), {"columnNameOfCorruptRecord": "_corrupt"}).alias("r"))
    return rows.where(F.col("_corrupt").isNull()).drop("_corrupt"), parsed.where("r is null or r._corrupt is not null").select("value")


def ledger_state(rows: DataFrame, keys: list[str], version: str, revision: str, seen: str) -> DataFrame:
    """Version set, newest revision and first sight of each key."""
    return rows.groupBy(*keys).agg(F.array_sort(F.collect_set(version)).alias("versions"), F.max(revision).alias("revision"), F.min(seen).alias("first_seen"))


def read_feed(spark: SparkSession, path: str, row_tag: str = "item", limit: int = 700) -> DataFrame:
    """Items of RSS (``item``) or Atom (``entry``) files."""
    text = "string"
    schema = f"title {text}, link {text}, guid {text}, id {text}, pubDate {text}, updated {text}, description {text}, summary {text}"
    rows = spark.read.format("xml").option("rowTag", row_tag).schema(schema).load(path)
    excerpt = F.trim(F.regexp_replace(F.regexp_replace(F.coalesce("description", "summary", F.lit("")), "<[^>]+>", " "), r"\s+", " "))
    return rows.select(
        F.trim("title").alias("title"), F.trim("link").alias("url"), F.coalesce("guid", "id", "link").alias("external_id"),
        F.coalesce("pubDate", "updated").alias("published"), F.substring(excerpt, 1, limit).alias("excerpt"),
    )


def write_xml(elements: DataFrame, path: str, root: str) -> None:
    """One column of XML elements as files, each a whole document with this root."""
    import pyarrow as pa

    def framed(batches):
        line = lambda *x: pa.RecordBatch.from_arrays([pa.array(x, pa.string())], ["value"])
        yield line(f"<{root}>")
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.string())], ["value"])
        yield line(f"</{root}>")

    elements.toDF("value").mapInArrow(framed, "value string").write.text(path)


def read_sitemap(spark: SparkSession, path: str) -> DataFrame:
    """URLs and dates of sitemap files."""
    return spark.read.format("xml").option("rowTag", "url").schema("loc string, lastmod string").load(path)


def read_sitemap_index(spark: SparkSession, path: str, most: int = 8) -> DataFrame:
    """URLs and dates of a sitemap, or of the first ``most`` sitemaps that an index
    names, each URL once with its newest date."""
    children = spark.read.format("xml").option("rowTag", "sitemap").schema("loc string").load(path)
    named = [r.loc for r in children.where("loc is not null").select(F.trim("loc").alias("loc")).distinct().orderBy("loc").limit(most).collect()]
    rows = read_sitemap(spark, path)
    for child in named:
        rows = rows.unionByName(read_sitemap(spark, child))
    return rows.where("loc is not null").groupBy(F.trim("loc").alias("loc")).agg(F.max(F.trim("lastmod")).alias("lastmod"))


def zipped_rows(rows: DataFrame, *arrays: str) -> DataFrame:
    """Parallel arrays as rows, with all other columns kept."""
    others = [c for c in rows.columns if c not in arrays]
    return rows.select(*others, F.explode(F.arrays_zip(*arrays)).alias("_z")).select(*others, "_z.*")


def first_provider(*chain: DataFrame, key: str) -> DataFrame:
    """Of each key the rows of the first source in the chain that has any."""
    tagged = None
    for i, rows in enumerate(chain):
        rows = rows.withColumn("_source", F.lit(i))
        tagged = rows if tagged is None else tagged.unionByName(rows, allowMissingColumns=True)
    best = tagged.groupBy(key).agg(F.min("_source").alias("_source"))
    return tagged.join(best, [key, "_source"], "left_semi").drop("_source")


def fingerprint(spark: SparkSession, path: str) -> DataFrame:
    """``files``, ``bytes`` and ``hash`` of a folder: SHA-256 over sums of the hashes
    of relative paths and contents, so no list of files is gathered."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    name = F.element_at(F.split("path", path.rstrip("/").split("/")[-1] + "/", 2), -1)
    each = files.select(F.sha2(F.concat_ws("\0", name, F.sha2("content", 256)), 256).alias("h"), "length")
    part = lambda at: F.sum(F.conv(F.substring("h", at, 15), 16, 10).cast("decimal(38,0)"))
    whole = F.sha2(F.concat_ws("|", F.count("*"), part(1), part(17)), 256)
    return each.agg(F.count("*").alias("files"), F.sum("length").alias("bytes"), whole.alias("hash"))


def append_partitioned(rows: DataFrame, path: str, ts: Column, *by: str) -> None:
    """Append rows as JSON lines under their keys and month."""
    rows.withColumn("month", F.date_format(ts, "yyyy-MM")).write.partitionBy(*by, "month").mode("append").json(path)


def content_version(rows: DataFrame) -> str:
    """A hash of a table's rows that doesn't depend on their order."""
    each = rows.select(F.sha2(F.to_json(F.struct(*sorted(rows.columns)), {"ignoreNullFields": "false"}), 256).alias("h"))
    # two independent sums of the rows' hashes: nothing is gathered or sorted
    part = lambda at: F.sum(F.conv(F.substring("h", at, 15), 16, 10).cast("decimal(38,0)"))
    r = each.agg(F.count("*"), part(1), part(17)).first()
    import hashlib

    return hashlib.sha256("|".join(map(str, r)).encode()).hexdigest()


def write_if_changed(rows: DataFrame, path: str) -> bool:
    """Overwrite ``path`` unless it holds the same rows; whether it was written."""
    from pyspark.errors import AnalysisException

    try:
        if content_version(rows.sparkSession.read.schema(rows.schema).parquet(path)) == content_version(rows):
            return False
    except AnalysisException as error:
        if not _missing(error):
            raise
    rows.write.mode("overwrite").parquet(path)
    return True
