"""From raw documents to packed training sequences, in five stages.

Each stage is ``(name, function)``; a function takes ``(spark, docs, sf_dir)``
and returns the documents that it keeps, with the columns of ``documents`` (the
last returns the packed pieces).  A stage's result is written as Parquet and
read again as the next one's input, so a lost executor costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarryline.llm import decontaminate, langid, packing, pii, simhash, tokens
from quarryline.workspace import Workspace


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in no language: null, empty or without any letter.  A null
    ``lang`` becomes the predicted one, and stays where no language could be learned."""
    others = F.struct(*[f"`{c}`" for c in docs.columns if c != "text"])  # so that no name clashes
    found = langid.predict(docs.select(others.alias("row"), "text"), langid.train(docs)).where("lang_pred <> 'und' or lang_score is null")
    lang = F.expr("coalesce(row.lang, if(lang_score is null, null, lang_pred))")
    return found.select(*[F.col("text") if c == "text" else lang.alias(c) if c == "lang" else F.col("row").getField(c).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, that of the smallest id, of each group of near copies.  Null
    and empty texts are one group; of equal rows one stays; whole texts are compared.
    All columns stay as they are, and an empty table stays empty."""
    return simhash.without_near_duplicates(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item.  Null and empty texts and items match
    nothing; equal rows go or stay together; whole texts are searched.  All columns
    stay as they are; without items, or without documents, nothing changes."""
    return decontaminate.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in the texts; ``n_chars`` follows.  A null text stays null
    with a null ``n_chars``, and an empty one empty; every row stays, copies too, with
    all other columns as they are."""
    return pii.sanitise(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2048 tokens.  A null or empty text is its end mark
    alone; rows that repeat an id are packed apart; long texts are cut into pieces, and
    an empty table has none."""
    return packing.pack_documents(docs, tokens.tokenizer_path("byte_bpe_50k.json"), end=1, max_tokens=2048)


STAGES = [
    ("language", identify_language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminated),
    ("personal_data", personal_data),
    ("packing", packed),
]

#: SQL can express neither the classifiers nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of ``documents`` after all stages."""
    work = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = work.keep(stage(spark, docs, sf_dir), name)
    return docs
