import corpus_pipeline
from tests.llm.helpers import SCHEMA, awkward_rows


def test_stages_on_awkward_rows(spark, tmp_path):
    rows = [r[:5] for r in awkward_rows()]
    rows.append((50, "Write to someone@mail.example.org about the river and the stone and the cloud today.", "en", "s", 1))
    rows.append((51, "before the leaked benchmark passage of twelve plain words stands right here now after", "en", "s", 1))
    docs = spark.createDataFrame(rows, ", ".join(SCHEMA.split(", ")[:5])).selectExpr("*", "1 as id", "'k' as key", "'e' as email", "2 as n", "'l' as lang_pred", "1.5 as lang_score", "'r' as row", "3 as _key", "'b' as _bytes", "'p' as _predicted", "0.5 as _score", "7 as _row", "'t' as _text", "4 as _rank", "5 as set", "6 as fp")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "the leaked benchmark passage of twelve plain words stands right here now")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    columns = docs.columns
    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        now = stage(spark, now, str(tmp_path))
        now.write.parquet(f"{tmp_path}/{name}")
        now = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = now
        if i < len(corpus_pipeline.STAGES) - 1:
            assert now.columns == columns
    ids = lambda name: {r.doc_id for r in seen[name].collect()}
    assert not ids("language") & {20, 21, 22, 24} and {0, 3, 28, 23} <= ids("language")
    assert ids("near_duplicates") == ids("language") - {26, 27, None}
    assert ids("decontamination") == ids("near_duplicates") - {51}
    assert seen["personal_data"].where("doc_id = 50").first().text.startswith("Write to [EMAIL] about")
    assert ids("packing") == ids("decontamination")


def test_stages_on_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], ", ".join(SCHEMA.split(", ")[:5])).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_a_table_without_languages_keeps_its_texts(spark):
    docs = spark.createDataFrame([(1, "a stone in the river", None), (2, "123 !", None), (3, None, None), (4, "", None)], "doc_id long, text string, lang string")
    kept = corpus_pipeline.identify_language(spark, docs, "").collect()
    assert [(r.doc_id, r.lang) for r in kept] == [(1, None)]
