"""The registered queries of this subpackage, one a numbered operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components: 3-word SimHash within two bits."""
    from quarryline.llm.simhash import simhash_components

    found = simhash_components(_table(spark, sf_dir, "documents"), words=3, radius=2, seed=42)
    return found.select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2048 tokens."""
    from quarryline.llm.packing import pack_documents
    from quarryline.llm.tokens import tokenizer_path

    return pack_documents(_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), end=1, max_tokens=2048)


def packed_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions with their answers, packed under limits of 2048 tokens, 16 segments
    and 1024 tokens of answers, which alone bear loss."""
    from quarryline.llm.packing import pack_documents
    from quarryline.llm.tokens import tokenizer_path

    turns = _table(spark, sf_dir, "conversations")
    asked = turns.where("role = 'user'").select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("prompt"))
    pairs = turns.where("role = 'assistant'").join(asked, ["conv_id", "turn"], "left").select((F.col("conv_id") * 1_000_000 + F.col("turn")).alias("example"), "prompt", "text")
    found = pack_documents(pairs, tokenizer_path("byte_bpe_50k.json"), end=1, max_tokens=2048, max_segments=16, max_loss=1024, id_col="example", prompt_col="prompt")
    return found.withColumnRenamed("doc_id", "example")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data, and of terms that disclose it."""
    from quarryline.llm import pii

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find_pii(docs, pii.disclosing_terms(docs))
    return found.select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in pii.KINDS[:4]],
        F.sha2(pii.listed(pii.KINDS[:4]), 256).alias("base_sha256"),
        pii.listed().alias("spans"),
        F.size("term").cast("long").alias("n_term"),
    )


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item within a fifth of its words in edits."""
    from quarryline.llm.decontaminate import contaminated

    found = contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.withColumnRenamed("id", "doc_id")


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of all documents, written and read back."""
    from quarryline.llm import tokens
    from quarryline.workspace import Workspace

    path = Workspace(spark, "tokens").path
    tokens.write_token_files(_table(spark, sf_dir, "documents"), path, tokens.tokenizer_path("byte_bpe_50k.json"), end=2)
    files = tokens.with_global_start(tokens.read_token_files(spark, path))
    return tokens.with_crc(files.select("doc_id", "start", F.col("n_tokens").cast("long").alias("n_tokens"), "ids"))


def _remainder(n: int):
    """crc32 of the id as text, modulo ``n``; a null id counts as ''."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(n))


def op6_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-bilinear scores of all documents; fold 1 of 5 is held out."""
    from quarryline.llm import lm

    found = lm.score(_table(spark, sf_dir, "documents"), _remainder(5) != 1)
    return found.select(F.col("id").alias("doc_id"), (~F.col("learns")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents; folds 0 and 2 of 3 are for learning."""
    from quarryline.llm import quality

    docs = _table(spark, sf_dir, "documents")
    model = quality.train(docs, _table(spark, sf_dir, "labels").where(_remainder(3) != 1))
    return quality.score(docs, model).select(
        F.col("id").alias("doc_id"), "score"
    ).select("doc_id", (_remainder(3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every fiftieth one."""
    from quarryline.llm.ann import nearest

    vectors = _table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where("vec_id % 50 = 0"), neighbours=5)


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of all documents without repeated strings of 200 bytes."""
    from quarryline.llm.substrings import remove_repeats

    return remove_repeats(_table(spark, sf_dir, "documents"), length=200).withColumnRenamed("id", "doc_id")


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents; folds 1 to 4 of 5 are for learning."""
    from quarryline.llm import langid

    docs = _table(spark, sf_dir, "documents")
    model = langid.train(docs.where(_remainder(5) != 0))
    found = langid.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", (_remainder(5) == 0).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentence pieces of all documents, and what they decode to."""
    from quarryline.llm.pieces import piece_digests
    from quarryline.llm.tokens import tokenizer_path

    return piece_digests(_table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model")).withColumnRenamed("id", "doc_id")


def op12_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their middle moved to the end, and restored."""
    from quarryline.llm.infill import fill_in_middle

    found = fill_in_middle(_table(spark, sf_dir, "documents"), digest=True)
    return found.select(F.col("id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars", F.col("output").alias("output_sha256"), F.col("restored").alias("restored_sha256"))


def op13_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of conversations that begin with turns of every fifth one."""
    from quarryline.llm.trie import prefix_trie

    conv = F.col("conv_id")
    return prefix_trie(_table(spark, sf_dir, "conversations"), head=F.crc32(conv.cast("string").cast("binary")) % 9, base=conv - conv % 5)


QUERIES = {
    "op2_packing": op2_packing,
    "op3_pii": op3_pii,
    "op4_decontamination": op4_decontamination,
    "op5_token_files": op5_token_files,
    "op6_lm": op6_lm,
    "op7_quality": op7_quality,
    "op8_neighbours": op8_neighbours,
    "op9_repeats": op9_repeats,
    "op10_language": op10_language,
    "op1_simhash": op1_simhash,
    "op11_sentencepiece": op11_sentencepiece,
    "op12_infill": op12_infill,
    "op13_trie": op13_trie,
    "packed_conversations": packed_conversations,
}

_INFILL_SQL = r"""
with texts as (
  select doc_id, coalesce(text, '') as text, sha256('7:' || coalesce(doc_id::varchar, '')) as drawn from documents
), units as (
  select doc_id, text, regexp_extract_all(text, '[^\n]*\n|[^\n]+') as u,
    [('0x' || drawn[1:8])::bigint, ('0x' || drawn[9:16])::bigint, ('0x' || drawn[17:24])::bigint, ('0x' || drawn[25:32])::bigint] as h
  from texts
), cuts as (
  select *, len(u) as n, least(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) as a, greatest(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) as b,
    case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h[3] % 100 >= 100 then 'plain'
      when h[4] % 100 < 50 then 'spm' else 'psm' end as form
  from units
), parts as (
  select *, array_to_string(u[1:a], '') as prefix, array_to_string(u[a + 1:b], '') as middle, array_to_string(u[b + 1:], '') as suffix from cuts
)
select doc_id, n::bigint as n, form, case when form <> 'plain' then length(prefix) end as prefix_chars,
  case when form <> 'plain' then length(middle) end as middle_chars,
  sha256(case form when 'plain' then text when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
  sha256(text) as restored_sha256
from parts
"""

# DuckDB has no CRC-32, so a table of its 256 steps is made by eight shifts each.
_TRIE_SQL = """
with recursive steps as (
  select i, 0 as k, i::bigint as c from range(256) t(i)
  union all select i, k + 1, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end from steps where k < 8
), crc_table as (
  select list(c order by i) as t from steps where k = 8
), own as (
  select conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as turns
  from conversations where conv_id is not null group by conv_id
), heads as (
  select conv_id, turns, conv_id - conv_id % 5 as base,
    xor(list_reduce(list_prepend(4294967295::bigint, [ascii(x)::bigint for x in string_split(conv_id::varchar, '')]),
      lambda s, x: xor(s >> 8, t[(xor(s, x) & 255) + 1])), 4294967295) % 9 as h
  from own, crc_table
), rebuilt as (
  select c.conv_id, list_concat(coalesce(b.turns[1:c.h], []), c.turns[c.h + 1:]) as turns from heads c left join own b on b.conv_id = c.base
), prefixes as (
  select conv_id, len(turns) as size, d::bigint as depth, turns[1:d] as prefix, coalesce(strlen(turns[d].text), 0) as bytes from rebuilt, unnest(range(len(turns) + 1)) t(d)
), nodes as (
  select depth, prefix, min(conv_id) as conv_id, count(*) as n_convs, any_value(bytes) as bytes,
    sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where size = depth), '')) as ends_sha256
  from prefixes group by depth, prefix
), up as (
  select n.*, p.conv_id as parent_conv_id from nodes n left join nodes p on p.depth = n.depth - 1 and p.prefix = n.prefix[1:n.depth - 1]
), children as (
  select parent_conv_id as conv_id, depth - 1 as depth, count(*) as n_children from up where depth > 0 group by all
), own_values as (
  select up.*, coalesce(n_children, 0) as n_children from up left join children using (conv_id, depth)
), below as (
  select a.conv_id, a.depth, count(*) filter (where v.n_children = 0) as n_leaves, sum((v.n_convs - 1) * v.bytes)::bigint as saved_tokens
  from own_values v, unnest(range(v.depth + 1)) t(d) join nodes a on a.depth = d and a.prefix = v.prefix[1:d]
  group by a.conv_id, a.depth
)
select conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 from own_values join below using (conv_id, depth)
"""

#: DuckDB SQL where SQL can express a query.
ORACLE_SQL: dict[str, str] = {"op12_infill": _INFILL_SQL, "op13_trie": _TRIE_SQL}
