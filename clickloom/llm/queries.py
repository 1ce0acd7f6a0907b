"""Registered queries of the operators, over whole tables of a data folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import (
    byte_bpe,
    language,
    lexical_search,
    line_dedup,
    maxent_lm,
    packing,
    pieces,
    quality,
    set_join,
    token_counts,
    toxicity,
    turn_repair,
    vector_search,
)
from clickloom.llm.common import table


def op1_quality_forest(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_rules(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op2_rank_order_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify_languages(table(spark, folder, "documents"))


def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = line_dedup.dedup_lines(table(spark, folder, "documents").select("doc_id", "text"))
    return kept.select(
        "doc_id",
        "n_lines",
        "n_dropped",
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


def op4_section_tokens(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return token_counts.section_tokens(
        table(spark, folder, "documents"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )


def op5_piece_codec(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    coded = pieces.encode_documents(table(spark, folder, "documents"), model)
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"), near=(5, 80))


def op7_convolutional_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op8_learned_partitions(spark: SparkSession, folder: str) -> DataFrame:
    return vector_search.nearest(table(spark, folder, "embeddings"))


def op9_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return set_join.jaccard_components(table(spark, folder, "documents"))


def op10_maxent_lm(spark: SparkSession, folder: str) -> DataFrame:
    return maxent_lm.score_documents(table(spark, folder, "documents"))


def op11_dual_tree_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical_search.rank_documents(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op12_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = byte_bpe.encode_documents(table(spark, folder, "documents"), ranks, public_tokenizers.PATTERN)
    decoded = byte_bpe.decode_documents(coded.select("doc_id", "ids"), ranks, public_tokenizers.PATTERN)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op13_turn_repair(spark: SparkSession, folder: str) -> DataFrame:
    return turn_repair.repair_damaged(table(spark, folder, "conversations"))


LINE_DEDUP_SQL = """
with split as (
    select doc_id, string_split(coalesce(text, ''), chr(10)) as parts from documents
),
lines as (
    select doc_id, unnest(parts) as line, generate_subscripts(parts, 1) as place from split
),
keyed as (
    select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
    from lines
),
shared as (
    select key, max(doc_id) as owner from keyed where length(key) >= 40
    group by key having count(distinct doc_id) >= 5
),
marked as (
    select keyed.*, coalesce(owner <> doc_id, false) as gone from keyed left join shared using (key)
)
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by place) filter (where not gone), ''))
           as kept_sha256
from marked group by doc_id
"""

LEXICAL_SEARCH_SQL = r"""
with texts as (
    select 'd' as kind, row_number() over () as row, doc_id as id, text from documents
    union all
    select 'i', row_number() over (), item_id, text from benchmark
),
terms as (
    select kind, row, id, unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
    from texts
),
counts as (select kind, row, id, term, count(*) as tf from terms group by all),
sizes as (select row, cast(sum(tf) as bigint) as n from counts where kind = 'd' group by row),
totals as (select count(*) as n_documents, cast(sum(n) as bigint) as length from sizes),
weights as (
    select term, cast(floor(1000 * ln((2 * any_value(n_documents) + 2) / (2 * count(*) + 1))) as bigint) as w
    from counts, totals where kind = 'd' group by term
),
shares as (
    select row, id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_documents) // length))) as share
    from counts join sizes using (row) join weights using (term), totals where kind = 'd'
),
scores as (
    select i.row, i.id as item_id, s.row as doc_row, s.id as doc_id, cast(sum(i.tf * s.share) as bigint) as score
    from counts i join shares s using (term) where i.kind = 'i' group by all
),
ranked as (
    select *, row_number() over (partition by row order by score desc, doc_id asc nulls last) as rank
    from scores where score > 0
)
select item_id, cast(rank as integer) as rank, doc_id, score from ranked where rank <= 10
"""

QUERIES = (
    op1_quality_forest,
    op2_rank_order_language,
    op3_line_dedup,
    op4_section_tokens,
    op5_piece_codec,
    op6_best_fit_packing,
    op7_convolutional_toxicity,
    op8_learned_partitions,
    op9_ngram_jaccard_join,
    op10_maxent_lm,
    op11_dual_tree_search,
    op12_byte_bpe,
    op13_turn_repair,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: query for query in QUERIES}


def oracle_sql() -> dict[str, str]:
    return {"op3_line_dedup": LINE_DEDUP_SQL, "op11_dual_tree_search": LEXICAL_SEARCH_SQL}
