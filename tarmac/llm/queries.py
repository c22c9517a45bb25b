"""The queries of the operators, on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm import (
    collocations,
    languages,
    lines,
    mixing,
    ngrams,
    pages,
    passages,
    pieces,
    pii,
    quality,
    search,
    sharding,
    vectors,
)

# Fixed value: the number of shards.
SHARDS = 24
# Fixed value: the least cosine of linked vectors.
LEAST_COSINE = 0.93

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op2_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    rows = vectors.linked(table(spark, folder, "embeddings"), LEAST_COSINE)
    return rows.select(
        F.col("id").alias("vec_id"), "n_links", "component_id", (F.col("id") == F.col("component_id")).alias("kept")
    )


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    rows = pages.extracted(table(spark, folder, "pages").select("page_id", "url", "html"))
    return rows.select("row.page_id", "row.url", "text", F.length("text").cast("long").alias("n_chars"))


def op3_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    rows = pieces.round_trip_digests(table(spark, folder, "documents").select("doc_id", "text"), tokenizer_path())
    return rows.select("row.doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op4_pii(spark: SparkSession, folder: str) -> DataFrame:
    rows = pii.detected(table(spark, folder, "documents").select("doc_id", "text"))
    base = pii.written(F.col("base"))
    added = pii.written(F.col("added"))
    return rows.select(
        "row.doc_id",
        *[F.size(kind).cast("long").alias(f"n_{kind}") for kind in pii.BASE],
        F.sha2(base, 256).alias("base_sha256"),
        F.concat_ws(",", *[F.when(part != "", part) for part in (base, added)]).alias("spans"),
    )


def op5_sharding(spark: SparkSession, folder: str) -> DataFrame:
    text = F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8")
    digests = table(spark, folder, "documents").select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32")
    )
    rows = sharding.sharded(digests, ["doc_id"], SHARDS, seed=17)
    return rows.select(
        "row.*", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op6_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    rows = ngrams.linked(table(spark, folder, "documents").select("doc_id", "text"))
    return rows.withColumnRenamed("id", "doc_id")


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    rows = mixing.accounted(docs, F.array("source"), seed=11)
    taken = (F.col("size") * F.col("repeats")).alias("taken")
    return rows.select("row.doc_id", "size", "source_size", "target", taken)


def op8_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    return lines.cleaned(docs, min_words=1).select("row.doc_id", F.col("clean").alias("text"), "n_removed")


def op9_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return passages.deduplicated(docs).select("row.doc_id", F.col("clean").alias("text"), "removed", "n_removed")


def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    rows = quality.judged(table(spark, folder, "documents"))
    return rows.select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents").select("text", "lang"), least=100, best=2000)


def op12_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    kept_back = languages.held_out(F.col("doc_id"))
    model = languages.learned(docs.where(~kept_back))
    rows = languages.predicted(docs.select("doc_id", "text"), model)
    return rows.select("row.doc_id", languages.held_out(F.col("row.doc_id")).alias("held_out"), "lang_pred", "score")


def op13_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    rows = search.searched(table(spark, folder, "documents"), table(spark, folder, "benchmark"), k=10)
    return rows.withColumnsRenamed({"query": "item_id", "id": "doc_id"})


QUERIES = (
    op1_html_extraction,
    op2_embedding_near_dedup,
    op3_sentencepiece,
    op4_pii,
    op5_sharding,
    op6_ngram_jaccard_join,
    op7_mixing,
    op8_line_dedup,
    op9_substring_dedup,
    op10_quality_rules,
    op11_collocations,
    op12_language_id,
    op13_lexical_search,
)

COLLOCATIONS_SQL = """
with texts as (
  select row_number() over () as d, coalesce(lang, 'und') as lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t
  from documents
),
pieces as (
  select d, lang, unnest(string_split_regex(t, '[.,;:!?\\x0A-\\x0D]')) as piece,
         generate_subscripts(string_split_regex(t, '[.,;:!?\\x0A-\\x0D]'), 1) as p
  from texts
),
lists as (
  select lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda w: w <> '') as words from pieces
),
starts as (select lang, words, unnest(range(1, len(words) + 1)) as i from lists),
spans as (select lang, words, i, unnest(range(1, least(5, len(words) - i + 1) + 1)) as k from starts),
phrases as (select lang, array_to_string(words[i : i + k - 1], ' ') as phrase, k, count(*) as f from spans group by all),
sizes as (select lang, cast(sum(f) as bigint) as n from phrases where k = 1 group by lang),
found as (select * from phrases where f >= 100),
parts as (
  select lang, f, unnest(range(1, k)) as m, string_split(phrase, ' ') as words, k from found where k > 2
),
inner_parts as (
  select lang, f, m, words, unnest(range(1, k - m + 2)) as i from parts where m > 1
),
around as (
  select lang, array_to_string(words[i : i + m - 1], ' ') as phrase, max(f) as f from inner_parts group by all
),
kept as (
  select c.lang, c.phrase, c.k, c.f as a from found c left join around u on u.lang = c.lang and u.phrase = c.phrase
  where c.k > 1 and (u.f is null or 100 * u.f < 100 * c.f)
),
cuts as (
  select lang, phrase, a, j, array_to_string(string_split(phrase, ' ')[1 : j], ' ') as h,
         array_to_string(string_split(phrase, ' ')[j + 1 : k], ' ') as t
  from (select *, unnest(range(1, k)) as j from kept)
),
scores as (
  select c.lang, c.phrase, c.a, c.j, x.f as l, y.f as r, s.n,
         cast((1000::hugeint * c.a * s.n) // (x.f::hugeint * y.f) as bigint) as score
  from cuts c join found x on x.lang = c.lang and x.phrase = c.h join found y on y.lang = c.lang and y.phrase = c.t
  join sizes s on s.lang = c.lang
),
lowest as (
  select * from scores qualify row_number() over (partition by lang, phrase order by score, j) = 1
)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score
from lowest qualify rank <= 2000"""

SEARCH_SQL = """
with terms as (
  select doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{80}-\\x{10FFFF}]+')) as term
  from documents
),
tf as (select doc_id, term, count(*) as tf from terms group by all),
lengths as (select doc_id, cast(sum(tf) as bigint) as n from tf group by doc_id),
corpus as (select count(*) as big_n, cast(sum(n) as bigint) as big_l from lengths),
df as (select term, count(*) as df from tf group by term),
asked as (
  select distinct item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{80}-\\x{10FFFF}]+')) as term
  from benchmark
),
weights as (
  select item_id, term, cast(floor(1000 * ln((2 * big_n + 2) / (2 * df + 1))) as bigint) as w
  from asked join df using (term), corpus
),
scores as (
  select item_id, doc_id,
         cast(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * big_n) // big_l)))) as bigint) as score
  from weights join tf using (term) join lengths using (doc_id), corpus group by all
)
select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id) as integer) as rank, doc_id, score
from scores where score > 0 qualify rank <= 10"""


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    return {"op11_collocations": COLLOCATIONS_SQL, "op13_lexical_search": SEARCH_SQL}
