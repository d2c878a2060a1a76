"""The queries of this subpackage, one for each operator and the pipeline, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veinstone.llm import license as licences
from veinstone.llm import langid, lm, mixing, neardup, pieces, pii, quality, vectors, warc
from veinstone.llm.common import crc_mod, new_folder, remove, table, until_exit

#: Where the public vocabularies lie; a parameter of the operator, never part of this repository.
PIECES = "/opt/tokenizers/piece_bpe_32k.model"

WORDS_SQL = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    arc, out = new_folder(spark, "arc"), new_folder(spark, "warc")
    warc.write_arc(table(spark, sf_dir, "pages"), arc)
    until_exit(spark, arc)
    warc.convert(spark, arc, out)
    until_exit(spark, out)
    remove(spark, arc)
    return warc.warc_records(spark, out).select(F.col("order").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to", "digests_agree")


OP1_SQL = """
with p as (select page_id, octet_length(encode(coalesce(html, ''))) as n, sha1(coalesce(html, '')) as h from pages),
r as (select *, max(page_id) over (partition by h) as top from p)
select page_id, n as payload_bytes, h as payload_digest, case when n >= 1000 and page_id < top then 'revisit' else 'response' end as record_type,
  case when n >= 1000 and page_id < top then top end as refers_to, true as digests_agree from r"""


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(table(spark, sf_dir, "documents"), PIECES)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rules, _ = quality.plan(docs, quality.OWN_RULES)
    return quality.judged(docs, rules)


OP3_SQL = rf"""
with split as (select doc_id, coalesce(text, '') as text, {WORDS_SQL} as w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda s: regexp_matches(s, '[^\x20\x09-\x0D]')) as lines from documents),
windows as (select doc_id, p, array_to_string(w[p:p + 4], ' ') as g from (select doc_id, w, unnest(range(1, len(w) - 3)) as p from split)),
twice as (select doc_id, p, count(*) over (partition by doc_id, g) as c from windows),
covered as (select doc_id, count(distinct q) as n from (select doc_id, unnest(range(p, p + 5)) as q from twice where c > 1) group by doc_id),
m as (select s.doc_id, len(w)::bigint as n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::bigint as n_symbols, (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
    coalesce(c.n, 0)::bigint as n_repeat_words, len(lines) as n_lines, length(regexp_replace(text, '\P{{L}}+', '', 'g')) as n_letters
  from split s left join covered c on c.doc_id = s.doc_id)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed,
  not (n_words < 10 or 100 * n_repeat_words > 20 * n_words) and not ({" or ".join(r.sql for r in quality.RULES)}) as kept
from m"""


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classes(table(spark, sf_dir, "documents"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_mod(F.col("doc_id"), 4) == 2
    prototypes = langid.fit(docs, ~held_out)
    return langid.predict(docs, prototypes).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op6_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"), crc_mod(F.col("doc_id"), 7) != 2)


def op7_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mixing.replicate(docs).select("doc_id", "text", "lang", "source", "n_chars", F.round("rate", 9).alias("rate"), "n_copies", "copy")


OP9_SQL = f"""
with counted as ({mixing.duckdb_sql()})
select d.doc_id, d.text, d.lang, d.source, d.n_chars, c.rate, c.n_copies, g.k as copy
from documents d join counted c on c.doc_id = d.doc_id cross join lateral (select unnest(range(1, c.n_copies + 1)) as k) g"""


def op10_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_warc, op2_sentencepiece, op3_quality, op4_near_duplicates, op5_language, op6_lm, op7_license, op8_pii, op9_mixing, op10_embeddings)}


def oracle_sql() -> dict[str, str]:
    return {"op1_warc": OP1_SQL, "op3_quality": OP3_SQL, "op7_license": licences.duckdb_sql(), "op9_mixing": OP9_SQL}
