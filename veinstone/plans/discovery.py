"""Queries over documents, pages, events and conversations: discovery, acquisition, text."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from veinstone.functions import science, text
from veinstone.operators import discovery as ops
from veinstone.operators import evidence, topics
from veinstone.plans.evidence import read

QUERY = ["the", "ation", "heing", "lichen", "de"]
TERMS, PROCESS, MATERIAL, NEGATIVE = ["the", "la"], ["and"], ["en"], ["mit", "y"]
TOPIC = topics.Topic("words", entity_terms=("re", "ion", "le "), negative_terms=("mit",), extras=(("der",), ("que", "los")))
TOK = "list_filter(regexp_extract_all(lower(coalesce({c}, '')), '[a-z0-9]+'), lambda t: length(t) > 1 and t not in (" + ", ".join(f"'{w}'" for w in text.STOPWORDS) + "))"


def docs(spark, sf_dir):
    return read(spark, sf_dir, "documents")


def titled(spark, sf_dir):
    """The first 60 characters as title, the rest of the text as abstract."""
    return docs(spark, sf_dir).select("doc_id", "lang", "source", "n_chars", "text", F.substring("text", 1, 60).alias("title"), F.substring("text", 61, 1 << 30).alias("abstract"))


def tokenise(spark, sf_dir):
    t = titled(spark, sf_dir)
    return t.select("doc_id", F.sha1(F.array_join(text.tokens(F.col("abstract")), " ").cast("binary")).alias("tokens"), F.size(text.tokens(F.col("title"))).cast("long").alias("n_title"))


TOKENISE_SQL = f"select doc_id, sha1(array_to_string({TOK.format(c='substr(text, 61)')}, ' ')) as tokens, len({TOK.format(c='substr(text, 1, 60)')}) as n_title from documents"


def overlap_score(spark, sf_dir):
    need = F.array(*[F.lit(w) for w in ("er", "ation", "der", "os", "le", "er")])
    return titled(spark, sf_dir).select("doc_id", F.round(text.overlap_ratio(need, text.tokens(F.col("abstract"))), 6).alias("ratio"))


OVERLAP_SQL = f"select doc_id, round(len(list_intersect(['er', 'ation', 'der', 'os', 'le'], {TOK.format(c='substr(text, 61)')})) / 5.0, 6) as ratio from documents"


def phrase_overlap(spark, sf_dir):
    return titled(spark, sf_dir).select("doc_id", F.round(text.phrase_overlap(["of the", "er en", "de la", "the of"], F.col("abstract")), 6).alias("share"))


PHRASE_SQL = "select doc_id, round((" + " + ".join(f"contains(lower(substr(text, 61)), '{p}')::int" for p in ("of the", "er en", "de la", "the of")) + ") / 4.0, 6) as share from documents"


def gate():
    return ops.relevance_gate(F.col("title"), F.col("abstract"), TERMS, PROCESS, MATERIAL)


def scored(spark, sf_dir):
    d = titled(spark, sf_dir).withColumn("gate", gate())
    weight = F.when(F.col("source") == "src0", 0.9).when(F.col("source") == "src1", 0.85).otherwise(0.55)
    penalty = ops.negative_penalty(F.col("title"), F.col("abstract"), NEGATIVE, TERMS, MATERIAL)
    boost = TOPIC.boost(F.col("title"), F.col("abstract"))
    score = ops.discovery_score(F.col("title"), F.col("abstract"), ["er", "ation", "der", "le"], ["os", "en"], ["que", "th"], ["de la", "th of"], weight, F.lit(0.8), boost, penalty, F.col("gate.ok"))
    return d.withColumn("score", score).withColumn("selection_reason", ops.selection_label(F.col("score"), 0.2, F.col("gate.ok")))


def _ov(words, cols):
    words = list(dict.fromkeys(words))
    return f"(case when len({cols}) > 0 then len(list_intersect([{', '.join(repr(w) for w in words)}], {cols})) / {len(words)}.0::double else 0 end)"


def _has(words):
    return f"regexp_matches(w, '(^|[^\\p{{L}}\\p{{N}}_])({'|'.join(words)})([^\\p{{L}}\\p{{N}}_]|$)')"


def _holds(terms):
    return "(" + " or ".join(f"contains(w, '{t}')" for t in terms) + ")"


T, A = TOK.format(c="title"), TOK.format(c="abstract")
HITS = " + ".join(f"contains(w, '{t}')::int" for t in TOPIC.entity_terms)
SCORED_SQL = f"""
with d as (select doc_id, lang, source, n_chars, substr(text, 1, 60) as title, substr(text, 61) as abstract from documents),
w as (select *, {T} as t, {A} as a, lower(title || ' ' || abstract) as w from d),
g as (select *, {_has(TERMS)} as anchor, {_has(MATERIAL + PROCESS)} as other, {_has(MATERIAL)} as process, {_has(NEGATIVE)} as negative, {HITS} as hits from w),
s as (select *, anchor and other as gate, concat_ws(',', case when not anchor then 'missing_silicide_term' end, case when not other then 'missing_material_or_process_term' end) as gate_reasons,
  round_even(0.34 * {_ov(['er', 'ation', 'der', 'le'], 't')} + 0.22 * {_ov(['er', 'ation', 'der', 'le'], 'a')} + 0.16 * {_ov(['os', 'en'], '(t || a)')} + 0.14 * {_ov(['que', 'th'], '(t || a)')}
  + 0.08 * ((contains(w, 'de la')::int + contains(w, 'th of')::int) / 2.0) + 0.08 * case source when 'src0' then 0.9 when 'src1' then 0.85 else 0.55 end + 0.06 * 0.8
  + least(0.12 * hits, 0.45) + {' + '.join(f"case when {_holds(x)} then 0.08 else 0 end" for x in TOPIC.extras)} - case when {_holds(TOPIC.negative_terms)} and hits = 0 then 0.28 else 0 end
  - case when negative and not (anchor and process) then 0.18 else 0 end - case when anchor and other then 0 else 0.35 end::double, 6) as score from g),
r as (select *, case when not gate then 'drop:relevance_gate' when score < 0.2 then 'drop:min_discovery_score' else 'keep' end as selection_reason from s)"""


def score_out(df):
    return df.withColumn("score", F.round(F.col("score") + 1e-9, 5))


def discovery_score(spark, sf_dir):
    return score_out(scored(spark, sf_dir)).select("doc_id", "score")


def relevance_gate(spark, sf_dir):
    return titled(spark, sf_dir).withColumn("g", gate()).groupBy("source", F.col("g.ok").alias("gate"), F.col("g.reasons").alias("gate_reasons")).agg(F.count(F.lit(1)).alias("n"))


def selection_label(spark, sf_dir):
    return scored(spark, sf_dir).select("doc_id", "selection_reason")


def ranked(spark, sf_dir):
    return scored(spark, sf_dir).where("selection_reason = 'keep'").withColumn("s", F.round(F.col("score") + 1e-9, 4))


def provider_cap(spark, sf_dir):
    return ops.per_group_cap(ranked(spark, sf_dir), "source", [F.desc("s"), F.asc("doc_id")], 3).select("doc_id", "source", "group_rank")


def topk_rank(spark, sf_dir):
    return ranked(spark, sf_dir).orderBy(F.desc("s"), F.desc_nulls_last("n_chars"), "doc_id").limit(25).select("doc_id", "s", "n_chars")


def english_first(spark, sf_dir):
    return docs(spark, sf_dir).orderBy(F.when(F.col("lang") == "en", 0).otherwise(1), F.desc("n_chars"), "doc_id").limit(40).select("doc_id", "lang", "n_chars")


def dedupe_keyed(spark, sf_dir):
    d = titled(spark, sf_dir).withColumn("whole", F.sha2("text", 256)).drop("text", "abstract")
    out = ops.dedupe_best(d, F.col("whole"), F.struct(F.when(F.col("source") == "src0", 1).otherwise(0).alias("a"), F.col("n_chars").alias("b")), "doc_id")
    return out.select("doc_id", text.article_key(F.lit(None).cast("string"), F.lit(""), F.col("title")).alias("article_key"))


DEDUPE_SQL = """with d as (select doc_id, source, n_chars, substr(text, 1, 60) as title, text from documents),
r as (select *, row_number() over (partition by text order by (source = 'src0')::int desc, n_chars desc, doc_id) as rn from d)
select doc_id, substr(sha1(trim(title, ' ')), 1, 16) as article_key from r where rn = 1"""


def dedupe_normalised_title(spark, sf_dir):
    d = docs(spark, sf_dir).select("doc_id", "n_chars", F.sha1(text.title_key(F.col("text")).cast("binary")).alias("title_key"))
    return evidence.keep_one(d, ["title_key"], [F.desc("n_chars"), F.asc("doc_id")]).select("doc_id", "title_key")


TITLE_SQL = """with d as (select doc_id, n_chars, sha1(regexp_replace(lower(text), '[^\\p{L}\\p{N}_]+', '', 'g')) as title_key from documents)
select doc_id, title_key from (select *, row_number() over (partition by title_key order by n_chars desc, doc_id) as rn from d) where rn = 1"""


def dedupe_year_cluster(spark, sf_dir):
    """Documents of one language and about one length as records of one title."""
    year = F.when(F.col("n_chars") % 40 > 0, (1990 + F.pmod("n_chars", F.lit(30))).cast("int"))
    d = docs(spark, sf_dir).select("doc_id", F.concat_ws("|", "lang", F.floor(F.col("n_chars") / 100)).alias("title"), year.alias("year"))
    return ops.dedupe_years(d, "title", "year").groupBy("title", "cluster").agg(F.count(F.lit(1)).alias("n"), F.min("year").alias("low"), F.max("year").alias("high"))


YEAR_SQL = """with recursive d as (select concat_ws('|', lang, n_chars // 100) as title, case when n_chars % 40 > 0 then 1990 + n_chars % 30 end::int as year from documents),
y as (select title, year, row_number() over (partition by title order by year) as i from (select distinct title, year from d where year is not null)),
c as (select title, year, i, year as anchor, 0 as cluster from y where i = 1 union all
  select y.title, y.year, y.i, case when y.year - c.anchor > 1 then y.year else c.anchor end, case when y.year - c.anchor > 1 then c.cluster + 1 else c.cluster end from c join y on y.title = c.title and y.i = c.i + 1),
o as (select title, bool_or(year is null) as open from d group by 1)
select d.title, case when open then 0 else c.cluster end::int as cluster, count(*) as n, min(d.year) as low, max(d.year) as high from d join o using (title) left join c on c.title = d.title and c.year = d.year group by 1, 2"""


def saturation_stop(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    return ops.saturation(e, "event_type", "event_id", "value", 5, 3.0, 8).select("event_id", F.round(F.col("rolling_mean") + 1e-9, 5).alias("rolling_mean"), "stop", "kept")


SATURATION_SQL = """with r as (select event_id, event_type, row_number() over w as n, avg(value) over (partition by event_type order by event_id rows between 4 preceding and current row) as m from events window w as (partition by event_type order by event_id)),
s as (select *, n >= 8 and round(m, 9) < 3.0 as stop from r)
select event_id, round(m + 1e-9, 5) as rolling_mean, stop, not coalesce(bool_or(stop) over (partition by event_type order by event_id rows between unbounded preceding and 1 preceding), false) as kept from s"""


def eligibility(spark, sf_dir):
    return docs(spark, sf_dir).where((F.col("lang").isin("en", "de")) & (F.trim(text.blank(F.col("source"))) != "")).groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars"))


def pages(spark, sf_dir):
    return read(spark, sf_dir, "pages")


def url_quality(spark, sf_dir):
    return pages(spark, sf_dir).select("page_id", science.url_quality(F.col("url")).alias("quality"), science.fulltext_mime(F.lit("application/octet-stream"), F.col("url")).alias("fulltext"))


URL_SQL = """select page_id, case when trim(u) = '' then 0 when ends_with(trim(u), '.pdf') then 1 when ends_with(trim(u), '.xml') or contains(u, 'format=xml') then 0.9 when ends_with(trim(u), '.txt') or ends_with(trim(u), '.html') then 0.8 when contains(u, 'doi.org') then 0.55 else 0.65 end::double as quality,
  regexp_matches(u, '\\.(pdf|xml|html?|txt)([?#].*)?$') as fulltext from (select page_id, lower(coalesce(url, '')) as u from pages)"""


def mime_predicate(spark, sf_dir):
    mime = F.element_at(F.array(F.lit("application/json"), F.lit("text/plain"), F.lit("application/pdf"), F.lit("")), (F.pmod("page_id", F.lit(4)) + 1).cast("int"))
    return pages(spark, sf_dir).groupBy(mime.alias("mime"), science.fulltext_mime(mime, F.col("url")).alias("ok")).agg(F.count(F.lit(1)).alias("n"))


MIME_SQL = """select ['application/json', 'text/plain', 'application/pdf', ''][page_id % 4 + 1] as mime,
  case page_id % 4 when 0 then false when 1 then true when 2 then true else regexp_matches(lower(url), '\\.(pdf|xml|html?|txt)([?#].*)?$') end as ok, count(*) as n from pages group by all"""


def url_plan(spark, sf_dir):
    own = ops.url_candidates(F.col("url"), F.regexp_replace("url", "[?#].*$", ""), listed=F.array(F.regexp_extract("html", 'href="([^"]+)"', 1)))
    return pages(spark, sf_dir).select("page_id", F.posexplode(own).alias("candidate_rank", "candidate_url"))


URLPLAN_SQL = """with c as (select page_id, [trim(coalesce(url, '')), trim(regexp_extract(html, 'href="([^"]+)"', 1)), trim(regexp_replace(url, '[?#].*$', ''))] as u from pages),
f as (select page_id, list_filter(u, lambda x: regexp_matches(x, '^(https?://|file:|/)')) as u from c),
e as (select page_id, unnest(u) as x, generate_subscripts(u, 1) as i from f), k as (select page_id, x, min(i) as i from e group by all)
select page_id, (row_number() over (partition by page_id order by i) - 1)::int as candidate_rank, x as candidate_url from k"""


def html_text(spark, sf_dir):
    t = text.strip_html(F.col("html"))
    return pages(spark, sf_dir).select("page_id", F.sha2(t, 256).alias("digest"), F.length(t).alias("n"))


HTML = r"trim(regexp_replace(regexp_replace(coalesce(html, ''), '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g'))"
HTML_SQL = f"select page_id, sha256({HTML}) as digest, length({HTML}) as n from pages"


def doc_quality_gate(spark, sf_dir):
    status = F.when(F.col("page_id") % 11 == 0, "fetch_failed").when(F.col("page_id") % 7 == 0, "stored_binary").otherwise("parsed_html")
    return pages(spark, sf_dir).groupBy(ops.document_quality(status, F.lit("text/html"), text.strip_html(F.col("html")), 2000).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


GATE_SQL = f"select case when page_id % 11 = 0 then 'fetch_failed' when page_id % 7 = 0 then 'unsupported_parse_status' when length({HTML}) < 2000 then 'short_text<2000' else 'usable' end as reason, count(*) as n from pages group by 1"


def content_hash(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", F.sha2("text", 256).alias("content_hash"))


def stable_ids(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", text.stable_id(F.col("source"), F.col("lang"), F.col("doc_id")).alias("id"))


def sentence_windows(spark, sf_dir):
    s = text.sentences(F.col("text"))
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", s.alias("s")).where(F.size("s") > 0)
    w = rows.select("conv_id", "turn", "s", F.posexplode("s").alias("i", "sentence"))
    return w.select("conv_id", "turn", "i", F.sha1(text.window_text(F.col("s"), F.col("i"), 1).cast("binary")).alias("window"))


SENT = "list_filter(string_split(regexp_replace(regexp_replace(coalesce(text, ''), '[\\r\\n]+', ' ', 'g'), '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)), lambda s: trim(s) <> '')"
WINDOWS_SQL = f"""with s as (select conv_id, turn, {SENT} as s from conversations), e as (select conv_id, turn, s, unnest(range(len(s)))::int as i from s)
select conv_id, turn, i, sha1(array_to_string(s[greatest(i, 1):least(i + 2, len(s))], ' ')) as "window" from e"""


def chunk_sentences(spark, sf_dir):
    d = docs(spark, sf_dir).select("doc_id", text.sentences(F.col("text")).alias("s"))
    return ops.chunk_sentences(d, "doc_id", "s", 384, 96).select("doc_id", "chunk_index", "n_words", F.sha1(F.col("chunk").cast("binary")).alias("digest"))


def regex_extract_numbers(spark, sf_dir):
    hits = F.regexp_extract_all("text", F.lit(r"([0-9]+(?:\.[0-9]+)?)"), F.lit(1))
    return docs(spark, sf_dir).select("doc_id", hits.alias("h")).where(F.size("h") > 0).select("doc_id", F.size("h").cast("long").alias("n"), F.array_join("h", ",").alias("numbers"))


NUMBERS_SQL = "select doc_id, len(h) as n, array_to_string(h, ',') as numbers from (select doc_id, regexp_extract_all(text, '([0-9]+(?:\\.[0-9]+)?)', 1) as h from documents) where len(h) > 0"


def unit_normalise(spark, sf_dir):
    unit = F.element_at(F.array(*[F.lit(u) for u in ("nm", "μ m", "mm", "K", "furlong")]), (F.pmod(F.substring("p_brand", 7, 2).try_cast("int"), F.lit(5)) + 1).cast("int"))
    v = science.normalise_value(F.col("p_size").cast("double"), unit, "nm")
    return read(spark, sf_dir, "part").select("p_partkey", v.alias("v")).select("p_partkey", F.round("v.value", 6).alias("value"), F.col("v.unit").alias("unit"))


UNIT_SQL = """select p_partkey, round(case u when 1 then p_size * 1000.0 when 2 then p_size * 1000000.0 else p_size end::double, 6) as value, case u when 3 then 'k' when 4 then 'furlong' else 'nm' end as unit
from (select *, substr(p_brand, 7, 2)::int % 5 as u from part)"""


def entity_alias_longest(spark, sf_dir):
    aliases = {"red": "red", "small red": "small-red", "ring": "ring", "red ring": "red-ring", "widget": "widget"}
    hit = F.coalesce(*[F.when(F.col("p_name").rlike(rf"\b{a}\b"), F.lit(e)) for a, e in sorted(aliases.items(), key=lambda x: (-len(x[0]), x[0]))], F.lit("unknown"))
    return read(spark, sf_dir, "part").groupBy(hit.alias("entity")).agg(F.count(F.lit(1)).alias("n"))


ALIAS_SQL = "select case when regexp_matches(p_name, '\\bsmall red\\b') then 'small-red' when regexp_matches(p_name, '\\bred ring\\b') then 'red-ring' when regexp_matches(p_name, '\\bwidget\\b') then 'widget' when regexp_matches(p_name, '\\bring\\b') then 'ring' when regexp_matches(p_name, '\\bred\\b') then 'red' else 'unknown' end as entity, count(*) as n from part group by 1"


def json_props(spark, sf_dir):
    return read(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"), F.size(F.from_json("props", "map<string,string>", {"allowSingleQuotes": "false"})).cast("long").alias("n_keys"))


def heading_carry_forward(spark, sf_dir):
    c = read(spark, sf_dir, "conversations")
    return ops.carry_forward(c, "conv_id", "turn", F.when(F.col("role") == "user", F.sha1(F.col("text").cast("binary")))).select("conv_id", "turn", "heading")


def nation_lookup(spark, sf_dir):
    c, n = read(spark, sf_dir, "customer"), read(spark, sf_dir, "nation")
    return c.join(n.where("n_nationkey % 3 > 0"), F.col("c_nationkey") == F.col("n_nationkey"), "left").select("c_custkey", F.coalesce(F.nullif("n_name", F.lit("")), "c_mktsegment").alias("entity"))


def semi_filter(spark, sf_dir):
    c, o = read(spark, sf_dir, "customer"), read(spark, sf_dir, "orders").where("o_totalprice > 400000")
    return c.join(o, F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey")


def anti_filter(spark, sf_dir):
    c, o = read(spark, sf_dir, "customer"), read(spark, sf_dir, "orders").where("o_totalprice > 100000")
    return c.join(o, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


def read_through_cache(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    cache = o.where("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("cache_key"), F.col("o_orderdate").alias("expires_at"), F.col("o_totalprice").alias("payload"))
    hits, misses = ops.read_through(o.select(F.col("o_orderkey").alias("cache_key")), cache, F.lit("1998-01-01").cast("timestamp"))
    return hits.select("cache_key", F.lit("hit").alias("kind")).union(misses.select("cache_key", F.lit("miss").alias("kind")))


def union_mode(spark, sf_dir):
    a = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.lit("local").alias("provider"), F.col("c_mktsegment").alias("venue"))
    b = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.lit("online").alias("provider"))
    return evidence.keep_one(a.unionByName(b, allowMissingColumns=True), ["id"], [F.desc("provider")])


def doping_context(spark, sf_dir):
    t = F.concat_ws(" ", "p_name", F.when(F.col("p_size") % 3 == 0, F.lit("doped")).when(F.col("p_size") % 3 == 1, F.lit("without doping")).otherwise(F.lit("")), F.when(F.col("p_size") % 2 == 0, F.lit("Si(100)")).otherwise(F.lit("")))
    score = science.context_score(F.col("p_type"), science.orientation(t), science.doping_state(t), F.lit(""), F.col("p_size") > 25)
    return read(spark, sf_dir, "part").select("p_partkey", science.orientation(t).alias("orientation"), science.doping_state(t).alias("doping_state"), F.round(score, 6).alias("score"))


DOPING_SQL = """select p_partkey, case when p_size % 2 = 0 then '(100)' else '' end as orientation, case p_size % 3 when 0 then 'doped' when 1 then 'undoped' else '' end as doping_state,
  round(0.30 + case when p_size % 2 = 0 then 0.25 else 0 end + case when p_size % 3 < 2 then 0.20 else 0 end + case when p_size > 25 then 0.05 else 0 end, 6)::double as score from part"""


def inverted_index(spark, sf_dir):
    """Whole texts rebuilt from word positions."""
    d = docs(spark, sf_dir).select("doc_id", F.split("text", " ").alias("w"))
    placed = d.select("doc_id", F.posexplode("w").alias("p", "w")).groupBy("doc_id", "w").agg(F.collect_list("p").alias("ps")).groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("w", "ps"))).alias("index"))
    return placed.select("doc_id", F.sha1(text.inverted_index_text(F.col("index")).cast("binary")).alias("abstract"))


def query_expansion(spark, sf_dir):
    """The queries of the topic of nickel silicides for each part type as keywords."""
    types = read(spark, sf_dir, "part").select("p_type").distinct().orderBy("p_type").collect()  # a handful of types
    rows = [(r["p_type"], k, q) for r in types for k, q in enumerate(topics.expand_queries("NiSi  growth", ["of", r["p_type"].lower(), "thin film growth"], ["extra one"], topics.load("Ni-Silicide")))]
    return spark.createDataFrame(rows, "p_type string, rank int, query string")


EXPANSION_SQL = """with t as (select distinct p_type, lower(p_type) as k from part),
q as (select p_type, ['NiSi growth', 'nickel silicide phase formation thin film annealing', 'Ni2Si NiSi NiSi2 thickness temperature', 'nickel film silicon reaction temperature phase sequence', 'Ni silicide transformation temperature thickness dependence',
  'of ' || k || ' thin film growth', 'extra one', k || ' thin film growth'] as qs from t)
select p_type, unnest(range(8))::int as rank, unnest(qs) as query from q"""


def eligible_documents(spark, sf_dir):
    d = docs(spark, sf_dir)
    ok = ops.eligible(F.col("source") != "src2", F.when(F.col("n_chars") % 3 == 0, "preprint").when(F.col("n_chars") % 3 == 1, "").otherwise("book"), F.col("lang"), languages=("en", "de"))
    return d.where(ok).groupBy("lang").agg(F.count(F.lit(1)).alias("n"))


def dedupe_quality(spark, sf_dir):
    """Of documents with one text the best record by quality, ties by the least id."""
    d = docs(spark, sf_dir).select("doc_id", F.sha2("text", 256).alias("key"), F.lit("t").alias("title"), F.lit("").alias("abstract"), F.col("lang").alias("language"), F.lit("").alias("venue"), F.lit("").alias("doi"), F.when(F.col("doc_id") % 2 == 0, "u").alias("oa_url"), F.col("source").alias("license"), F.when(F.col("doc_id") % 3 == 0, "openalex").otherwise("arxiv").alias("provider"), (F.col("doc_id") % 5).cast("int").alias("year"))
    return ops.dedupe_best(d, F.col("key"), ops.dedupe_quality(d), "doc_id").select("doc_id", "key")


QUALITY_SQL = """with d as (select doc_id, sha256(text) as key, (coalesce(trim(lang), '') <> '')::int + (coalesce(trim(source), '') <> '')::int + (doc_id % 2 = 0)::int as b, doc_id % 2 = 0 as c, doc_id % 3 = 0 as d, doc_id % 5 as e from documents)
select doc_id, key from (select *, row_number() over (partition by key order by b desc, c desc, d desc, e desc, doc_id) as rn from d) where rn = 1"""


def provider_urls(spark, sf_dir):
    p = pages(spark, sf_dir)
    raw = F.format_string('{"best_oa_location": {"pdf_url": "%s", "landing_page_url": null}, "open_access": {"oa_url": "https://api.openalex.org/works/W%d"}, "locations": [{"pdf_url": "https://h/%d.pdf"}]}', "url", "page_id", "page_id")
    own = ops.url_candidates(F.lit("https://first/"), F.col("url"), listed=ops.provider_urls(F.when(F.col("page_id") % 2 == 0, "openalex").otherwise("arxiv"), raw))
    return p.select("page_id", F.posexplode(own).alias("candidate_rank", "candidate_url"))


PROVIDER_SQL = """with c as (select page_id, case when page_id % 2 = 0 then ['https://first/', trim(url), 'https://h/' || page_id || '.pdf'] else ['https://first/', trim(url)] end as u from pages)
select page_id, unnest(range(len(u)))::int as candidate_rank, unnest(u) as candidate_url from c"""


REGISTRY = {
    "tokenise": (tokenise, TOKENISE_SQL),
    "overlap_score": (overlap_score, OVERLAP_SQL),
    "phrase_overlap": (phrase_overlap, PHRASE_SQL),
    "discovery_score": (discovery_score, SCORED_SQL + " select doc_id, round(score + 1e-9, 5) as score from r"),
    "relevance_gate": (relevance_gate, SCORED_SQL + " select source, gate, gate_reasons, count(*) as n from r group by all"),
    "selection_label": (selection_label, SCORED_SQL + " select doc_id, selection_reason from r"),
    "provider_cap": (provider_cap, SCORED_SQL + " select doc_id, source, rn::int as group_rank from (select *, row_number() over (partition by source order by round(score + 1e-9, 4) desc, doc_id) as rn from r where selection_reason = 'keep') where rn <= 3"),
    "topk_rank": (topk_rank, SCORED_SQL + " select doc_id, round(score + 1e-9, 4) as s, n_chars from r where selection_reason = 'keep' order by 2 desc, n_chars desc nulls last, doc_id limit 25"),
    "english_first": (english_first, "select doc_id, lang, n_chars from documents order by (lang = 'en') desc, n_chars desc, doc_id limit 40"),
    "dedupe_keyed": (dedupe_keyed, DEDUPE_SQL),
    "dedupe_normalised_title": (dedupe_normalised_title, TITLE_SQL),
    "dedupe_year_cluster": (dedupe_year_cluster, YEAR_SQL),
    "saturation_stop": (saturation_stop, SATURATION_SQL),
    "eligibility": (eligibility, "select lang, count(*) as n, sum(n_chars)::bigint as chars from documents where lang in ('en', 'de') and trim(source) <> '' group by 1"),
    "url_quality": (url_quality, URL_SQL),
    "mime_predicate": (mime_predicate, MIME_SQL),
    "url_plan": (url_plan, URLPLAN_SQL),
    "html_text": (html_text, HTML_SQL),
    "doc_quality_gate": (doc_quality_gate, GATE_SQL),
    "content_hash": (content_hash, "select doc_id, sha256(text) as content_hash from documents"),
    "stable_ids": (stable_ids, "select doc_id, substr(sha1(source || '|' || lang || '|' || doc_id), 1, 20) as id from documents"),
    "sentence_windows": (sentence_windows, WINDOWS_SQL),
    "chunk_sentences": (chunk_sentences, None),
    "regex_extract_numbers": (regex_extract_numbers, NUMBERS_SQL),
    "unit_normalise": (unit_normalise, UNIT_SQL),
    "entity_alias_longest": (entity_alias_longest, ALIAS_SQL),
    "json_props": (json_props, "select event_id, json_extract_string(props, '$.k')::bigint as k, len(json_keys(props))::bigint as n_keys from events"),
    "heading_carry_forward": (heading_carry_forward, "select conv_id, turn, last_value(case when role = 'user' then sha1(text) end ignore nulls) over (partition by conv_id order by turn rows unbounded preceding) as heading from conversations"),
    "nation_lookup": (nation_lookup, "select c_custkey, coalesce(n_name, c_mktsegment) as entity from customer left join (select * from nation where n_nationkey % 3 > 0) on c_nationkey = n_nationkey"),
    "semi_filter": (semi_filter, "select c_custkey from customer where c_custkey in (select o_custkey from orders where o_totalprice > 400000)"),
    "anti_filter": (anti_filter, "select c_custkey from customer where c_custkey not in (select o_custkey from orders where o_totalprice > 100000)"),
    "read_through_cache": (read_through_cache, "select o_orderkey as cache_key, case when o_orderkey % 2 = 0 and o_orderdate > timestamp '1998-01-01' then 'hit' else 'miss' end as kind from orders"),
    "union_mode": (union_mode, "select s_suppkey as id, 'online' as provider, null::varchar as venue from supplier union all select c_custkey, 'local', c_mktsegment from customer where c_custkey not in (select s_suppkey from supplier)"),
    "doping_context": (doping_context, DOPING_SQL),
    "inverted_index": (inverted_index, "select doc_id, sha1(text) as abstract from documents"),
    "query_expansion": (query_expansion, EXPANSION_SQL),
    "eligible_documents": (eligible_documents, "select lang, count(*) as n from documents where source <> 'src2' and n_chars % 3 < 2 and lang in ('en', 'de') group by 1"),
    "dedupe_quality": (dedupe_quality, QUALITY_SQL),
    "provider_urls": (provider_urls, PROVIDER_SQL),
}
