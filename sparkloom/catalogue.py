"""All queries of the engine's own operators, with the DuckDB SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkloom.functions import fixed as X
from sparkloom.functions import text as T
from sparkloom.functions import udf as U
from sparkloom.operators import chat, clean, dedup, evaluate, label, sample, store, tokenize
from sparkloom.plans import stages
from sparkloom.sources import readers

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query by its function's name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents")


def _sql_hits(column: str, found: list[str]) -> str:
    return " + ".join(f"contains({column}, '{w}')::int" for w in found)


def _sql_any(column: str, patterns: list[str], options: str) -> str:
    return " or ".join(f"regexp_matches({column}, '{p}', '{options}')" for p in patterns)


STRIPPED = r"length(regexp_replace(text, '^\s+|\s+$', '', 'g'))"
SQL_WORDS = r"list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '')"
SQL_REASON = f"case when coalesce(text, '') = '' then 'empty_text' when {STRIPPED} < 50 or length(text) > 100000 then 'validation_failed' when length(text) < 50 then 'length_filtered' end"


# --- cleaning ------------------------------------------------------------------------------------------------------
@query(f"select case when reason is null then 'success' else 'filtered' end as status, coalesce(reason, 'none') as reason, count(*) as n from (select {SQL_REASON} as reason from documents) group by 1, 2")
def clean_status_counts(spark, sf_dir):
    """Outcome of the cleaner's rules on the raw texts (both languages it knows are allowed); text_clean also rewrites them."""
    return clean.statuses(text_of(spark, sf_dir)).groupBy("status", F.coalesce("reason", F.lit("none")).alias("reason")).agg(F.count("*").alias("n"))


@query()
def text_clean(spark, sf_dir):
    out = clean.clean(text_of(spark, sf_dir))
    return out.select("doc_id", "status", "reason", "content", "cleaning_steps", F.col("metadata.length").alias("length"), F.col("metadata.word_count").alias("word_count"))


@query(f"select count(*) as total, count(*) filter (reason is null) as success, count(*) filter (reason is not null) as filtered, 0::bigint as failed, round(count(*) filter (reason is null) / count(*), 6) as success_rate, round(count(*) filter (reason is not null) / count(*), 6) as filter_rate from (select {SQL_REASON} as reason from documents)")
def clean_batch_stats(spark, sf_dir):
    out = clean.batch_stats(clean.statuses(text_of(spark, sf_dir)))
    return out.withColumns({c: F.round(c, 6) for c in ("success_rate", "filter_rate")})


@query(f"select doc_id, coalesce({STRIPPED} >= 10, false) and doc_id is not null as valid from documents")
def raw_item_validity(spark, sf_dir):
    return clean.raw_validity(text_of(spark, sf_dir)).select("doc_id", "valid")


@query("select doc_id, sha256(text) as content_hash from documents")
def content_hash(spark, sf_dir):
    return text_of(spark, sf_dir).select("doc_id", F.sha2("text", 256).alias("content_hash"))


@query("select case when regexp_matches(text, '[一-鿿]') then 'zh' else 'en' end as by_presence, count(*) as n from documents group by 1")
def language_heuristic(spark, sf_dir):
    return text_of(spark, sf_dir).groupBy(T.language_by_presence(F.col("text")).alias("by_presence")).agg(F.count("*").alias("n"))


def _unicode_edges(pattern: str) -> str:
    """A pattern whose word edges know letters beyond ASCII, as Spark's do; for tests of presence."""
    if not pattern.startswith(r"\b"):
        return pattern
    return r"(?:^|[^\p{L}\p{N}\p{M}_])" + pattern[2:-2] + r"(?:$|[^\p{L}\p{N}\p{M}_])"


_EDU = "0.5 + case when length(text) > 1000 then 0.1 else 0.0 end" + "".join(f" + case when regexp_matches(text, '{_unicode_edges(p)}') then 0.05 else 0.0 end" for p in X.TECHNICAL) + "".join(f" - case when regexp_matches(lower(text), '{_unicode_edges(p)}') then 0.1 else 0.0 end" for p in X.INFORMAL)


@query(f"select doc_id, round(least(1.0, greatest(0.0, ({_EDU})::double)), 6) as education from documents")
def education_score(spark, sf_dir):
    return text_of(spark, sf_dir).select("doc_id", F.round(T.education(F.col("text")), 6).alias("education"))


@query()
def char_and_word_runs(spark, sf_dir):
    return text_of(spark, sf_dir).select("doc_id", U.cut_word_runs(T.cut_char_runs(F.col("text"))).alias("text"))


@query(r"select doc_id, regexp_replace(regexp_replace(regexp_replace(text, '\s+', ' ', 'g'), '[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x{9f}]', '', 'g'), '^\s+|\s+$', '', 'g') as text from documents")
def whitespace_control(spark, sf_dir):
    return text_of(spark, sf_dir).select("doc_id", T.collapse_space(F.col("text")).alias("text"))


@query(r"select page_id, length(regexp_replace(html, '<[^>]+>', '', 'g')) as n_chars, sha256(regexp_replace(html, '<[^>]+>', '', 'g')) as h from pages")
def html_strip(spark, sf_dir):
    bare = T.strip_tags(F.col("html"))
    return read(spark, sf_dir, "pages").select("page_id", F.length(bare).alias("n_chars"), F.sha2(bare, 256).alias("h"))


@query("select page_id, unnest(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1)) as link from pages")
def page_links(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), 1)).alias("link"))


@query()
def pipeline_stage_counts(spark, sf_dir):
    _, traced = stages.default_pipeline().run(text_of(spark, sf_dir))
    return stages.stage_counts(traced)


# --- quality, safety, toxicity -------------------------------------------------------------------------------------
_W = f"select doc_id, text, lower(text) as low, {SQL_WORDS} as w from documents"
_VARIETY = "coalesce(len(list_distinct(w)) / nullif(len(w), 0), 0)"
_LOWVAR = "coalesce(len(list_distinct(list_transform(w, lambda x: lower(x)))) / nullif(len(w), 0), 0)"
_F = f"least(1.0, greatest(0.0, (0.5::double + case when contains(text, '.') then 0.2 else 0.0 end + case when contains(text, ',') or contains(text, '，') then 0.1 else 0.0 end + case when regexp_matches(text, '\\p{{Lu}}') then 0.1 else 0.0 end) * case when len(w) > 0 then 0.5 + 0.5 * {_VARIETY} else 1.0 end))"
_D = f"case when len(w) > 0 then 0.6::double * {_LOWVAR} + 0.4 * least(length(array_to_string(w, '')) / len(w) / 10, 1.0) else 0.0 end"
_E = f"least(1.0, greatest(0.0, 0.5::double + 0.05 * ({_sql_hits('low', X.ACADEMIC)}) + case when len(regexp_extract_all(text, '\\d+')) > 3 then 0.1 else 0.0 end + case when contains(text, '{X.CITATION_ZH}') or contains(low, '{X.CITATION_EN}') then 0.1 else 0.0 end))"
_SCORES = f"select doc_id, case when text = '' then 0.0 else {_F} end as f, case when text = '' then 0.0 else {_D} end as d, case when text = '' then 0.0 else {_E} end as e from ({_W})"


@query(f"select doc_id, round(f, 6) as fluency, round(d, 6) as density, round(e, 6) as education, round(0.3::double * f + 0.3::double * d + 0.4::double * e, 6) as overall from ({_SCORES})")
def text_quality_scores(spark, sf_dir):
    return T.with_words(text_of(spark, sf_dir)).select("doc_id", *[F.round(v, 6).alias(k) for k, v in T.filter_scores(F.col("text")).items()])


@query(f"select case when 0.3::double * f + 0.3::double * d + 0.4::double * e < 0.5 then 'filtered' else 'success' end as status, count(*) as n from ({_SCORES}) group by 1")
def quality_gate_counts(spark, sf_dir):
    return T.with_words(text_of(spark, sf_dir)).groupBy(F.when(T.filter_scores(F.col("text"))["overall"] < X.QUALITY_GATE, "filtered").otherwise("success").alias("status")).agg(F.count("*").alias("n"))


_S = r"list_filter(list_transform(regexp_split_to_array(text, '[。！？.!?]'), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '')"
_STOP = ", ".join(f"'{w}'" for w in X.STOPWORDS)
_DIMS = f"""select doc_id,
 case when text = '' or len(s) = 0 then 0.0 else case when length(array_to_string(s, '')) / len(s) < 5 then 0.7::double else 1.0::double end * case when regexp_matches(text, '[。！？.!?]') then 1.0::double else 0.8::double end * case when len(w) > 0 then 0.5 + 0.5 * {_VARIETY} else 1.0 end end as a,
 case when text = '' then 0.0 else least(1.0, 0.5::double + ({_sql_hits('low', X.TOPIC)}) * 0.1) end as b,
 case when text = '' then 0.0 else least(1.0, 0.6::double + ({_sql_hits('low', X.CONNECTORS)}) * 0.05) end as c,
 case when text = '' or len(w) = 0 then 0.0 else 0.4::double * {_LOWVAR} + 0.6 * (len(list_filter(list_transform(w, lambda x: lower(x)), lambda x: x not in ({_STOP}))) / len(w)) end as d,
 case when text = '' then 0.0 else pow(0.5::double, {_sql_hits('low', X.SENSITIVE)}) end as e
 from (select *, {_S} as s from ({_W}))"""


@query(f"select doc_id, round(a, 6) as fluency, round(b, 6) as relevance, round(c, 6) as coherence, round(d, 6) as informativeness, round(e, 6) as safety, round((a + b + c + d + e) / 5, 6) as overall, case when (a + b + c + d + e) / 5 >= 0.6 then 'completed' else 'needs_review' end as label_status from ({_DIMS})")
def scorer_dimensions(spark, sf_dir):
    out = label.quality(text_of(spark, sf_dir))
    return out.withColumns({c: F.round(c, 6) for c, t in out.dtypes if t == "double"})


@query(f"select label_status, count(*) as n, round(avg(o), 6) as avg_confidence from (select (a + b + c + d + e) / 5 as o, case when (a + b + c + d + e) / 5 >= 0.6 then 'completed' else 'needs_review' end as label_status from ({_DIMS})) group by 1")
def labeling_stats(spark, sf_dir):
    return label.quality(text_of(spark, sf_dir)).groupBy("label_status").agg(F.count("*").alias("n"), F.round(F.avg("overall"), 6).alias("avg_confidence"))


def _sql_risk(kind: str) -> str:
    n = f"({_sql_hits('lower(text)', X.RISK_WORDS[kind])})"
    return f"case when {n} = 0 then 0.0 when {n} <= 2 then 0.3 when {n} <= 5 then 0.6 else 0.9 end::double"


_RISKS = "select doc_id, " + ", ".join(f"{_sql_risk(k)} as {k}" for k in X.RISK_WORDS) + " from documents"


@query(f"select doc_id, sexual_content as nsfw, violence, hate_speech, self_harm, sexual_content, w as worst, case when w = 0 then null when sexual_content = w then 'nsfw' when violence = w then 'violence' when hate_speech = w then 'hate_speech' else 'self_harm' end as primary_risk, w < 0.7 as is_safe, case when w < 0.7 then 1 - w else w end as confidence from (select *, greatest(violence, hate_speech, sexual_content, self_harm) as w from ({_RISKS}))")
def safety_assessment(spark, sf_dir):
    return label.safety(text_of(spark, sf_dir))


_TOX = f"select doc_id, {_sql_any('text', X.HATE, 'i')} as hate, {_sql_any('text', X.THREAT, 'i')} as threat from documents"
_TOXIC = f"select doc_id, case when threat then 0.9 when hate then 0.8 else 0.1 end::double as toxicity, 0.05::double as severe_toxicity, case when hate then 0.8 else 0.05 end::double as identity_attack, 0.1::double as insult, 0.1::double as profanity, case when threat then 0.9 else 0.05 end::double as threat, 0.05::double as sexually_explicit, hate or threat as is_toxic from ({_TOX})"


@query(_TOXIC)
def toxicity_scores(spark, sf_dir):
    return text_of(spark, sf_dir).select("doc_id", *[v.alias(k) for k, v in T.toxicity(F.col("text")).items()])


@query(f"select case when is_toxic then 'filtered' else 'success' end as status, count(*) as n from ({_TOXIC}) group by 1")
def toxicity_gate(spark, sf_dir):
    return text_of(spark, sf_dir).groupBy(F.when(T.toxicity(F.col("text"))["is_toxic"], "filtered").otherwise("success").alias("status")).agg(F.count("*").alias("n"))


@query(f"select tp, fp, fn, tn, round(coalesce((tp + tn) / nullif(tp + fp + fn + tn, 0), 0), 6) as accuracy, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) as precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 6) as recall, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) as f1 from (select count(*) filter (is_toxic and toxic = 1) as tp, count(*) filter (is_toxic and toxic = 0) as fp, count(*) filter (not is_toxic and toxic = 1) as fn, count(*) filter (not is_toxic and toxic = 0) as tn from ({_TOXIC}) join labels using (doc_id))")
def toxicity_vs_labels(spark, sf_dir):
    rows = text_of(spark, sf_dir).join(read(spark, sf_dir, "labels"), "doc_id").select("toxic", T.toxicity(F.col("text"))["is_toxic"].alias("p"))
    return evaluate.binary_metrics(rows, F.col("p"), F.col("toxic") == 1)


@query(f"select n, agreed, round((agreed / n - (pa * pb + (n - pa) * (n - pb)) / (n * n)) / nullif(1 - (pa * pb + (n - pa) * (n - pb)) / (n * n), 0), 6) as kappa from (select count(*) as n, count(*) filter (is_toxic = (toxic = 1)) as agreed, count(*) filter (is_toxic) as pa, count(*) filter (toxic = 1) as pb from ({_TOXIC}) join labels using (doc_id))")
def annotator_kappa(spark, sf_dir):
    rows = text_of(spark, sf_dir).join(read(spark, sf_dir, "labels"), "doc_id").select("toxic", T.toxicity(F.col("text"))["is_toxic"].alias("p"))
    return evaluate.cohen_kappa(rows, F.col("p"), F.col("toxic") == 1)


# --- personal data -------------------------------------------------------------------------------------------------
@query("select " + ", ".join(f"sum(len(regexp_extract_all(text, '{p}')))::bigint as {k.lower()}" for k, p in X.PII.items()) + " from documents")
def pii_counts(spark, sf_dir):
    return text_of(spark, sf_dir).agg(*[F.sum(F.regexp_count("text", F.lit(p))).alias(k.lower()) for k, p in X.PII.items()])


@query(r"select doc_id, unnest(list_filter(regexp_extract_all(text, '\b(?:\d{1,3}\.){3}\d{1,3}\b'), lambda ip: list_bool_and(list_transform(string_split(ip, '.'), lambda x: x::int <= 255)))) as ip from documents")
def pii_strict_ip(spark, sf_dir):
    found = F.regexp_extract_all("text", F.lit(X.PII["IP_ADDRESS"]), 0)
    good = F.filter(found, lambda ip: F.forall(F.split(ip, r"\."), lambda x: x.cast("int") <= 255))
    return text_of(spark, sf_dir).select("doc_id", F.explode(good).alias("ip"))


# --- duplicates ----------------------------------------------------------------------------------------------------
@query("select doc_id, lang, source from (select *, row_number() over (partition by sha256(text) order by doc_id) as r from documents) where r = 1")
def exact_dedup_kept(spark, sf_dir):
    return dedup.exact(text_of(spark, sf_dir)).select("doc_id", "lang", "source")


@query("select sha256(text) as hash, min(doc_id) as first, count(*) as n from documents group by 1 having count(*) > 1")
def exact_dup_groups(spark, sf_dir):
    return dedup.exact_groups(text_of(spark, sf_dir)).where("n > 1")


@query()
def minhash_groups(spark, sf_dir):
    return dedup.minhash(text_of(spark, sf_dir))


@query("select count(*) as n, count(distinct embedding) as kinds, round(avg(list_cosine_similarity(embedding::double[], c)), 6) as mean_likeness from (select *, first(embedding::double[]) over (partition by label order by vec_id rows between unbounded preceding and unbounded following) as c from embeddings)")
def embedding_likeness(spark, sf_dir):
    rows = read(spark, sf_dir, "embeddings").withColumn("e", F.col("embedding").cast("array<double>"))
    first = rows.groupBy("label").agg(F.min_by("e", "vec_id").alias("c"))
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    out = rows.join(first, "label").withColumn("s", dot("e", "c") / F.sqrt(dot("e", "e") * dot("c", "c")))
    return out.agg(F.count("*").alias("n"), F.countDistinct("embedding").alias("kinds"), F.round(F.avg("s"), 6).alias("mean_likeness"))


# --- the catalog ---------------------------------------------------------------------------------------------------
def items(spark, sf_dir):
    return store.items_from(text_of(spark, sf_dir), read(spark, sf_dir, "labels"))


_ITEMS = "select d.doc_id::varchar as item_id, source as dataset, 'text' as data_type, sha256(text) as content_hash, case when length(text) >= 50 then 'cleaned' else 'raw' end as status, q as quality_score from documents d left join (select doc_id, max(quality)::double as q from labels group by 1) using (doc_id)"


@query(f"select dataset, count(*) as total_items, count(*) filter (status = 'raw') as raw_items, count(*) filter (status = 'cleaned') as cleaned_items, round(coalesce(avg(quality_score), 0), 6) as avg_quality from ({_ITEMS}) group by 1")
def dataset_statistics(spark, sf_dir):
    return store.statistics(items(spark, sf_dir))


@query(f"select case when quality_score < 0.2 then '0.0-0.2' when quality_score < 0.4 then '0.2-0.4' when quality_score < 0.6 then '0.4-0.6' when quality_score < 0.8 then '0.6-0.8' else '0.8-1.0' end as bucket, count(*) as n from ({_ITEMS}) where quality_score is not null group by 1")
def quality_histogram(spark, sf_dir):
    return store.histogram(items(spark, sf_dir))


@query(f"select * from ({_ITEMS}) where status = 'cleaned' and quality_score >= 0.5 order by item_id desc limit 100 offset 20")
def query_items_top(spark, sf_dir):
    return store.query_items(items(spark, sf_dir), {"status": "cleaned"}, low=0.5, limit=100, offset=20)


@query(f"select coalesce(a.item_id, b.item_id) as item_id, case when a.item_id is null then 'text' else a.data_type end as data_type, coalesce(a.content_hash, b.content_hash) as content_hash, coalesce(b.status, a.status) as status, case when b.item_id is not null then b.quality_score else a.quality_score end as quality_score from ({_ITEMS}) a full join (select (doc_id * 2)::varchar as item_id, md5(doc_id::varchar) as content_hash, 'labeled' as status, quality::double as quality_score from labels) b using (item_id)")
def upsert_items(spark, sf_dir):
    old = items(spark, sf_dir).drop("dataset")
    new = read(spark, sf_dir, "labels").select((F.col("doc_id") * 2).cast("string").alias("item_id"), F.lit("text").alias("data_type"), F.md5(F.col("doc_id").cast("string")).alias("content_hash"), F.lit("labeled").alias("status"), F.col("quality").cast("double").alias("quality_score"))
    return store.upsert(old, new, "item_id", ["status", "quality_score"])


@query("select doc_id, quality::varchar as quality, lang, 'labels' as origin from labels join documents using (doc_id)")
def metadata_merge(spark, sf_dir):
    rows = read(spark, sf_dir, "labels").join(text_of(spark, sf_dir), "doc_id")
    old = F.create_map(F.lit("lang"), "lang", F.lit("origin"), "source")
    new = F.create_map(F.lit("origin"), F.lit("labels"), F.lit("quality"), F.col("quality").cast("string"))
    m = store.merge_metadata(old, new)
    return rows.select("doc_id", m["quality"].alias("quality"), m["lang"].alias("lang"), m["origin"].alias("origin"))


# --- conversations -------------------------------------------------------------------------------------------------
def _sql_template(name: str) -> str:
    begin, roles, opener = chat.TEMPLATES[name]
    lit = lambda s: "'" + s.replace("\n", "' || chr(10) || '") + "'"
    cases = " ".join(f"when '{r}' then {lit(a)} || coalesce(text, '') || {lit(b)}" for r, (a, b) in roles.items())
    return f"select conv_id, {lit(begin)} || coalesce(string_agg(case role {cases} else '' end, '' order by turn, role, text), '') || {lit(opener)} as prompt from conversations group by 1"


def _chat(name: str):
    def run(spark, sf_dir):
        return chat.rendered(read(spark, sf_dir, "conversations"), name)

    run.__name__ = f"chat_{name}"
    query(_sql_template(name))(run)


for _name in chat.TEMPLATES:
    _chat(_name)


def _sql_sft() -> str:
    begin, roles, opener = chat.TEMPLATES["chatml"]
    lit = lambda s: "'" + s.replace("\n", "' || chr(10) || '") + "'"
    cases = " ".join(f"when '{r}' then {lit(a)} || coalesce(c.text, '') || {lit(b)}" for r, (a, b) in roles.items())
    last = "select conv_id, max(turn) filter (role = 'assistant') as last, count(*)::int as n from conversations group by 1"
    return f"select conv_id, any_value(n) as n_messages, {lit(begin)} || coalesce(string_agg(case c.role {cases} else '' end, '' order by c.turn, c.role, c.text) filter (c.turn < last), '') || {lit(opener)} as prompt, any_value(c.text) filter (c.turn = last) as response from conversations c join ({last}) using (conv_id) where last is not null group by 1"


@query(_sql_sft())
def sft_samples(spark, sf_dir):
    return chat.sft_samples(read(spark, sf_dir, "conversations"))


@query("with u as (select conv_id, split_part(arg_min(text, turn), ' ', 1) as prompt from conversations where role = 'user' group by 1), a as (select conv_id, arg_min(text, turn) as answer from conversations where role = 'assistant' group by 1), p as (select prompt, arg_max(answer, (length(answer), answer)) as x, arg_min(answer, (length(answer), answer)) as y from u join a using (conv_id) group by 1) select prompt, prompt || chr(10) || x as chosen, prompt || chr(10) || y as rejected from p where x <> y")
def preference_pairs(spark, sf_dir):
    """Pairs of answers to user turns that begin with the same word (no two whole turns are equal in these tables)."""
    return chat.preference_pairs(read(spark, sf_dir, "conversations"), lambda t: F.split(t, " ")[0])


@query("select role, count(*) as n, sum(length(text))::bigint as chars, max(turn) as last_turn from conversations group by 1")
def role_statistics(spark, sf_dir):
    return read(spark, sf_dir, "conversations").groupBy("role").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"), F.max("turn").alias("last_turn"))


# --- questions and answers -----------------------------------------------------------------------------------------
@query(r"select doc_id, len(list_filter(list_transform(regexp_split_to_array(text, '[。！？.!?]+'), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '')) as n from documents")
def qa_sentences(spark, sf_dir):
    return text_of(spark, sf_dir).select("doc_id", F.size(T.sentences(F.col("text"))).alias("n"))


@query(r"select doc_id, array_to_string(list_concat(regexp_extract_all(text, '[A-Z][a-z]+\s[A-Z][a-z]+|[A-Z][a-z]+'), case when len(regexp_extract_all(text, '\d+(?:\.\d+)?(?:万|亿|百万)?')) > 0 then ['数字' || regexp_extract_all(text, '\d+(?:\.\d+)?(?:万|亿|百万)?')[1]] else [] end), '|') as entities from documents")
def qa_entities(spark, sf_dir):
    return text_of(spark, sf_dir).select("doc_id", F.array_join(T.entities(F.col("text")), "|").alias("entities"))


# --- sampling ------------------------------------------------------------------------------------------------------
@query("select doc_id, case when p < 0.8 then 'train' when p < 0.9 then 'validation' else 'test' end as split from (select doc_id, ('0x' || substr(md5(doc_id::varchar || ':42'), 1, 13))::bigint / 4503599627370496.0 as p from documents)")
def hash_split(spark, sf_dir):
    p = sample.point(F.col("doc_id"))
    return text_of(spark, sf_dir).select("doc_id", F.when(p < 0.8, "train").when(p < 0.9, "validation").otherwise("test").alias("split"))


@query("select doc_id, lang from (select doc_id, lang, ('0x' || substr(md5(doc_id::varchar || ':42'), 1, 13))::bigint / 4503599627370496.0 as p from documents) where p < case lang when 'en' then 0.2 when 'fr' then 0.5 when 'de' then 1.0 else 0.0 end")
def mixture_sample(spark, sf_dir):
    return sample.mixture(text_of(spark, sf_dir), "doc_id", "lang", {"en": 0.2, "fr": 0.5, "de": 1.0}).select("doc_id", "lang")


@query(f"select doc_id, (unnest(range(0, ceil(len(w) / 512)::int)))::int as chunk from ({_W}) where len(w) > 0")
def word_chunks(spark, sf_dir):
    docs = text_of(spark, sf_dir)
    return sample.chunk(docs, T.words(F.col("text")), 512).select("doc_id", "chunk")


@query("select lang, count(*) as n, avg(n_chars) as mean_chars, min(n_chars) as least_chars, max(n_chars) as most_chars from documents group by 1")
def corpus_report(spark, sf_dir):
    return text_of(spark, sf_dir).groupBy("lang").agg(F.count("*").alias("n"), F.avg("n_chars").alias("mean_chars"), F.min("n_chars").alias("least_chars"), F.max("n_chars").alias("most_chars"))


# --- tokens --------------------------------------------------------------------------------------------------------
def _counted(spark, sf_dir, *more):
    import public_tokenizers

    return text_of(spark, sf_dir).select(*more, tokenize.counter(public_tokenizers.path("word_bpe_49k.json"))("text").alias("n_tokens"))


@query()
def token_statistics(spark, sf_dir):
    return tokenize.statistics(_counted(spark, sf_dir), n=F.col("n_tokens"))


@query()
def token_fertility(spark, sf_dir):
    return tokenize.fertility(_counted(spark, sf_dir, "lang", F.size(T.words(F.col("text"))).alias("n_words")), F.col("n_tokens"), F.col("n_words"), "lang")


# --- events and the star schema ------------------------------------------------------------------------------------
@query("select event_id, user_id, count(*) over (partition by user_id order by epoch(ts)::bigint range between 60 preceding and current row) as n from events")
def rate_limit_window(spark, sf_dir):
    second = F.rint(F.col("ts").cast("timestamp").cast("double")).cast("long")  # the nearest, the even one of two, as in the SQL
    w = Window.partitionBy("user_id").orderBy(second).rangeBetween(-60, 0)
    return read(spark, sf_dir, "events").select("event_id", "user_id", F.count("*").over(w).alias("n"))


@query("select n_name, sum(l_extendedprice * (1 - l_discount))::double as revenue from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey group by 1")
def star_join_revenue(spark, sf_dir):
    get = lambda n: read(spark, sf_dir, n)
    out = get("lineitem").join(get("orders"), F.expr("l_orderkey = o_orderkey")).join(get("customer"), F.expr("o_custkey = c_custkey")).join(get("nation"), F.expr("c_nationkey = n_nationkey"))
    return out.groupBy("n_name").agg(F.sum(F.expr("l_extendedprice * (1 - l_discount)")).alias("revenue"))


from sparkloom import catalogue_more  # noqa: E402, F401  the rest of the queries register themselves
