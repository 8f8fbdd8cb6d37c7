"""More queries of the engine's own operators, with the DuckDB SQL that checks them: labels, checks, evaluation, sources, stores."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkloom.catalogue import _DIMS, _ITEMS, _RISKS, _W, items, query, read, text_of
from sparkloom.functions import fixed as X
from sparkloom.functions import text as T
from sparkloom.functions import udf as U
from sparkloom.operators import checks, clean, dedup, evaluate, image, label, sample, store
from sparkloom.sources import readers

_LOW = "regexp_replace(text, '^\\s+|\\s+$', '', 'g')"


# --- text ----------------------------------------------------------------------------------------------------------
def _sql_lines() -> str:
    bare = r"list_transform(string_split(text, chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g'))"
    some = "list_filter(bare, lambda x: x <> '')"
    few = f"len({some}) - len(list_distinct({some})) <= 0.3 * len(list_distinct({some}))"
    first = "list_filter(list_zip(raw, bare, range(1, len(raw) + 1)), lambda z: z[2] = '' or list_position(bare, z[2]) = z[3])"
    unseen = "list_filter(list_zip(raw, bare, range(1, len(raw) + 1)), lambda z: coalesce(list_position(raw, z[2]), 0) = 0 or list_position(raw, z[2]) >= z[3])"
    kept = f"case when {few} or len({some}) = 0 then {first} else {unseen} end"
    return f"select doc_id, case when contains(text, chr(10)) then array_to_string(list_transform({kept}, lambda z: z[1]), chr(10)) else text end as text from (select doc_id, text, string_split(text, chr(10)) as raw, {bare} as bare from documents)"


@query(_sql_lines())
def line_dedup(spark, sf_dir):
    return text_of(spark, sf_dir).select("doc_id", U.dedup_lines("text").alias("text"))


def _sql_bare_page() -> str:
    out = "html"
    for name in readers.BLOCKS:
        out = f"regexp_replace({out}, '(?is)<{name}\\b.*?</{name}\\s*>', ' ', 'g')"
    out = f"regexp_replace(regexp_replace({out}, '(?i)<(br|/p|/div|/li|/h\\d)[^>]*>', ' ', 'g'), '<[^>]+>', '', 'g')"
    return rf"regexp_replace(regexp_replace(regexp_replace({out}, '\s+', ' ', 'g'), '[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x{{9f}}]', '', 'g'), '^\s+|\s+$', '', 'g')"


@query(f"select page_id, length(t) as n_chars, sha256(t) as h from (select page_id, {_sql_bare_page()} as t from pages)")
def page_bare_text(spark, sf_dir):
    """The text of pages before entities are resolved; page_main_text also resolves them."""
    bare = readers.page_bare(F.col("html"))
    return read(spark, sf_dir, "pages").select("page_id", F.length(bare).alias("n_chars"), F.sha2(bare, 256).alias("h"))


def _sql_main_text() -> str:
    out = _sql_bare_page()
    for entity, sign in (("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"'), ("&amp;", "&")):  # all that these tables have
        out = f"replace({out}, '{entity}', '{sign}')"
    return rf"select page_id, url, regexp_replace(regexp_replace({out}, '\s+', ' ', 'g'), '^\s+|\s+$', '', 'g') as text from pages"


@query(_sql_main_text())
def page_main_text(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", "url", readers.page_text(F.col("html")).alias("text"))


@query("select page_id, regexp_replace(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '\\s+', ' ', 'g'), '^\\s+|\\s+$', '', 'g') as title from pages")
def page_titles(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", readers.page_title(F.col("html")).alias("title"))


@query("select distinct link as url from (select unnest(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1)) as link from pages) where link <> '' and link not in (select url from pages where url is not null)")
def url_frontier(spark, sf_dir):
    pages = read(spark, sf_dir, "pages")
    return readers.frontier(readers.links(pages).select(F.col("link").alias("url")), pages)


def _sql_contractions() -> str:
    out = "text"
    for a, b in X.CONTRACTIONS.items():
        out = f"replace({out}, '{a.replace(chr(39), chr(39) * 2)}', '{b}')"
    return out


@query(f"select doc_id, sha256(lower(regexp_replace({_sql_contractions()}, '\\p{{P}}', '', 'g'))) as h from documents")
def normalised_text(spark, sf_dir):
    """Contractions written out, punctuation removed, lower case."""
    return text_of(spark, sf_dir).select("doc_id", F.sha2(F.lower(T.without_punctuation(T.expand_contractions(F.col("text")))), 256).alias("h"))


def _sql_tidy() -> str:
    out = r"array_to_string(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> ''), ' ')"
    for end in "。！？.!?":
        out = f"regexp_replace({out}, '[{end}]{{2,}}', '{end}', 'g')"
    return f"select conv_id, turn, role, upper(substr(c, 1, 1)) || substr(c, 2) as caption from (select conv_id, turn, role, {out} as c from conversations)"


@query(_sql_tidy())
def tidy_captions(spark, sf_dir):
    return read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", T.tidy_caption(F.col("text")).alias("caption"))


@query("select doc_id, regexp_replace(regexp_replace(text, '(?i)hate', '****', 'g'), '(?i)kill', '****', 'g') as text, contains(lower(text), 'hate') or contains(lower(text), 'kill') as profane from documents")
def toxic_redaction(spark, sf_dir):
    """Redaction and profanity match with a given list (the built-in ones are empty)."""
    return text_of(spark, sf_dir).select("doc_id", T.redact(F.col("text"), [], ["hate", "kill"]).alias("text"), T.profanity(F.col("text"), [], ["hate", "kill"]).alias("profane"))


@query(r"select doc_id, round(206.835 - 1.015 * len(w) / greatest(1, len(list_filter(list_transform(regexp_split_to_array(text, '[。！？.!?]+'), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> ''))) - 84.6 * len(regexp_extract_all(low, '[aeiouy]+')) / len(w), 6) as ease, (len(regexp_extract_all(text, 'https?://')) >= 3)::int + (len(regexp_extract_all(text, '!')) >= 5)::int + (len(regexp_extract_all(text, '[A-Z]{4,}')) >= 5)::int + regexp_matches(text, '[$€£]\s?\d')::int as spam from (" + _W + ")")
def readability_and_spam(spark, sf_dir):
    return text_of(spark, sf_dir).select("doc_id", F.round(T.reading_ease(F.col("text")), 6).alias("ease"), T.spam_marks(F.col("text")).alias("spam"))


@query("select (length(text) between 50 and 100000) as passes, count(*) as n from documents group by 1")
def quality_predicate_counts(spark, sf_dir):
    """The cleaner's conjunction on raw texts (both languages it can tell are allowed)."""
    return text_of(spark, sf_dir).groupBy(clean.quality_predicate(F.col("text")).alias("passes")).agg(F.count("*").alias("n"))


@query("select doc_id, coalesce(nullif(text, ''), nullif(source, ''), nullif(lang, '')) as content, 'cleaned_' || doc_id as item_id from documents")
def item_extraction(spark, sf_dir):
    return text_of(spark, sf_dir).select("doc_id", T.item_text(F.col("text"), F.col("source"), F.col("lang")).alias("content"), F.concat(F.lit("cleaned_"), F.col("doc_id").cast("string")).alias("item_id"))


# --- personal data -------------------------------------------------------------------------------------------------
_LUHN = "list_sum(list_transform(range(1, length(v) + 1), lambda i: case when i % 2 = 1 then substr(reverse(v), i, 1)::int else (substr(reverse(v), i, 1)::int * 2) // 10 + (substr(reverse(v), i, 1)::int * 2) % 10 end)) % 10 = 0"
_OCTETS = "list_bool_and(list_transform(string_split(v, '.'), lambda x: x::int <= 255))"


def _sql_strict() -> str:
    parts = []
    for kind, score in X.PII_STRICT.items():
        check = {"BANK_CARD": _LUHN, "IP_ADDRESS": _OCTETS}.get(kind, "true")
        parts.append(f"select doc_id, '{kind}' as entity_type, v as text, {score}::double as score from (select doc_id, unnest(regexp_extract_all(text, '{X.PII[kind]}')) as v from documents) where {check}")
    return " union all ".join(parts)


#: Leftmost match of the patterns, in their order; the values found and the text between them.
_FOUND = "select doc_id, regexp_split_to_array(text, '{p}') as p, regexp_extract_all(text, '{p}') as v from documents".format(p="|".join(X.PII.values()))
_KIND = "case " + " ".join(f"when regexp_full_match(x, '{p}') then '{k}'" for k, p in X.PII.items()) + " end"


def _sql_cover(covered: str) -> str:
    return f"case when len(v) = 0 then array_to_string(p, '') else p[1] || array_to_string(list_transform(range(1, len(v) + 1), lambda i: list_transform([v[i]], lambda x: {covered})[1] || p[i + 1]), '') end"


@query("select doc_id, " + ", ".join(f"{_sql_cover(c)} as {k}" for k, c in (("replace", f"'[' || {_KIND} || ']'"), ("mask", "case when length(x) <= 4 then repeat('*', length(x)) else substr(x, 1, 2) || repeat('*', length(x) - 4) || substr(x, -2) end"), ("hash", f"'[' || {_KIND} || '_' || substr(md5(x), 1, 8) || ']'"))) + f" from ({_FOUND})")
def pii_redacted(spark, sf_dir):
    return text_of(spark, sf_dir).select("doc_id", U.cover_all("text").alias("c")).select("doc_id", "c.*")


@query(f"select doc_id, {_KIND} as entity_type, x as text, start::int as start, (start + length(x))::int as \"end\", 0.9::double as score from (select doc_id, v[i] as x, length(array_to_string(p[1:i], '')) + length(array_to_string(v[1:i - 1], '')) as start from (select *, unnest(range(1, len(v) + 1)) as i from ({_FOUND})))")
def pii_entities(spark, sf_dir):
    return text_of(spark, sf_dir).select("doc_id", F.explode(U.find_pii("text")).alias("e")).select("doc_id", "e.*")


@query(_sql_strict())
def pii_strict(spark, sf_dir):
    return text_of(spark, sf_dir).select("doc_id", F.explode(T.strict_pii(F.col("text"))).alias("e")).select("doc_id", "e.*")


@query(f"select doc_id, v as card from (select doc_id, unnest(regexp_extract_all(text, '{X.PII['BANK_CARD']}')) as v from documents) where {_LUHN}")
def pii_strict_card(spark, sf_dir):
    found = F.filter(F.regexp_extract_all("text", F.lit(X.PII["BANK_CARD"]), 0), lambda c: F.call_function("luhn_check", c))
    return text_of(spark, sf_dir).select("doc_id", F.explode(found).alias("card"))


# --- duplicates ----------------------------------------------------------------------------------------------------
@query("select doc_id, case when r > 1 then first end as duplicate_of, r > 1 as is_duplicate from (select doc_id, row_number() over (partition by sha256(text) order by doc_id) as r, min(doc_id) over (partition by sha256(text)) as first from documents)")
def duplicates_marked(spark, sf_dir):
    return dedup.marked(text_of(spark, sf_dir)).select("doc_id", "duplicate_of", "is_duplicate")


@query("select doc_id from documents where sha256(text) not in (select sha256(text) from documents where lang = 'en')")
def unseen_contents(spark, sf_dir):
    """Texts whose content no English row has: the anti-join against stored keys."""
    docs = text_of(spark, sf_dir)
    seen = docs.where("lang = 'en'").select(F.sha2("text", 256).alias("hash")).distinct()
    return dedup.unseen(docs, seen).select("doc_id")


@query("select a.item_id, round(len(list_intersect(a.w, b.w)) / len(list_distinct(list_concat(a.w, b.w))), 6) as similarity from (select item_id, list_distinct(regexp_split_to_array(lower(text), '\\s+')) as w from benchmark) a join (select item_id - 1 as item_id, list_distinct(regexp_split_to_array(lower(text), '\\s+')) as w from benchmark) b using (item_id)")
def text_similarity(spark, sf_dir):
    """Similarity as sets of words of each benchmark text and the next."""
    rows = read(spark, sf_dir, "benchmark").select("item_id", F.array_distinct(F.split(F.lower("text"), r"\s+")).alias("w"))
    after = rows.select((F.col("item_id") - 1).alias("item_id"), F.col("w").alias("v"))
    return rows.join(after, "item_id").select("item_id", F.round(dedup.jaccard("w", "v"), 6).alias("similarity"))


@query()
def simhash_kept(spark, sf_dir):
    docs = text_of(spark, sf_dir)
    return dedup.simhash_groups(docs)


@query()
def text_dedup_kept(spark, sf_dir):
    """Exact, then MinHash dedup: what the dispatch keeps of texts."""
    return dedup.batch_dedup(text_of(spark, sf_dir)).select("doc_id")


# --- labels --------------------------------------------------------------------------------------------------------
_FIVE = {"fluency": "a", "relevance": "b", "coherence": "c", "informativeness": "d", "safety": "e"}


@query("select doc_id, name, round(score, 6) as score from (" + " union all ".join(f"select doc_id, '{k}' as name, {v} as score from ({_DIMS}) where doc_id in (select doc_id from documents where text <> '')" for k, v in _FIVE.items() if k in ("fluency", "coherence", "safety")) + ")")
def scorer_chosen_dimensions(spark, sf_dir):
    """A row for each dimension that is asked for."""
    dims = label.dimensions(text_of(spark, sf_dir), ["fluency", "coherence", "safety", "unknown"])
    return dims.select("doc_id", F.explode(T.made_once("dims")).alias("d")).select("doc_id", "d.name", F.round("d.score", 6).alias("score"))


@query(f"select doc_id, round(least(1.0, greatest(0.0, case when text <> '' then (2 * a + b + c + d + 0.5 * e) / 5.5 else 0 end)), 6) as score from ({_DIMS}) join documents using (doc_id)")
def scorer_weighted_mean(spark, sf_dir):
    dims = label.dimensions(text_of(spark, sf_dir), list(_FIVE))
    return dims.select("doc_id", F.round(T.weighted_mean(F.col("dims"), {"fluency": 2.0, "safety": 0.5}), 6).alias("score"))


_WORST = "greatest(violence, hate_speech, sexual_content, self_harm)"
_LABELLED = f"select doc_id, case when {_WORST} >= 0.7 or (a + b + c + d + e) / 5 < 0.6 then 'needs_review' else 'completed' end as label_status, format('{{:.4f}}', (a + b + c + d + e) / 5) as quality, case when {_WORST} < 0.7 then 'safe' else 'unsafe' end as safety, case when {_WORST} < 0.7 then 1 - {_WORST} else {_WORST} end as confidence from ({_DIMS}) join ({_RISKS}) using (doc_id)"


def _labelled(spark, sf_dir):
    return label.chained(label.unlabelled(text_of(spark, sf_dir)), {"quality": label.quality_labels, "safety": label.safety_labels})


@query(f"select doc_id, label_status, safety, round(confidence, 6) as confidence, 2 as n_labels from ({_LABELLED})")
def labels_chained(spark, sf_dir):
    """Quality and safety labels added one after the other; both stay."""
    safe = label.get_label(F.col("labels"), "safety")
    return _labelled(spark, sf_dir).select("doc_id", "label_status", safe["label_value"].alias("safety"), F.round(safe["confidence"], 6).alias("confidence"), F.size("labels").alias("n_labels"))


@query(f"select count(*) as total, count(*) filter (label_status = 'completed') as completed, 0 as failed, round(count(*) filter (label_status = 'completed') / count(*), 6) as success_rate, 2.0::double as avg_labels from ({_LABELLED})")
def labeling_statistics(spark, sf_dir):
    return label.labeling_statistics(_labelled(spark, sf_dir))


@query("select unnest(['quality', 'safety']) as label_type, (select count(*) from documents) as n")
def label_distribution(spark, sf_dir):
    return label.label_distribution(_labelled(spark, sf_dir))


_NAMES = ("nsfw", "violence", "hate_speech", "self_harm", "sexual_content")


@query("select doc_id, " + ", ".join(f"greatest({'sexual_content' if k == 'nsfw' else k}, {X.IMAGE_RISKS.get(k, 0.0)}) as {k}" for k in _NAMES) + f", {_WORST} < 0.7 as is_safe, case when {_WORST} = 0 then null when sexual_content = {_WORST} then 'nsfw' when violence = {_WORST} then 'violence' when hate_speech = {_WORST} then 'hate_speech' else 'self_harm' end as primary_risk, least(0.9, case when {_WORST} < 0.7 then 1 - {_WORST} else {_WORST} end)::double as confidence from ({_RISKS})")
def multimodal_safety(spark, sf_dir):
    out = label.multimodal_safety(text_of(spark, sf_dir))
    return out.select("doc_id", *[F.col("risks")[k].alias(k) for k in _NAMES], "is_safe", "primary_risk", "confidence")


def _judgements(spark, sf_dir):
    labels = read(spark, sf_dir, "labels")
    rows = labels.join(text_of(spark, sf_dir).select("doc_id", "n_chars"), "doc_id")
    value = F.explode(F.array(F.when(F.col("quality") == 1, "good").otherwise("bad"), F.when(F.col("toxic") == 1, "bad").otherwise("good"), F.when(F.col("n_chars") >= 1000, "good").otherwise("bad")))
    return rows.select("doc_id", value.alias("v"))


_JUDGED = "select doc_id, unnest([case when quality = 1 then 'good' else 'bad' end, case when toxic = 1 then 'bad' else 'good' end, case when n_chars >= 1000 then 'good' else 'bad' end]) as v from labels join documents using (doc_id)"


@query(f"select doc_id, v as winner, n as votes, round(n / sum_n, 6) as share from (select doc_id, v, count(*) as n, sum(count(*)) over (partition by doc_id) as sum_n, row_number() over (partition by doc_id order by count(*) desc, v) as r from ({_JUDGED}) group by 1, 2) where r = 1")
def majority_vote(spark, sf_dir):
    """Three judges of each labelled document: the most frequent value."""
    return label.voted(_judgements(spark, sf_dir), "doc_id", "v").withColumn("share", F.round("share", 6))


@query(f"with c as (select doc_id, v, count(*) as n from ({_JUDGED}) group by 1, 2), i as (select doc_id, sum(n) as r, sum(n * (n - 1)) as p from c group by 1), o as (select count(*) as items, avg(p / (r * (r - 1))) as p, sum(r) as s from i), e as (select sum(n * n) as q from (select v, sum(n)::double as n from c group by 1)) select items, round((p - q / (s::double * s)) / (1 - q / (s::double * s)), 6) as kappa from o, e")
def annotators_fleiss_kappa(spark, sf_dir):
    return evaluate.fleiss_kappa(_judgements(spark, sf_dir), "doc_id", "v")


# --- data types ----------------------------------------------------------------------------------------------------
@query("select case when t and i then 'multimodal' when i then 'image' when t then 'text' else 'unknown' end as scorer, case when t then 'text' when i then 'image' when a then 'audio' else 'unknown' end as filter, case when i then 'image' when a then 'audio' when v then 'video' when t then 'text' else 'multimodal' end as labeler, case when t::int + i::int + a::int + v::int > 1 then 'text' when i then 'image' when a then 'audio' when v then 'video' else 'text' end as tokenizer, count(*) as n from (select text <> '' as t, lang = 'en' as i, source = 'src1' as a, n_chars > 2000 as v from documents) group by 1, 2, 3, 4")
def data_types(spark, sf_dir):
    """The four callers' precedence over which of text, image, audio and video is there (columns stand in for media)."""
    has = {"text": F.col("text") != "", "image": F.col("lang") == "en", "audio": F.col("source") == "src1", "video": F.col("n_chars") > 2000}
    rows = text_of(spark, sf_dir).select(*[F.coalesce(v, F.lit(False)).alias(k) for k, v in has.items()])
    has = {k: F.col(k) for k in has}
    of = lambda who: T.data_type(has, *T.TYPE_ORDERS[who])
    return rows.groupBy(T.scorer_type(has["text"], has["image"]).alias("scorer"), of("filter").alias("filter"), of("labeler").alias("labeler"), T.modality(has).alias("tokenizer")).agg(F.count("*").alias("n"))


@query("select 0.65::double as image, 0.5::double as audio, 0.5::double as alignment, count(*) as n from documents")
def media_constant_scores(spark, sf_dir):
    """Scores of media without a model, beside each document."""
    scores = [T.constant_score(X.IMAGE_SCORES, X.IMAGE_WEIGHTS), T.constant_score(X.AUDIO_SCORES, X.AUDIO_WEIGHTS), F.lit(X.ALIGNMENT)]
    rows = text_of(spark, sf_dir).select(*[F.round(s, 6).alias(n) for s, n in zip(scores, ("image", "audio", "alignment"))])
    return rows.groupBy("image", "audio", "alignment").agg(F.count("*").alias("n"))


# --- questions and answers -----------------------------------------------------------------------------------------
_QA = r"""with s as (select doc_id, text, list_slice(list_filter(list_transform(regexp_split_to_array(text, '[。！？.!?]+'), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> ''), 1, 3) as s from documents),
 r as (select doc_id, text, unnest(s) as answer, unnest(range(1, len(s) + 1)) as i from s),
 e as (select *, list_concat(regexp_extract_all(answer, '[A-Z][a-z]+\s[A-Z][a-z]+|[A-Z][a-z]+'), case when len(regexp_extract_all(answer, '\d+(?:\.\d+)?(?:万|亿|百万)?')) > 0 then ['数字' || regexp_extract_all(answer, '\d+(?:\.\d+)?(?:万|亿|百万)?')[1]] else [] end) as e from r),
 q as (select doc_id, text, i, answer, case when len(e) > 0 then 'What is ' || e[1] || '?' else 'What does this sentence mean: ' || substr(answer, 1, 50) || '...?' end as question, case when len(e) > 0 then 'factual' else 'conceptual' end as type from e),
 k as (select *, count(*) over (partition by doc_id) as raw, row_number() over (partition by doc_id, type order by i) as nth, min(i) over (partition by doc_id, type) as met from q),
 o as (select *, row_number() over (partition by doc_id order by case when raw = 1 then 0 when nth = 1 then 0 else 1 end, case when nth = 1 then (type = 'conceptual')::int else met end, i) as place from k),
 d as (select * from o qualify place = min(place) over (partition by doc_id, lower(question))),
 p as (select doc_id, text, (row_number() over (partition by doc_id order by place) - 1)::int as place, question, answer, type from d where length(question) between 10 and 200 and length(answer) between 20 and 1000 and length(text) >= 20)
 """


@query(_QA + "select doc_id, place, question, answer, type, case type when 'factual' then 'easy' else 'medium' end as difficulty, case type when 'factual' then 0.7 else 0.6 end::double as confidence from p")
def qa_pairs(spark, sf_dir):
    return label.questions(text_of(spark, sf_dir))


@query(_QA + ", c as (select doc_id, count(*) as n from p group by 1) select doc_id, case when n > 0 then 'completed' else 'failed' end as qa_status, case when coalesce(length(text), 0) < 20 then 'Invalid item for QA generation' when n is null then 'No valid QA pairs generated' end as qa_error, coalesce(n, 0)::int as n from documents left join c using (doc_id)")
def qa_statuses(spark, sf_dir):
    return label.question_arrays(text_of(spark, sf_dir)).select("doc_id", "qa_status", "qa_error", F.size("pairs").alias("n"))


# --- evaluation ----------------------------------------------------------------------------------------------------
@query("select source, count(*) as num_samples, floor(sum(s) + 1e-9)::bigint as num_correct, round(avg(s), 6) as accuracy from (select source, case when contains(text, 'the') then 1.0 else 0.5 end::double as s from documents) group by 1")
def accuracy_by_benchmark(spark, sf_dir):
    score = F.when(F.col("text").contains("the"), 1.0).otherwise(0.5)
    return evaluate.accuracy_by(text_of(spark, sf_dir), "source", score)


def _sql_soft(p: str, answers: list[str]) -> str:
    one = lambda a: f"case when {p} = {a} then 1.0 when contains({a}, {p}) or contains({p}, {a}) then 0.5 else 0.0 end"
    return f"least(1.0, ({' + '.join(map(one, answers))}) / {len(answers)} * 3.0)::double"


@query(f"select conv_id, turn, round({_sql_soft('p', ['a', 'b', 'c'])}, 6) as soft, p = a or p = b or p = c as exact from (select conv_id, turn, lower(role) as p, case when turn = 0 then 'user' else 'assistant' end as a, 'assist' as b, 'system' as c from conversations)")
def vqa_scores(spark, sf_dir):
    """A turn's role guessed from its place, scored softly and exactly."""
    answers = F.array(F.when(F.col("turn") == 0, "user").otherwise("assistant"), F.lit("assist"), F.lit("system"))
    return read(spark, sf_dir, "conversations").select("conv_id", "turn", F.round(evaluate.vqa_score(F.col("role"), answers), 6).alias("soft"), evaluate.exact(F.col("role"), answers).alias("exact"))


@query("select doc_id, case when substr(upper(" + _LOW + "), 1, 1) in ('A', 'B', 'C', 'D') then substr(upper(" + _LOW + "), 1, 1) else '' end as letter, 'Question: ' || lang || chr(10) || 'A. ' || source || chr(10) || 'B. ' || lang || chr(10) || 'Answer:' as prompt, regexp_replace(split_part(text, '. ', -1), '^\\s+|\\s+$', '', 'g') as answer from documents")
def choice_parsing(spark, sf_dir):
    """The letter a text begins with, a multiple-choice prompt, and what follows a text's last mark."""
    prompt = evaluate.choice_prompt(F.col("lang"), F.array("source", "lang"))
    return text_of(spark, sf_dir).select("doc_id", evaluate.choice(F.col("text")).alias("letter"), prompt.alias("prompt"), evaluate.extract_answer(F.col("text"), ". ").alias("answer"))


def _sql_bleu() -> str:
    grams = lambda w, n: f"list_transform(range(1, len({w}) - {n} + 2), lambda i: array_to_string({w}[i:i + {n - 1}], ' '))"
    parts = ", ".join(f"{grams('p', n)} as g{n}, {grams('r', n)} as s{n}" for n in range(1, 5))
    match = lambda n: f"sum(list_sum(list_transform(list_distinct(g{n}), lambda x: least(len(list_filter(g{n}, lambda y: y = x)), len(list_filter(s{n}, lambda y: y = x))))))"
    rows = r"select list_filter(regexp_split_to_array(lower(a.text), '\s+'), lambda x: x <> '') as p, list_filter(regexp_split_to_array(lower(b.text), '\s+'), lambda x: x <> '') as r from benchmark a join benchmark b on b.item_id = a.item_id + 1"
    sums = ", ".join(f"{match(n)} / sum(len(g{n})) as m{n}" for n in range(1, 5))
    penalty = "case when c >= r then 1.0 else exp(1 - r / c) end"
    bleu = lambda n: f"round(coalesce({penalty} * case when least({', '.join(f'm{k}' for k in range(1, n + 1))}) > 0 then exp(({' + '.join(f'ln(nullif(m{k}, 0))' for k in range(1, n + 1))}) / {n}) end, 0), 6)::double as bleu_{n}"
    return f"select {', '.join(map(bleu, range(1, 5)))} from (select sum(len(p)) as c, sum(len(r)) as r, {sums} from (select p, r, {parts} from ({rows})))"


@query(_sql_bleu())
def caption_bleu(spark, sf_dir):
    """Corpus BLEU of each benchmark text against the next."""
    rows = read(spark, sf_dir, "benchmark")
    after = rows.select((F.col("item_id") - 1).alias("item_id"), F.array("text").alias("references"))
    return evaluate.bleu(rows.join(after, "item_id").select(F.col("text").alias("prediction"), "references"))


@query("select event_type, round(quantile_cont(value, 0.5), 6) as p50, round(quantile_cont(value, 0.95), 6) as p95, round(quantile_cont(value, 0.99), 6) as p99 from events group by 1")
def latency_percentiles(spark, sf_dir):
    return evaluate.latencies(read(spark, sf_dir, "events"), "value", "event_type")


@query("select label, count(*) as n, count(*) filter (s >= 0.2) as passes from (select label, list_cosine_similarity(embedding::double[], first(embedding::double[]) over (partition by label order by vec_id rows between unbounded preceding and unbounded following)) as s from embeddings) group by 1")
def similarity_gate(spark, sf_dir):
    """The image-text gate over supplied vectors: cosine with the first vector of the label."""
    rows = read(spark, sf_dir, "embeddings")
    first = rows.groupBy("label").agg(F.min_by("embedding", "vec_id").alias("c"))
    gate = image.clip_gate(image.cosine(F.col("embedding"), F.col("c")))
    return rows.join(first, "label").groupBy("label").agg(F.count("*").alias("n"), F.count_if(gate).alias("passes"))


# --- checks --------------------------------------------------------------------------------------------------------
@query("select lang, count(n_chars) as n, round(avg(n_chars), 6) as mean, round(stddev_samp(n_chars), 6) as spread, round(quantile_cont(n_chars, 0.25), 6) as p25, round(quantile_cont(n_chars, 0.5), 6) as p50, round(quantile_cont(n_chars, 0.75), 6) as p75 from documents group by 1")
def length_distribution(spark, sf_dir):
    return checks.distribution(text_of(spark, sf_dir), "n_chars", "lang")


@query("select doc_id, n_chars from (select doc_id, n_chars, quantile_cont(n_chars, 0.25) over (partition by lang) as a, quantile_cont(n_chars, 0.75) over (partition by lang) as b from documents) where n_chars < a - 1.5 * (b - a) or n_chars > b + 1.5 * (b - a)")
def length_anomalies(spark, sf_dir):
    return checks.anomalies(text_of(spark, sf_dir), "n_chars", "lang").select("doc_id", "n_chars")


@query("select " + ", ".join(f"round(count({c}) / count(*), 6) as {c}" for c in ("doc_id", "text", "lang", "source", "n_chars")) + " from documents")
def completeness(spark, sf_dir):
    return checks.completeness(text_of(spark, sf_dir).select("doc_id", "text", "lang", "source", "n_chars"))


@query("select unnest(list_filter([case when not coalesce(length(text) >= 50, false) then 'too short' end, case when not coalesce(lang in ('en', 'zh'), false) then 'language' end, case when not coalesce(n_chars = length(text), false) then 'length differs' end, case when not coalesce(not contains(text, 'http'), false) then 'links' end], lambda x: x is not null)) as issue, count(*) as n from documents group by 1")
def quality_issues(spark, sf_dir):
    rules = {"too short": F.length("text") >= 50, "language": F.col("lang").isin("en", "zh"), "length differs": F.col("n_chars") == F.length("text"), "links": ~F.col("text").contains("http")}
    return checks.issue_counts(text_of(spark, sf_dir), rules)


# --- the catalog ---------------------------------------------------------------------------------------------------
@query(f"select dataset, 'status' as kind, status as value, count(*) as n from ({_ITEMS}) group by 1, 3 union all select dataset, 'data_type', data_type, count(*) from ({_ITEMS}) group by 1, 3")
def dataset_breakdown(spark, sf_dir):
    maps = store.by_status(items(spark, sf_dir))
    part = lambda c: maps.select("dataset", F.lit(c).alias("kind"), F.explode(f"by_{c}").alias("value", "n"))
    return part("status").union(part("data_type"))


def _datasets(spark, sf_dir):
    return text_of(spark, sf_dir).select(F.col("source").alias("name")).distinct().select(F.concat(F.lit("ds_"), "name").alias("dataset_id"), "name", F.lit("text").alias("data_type"), F.lit("old").alias("description"))


@query("select 'ds_' || name as dataset_id, name, 'text' as data_type, case when name = 'src1' then 'new' else 'old' end as description from (select distinct source as name from documents) union all select 'ds_new', 'added', 'image', 'new'")
def dataset_registration(spark, sf_dir):
    """One dataset registered again (its description changes, its type stays) and one added."""
    new = spark.createDataFrame([("ds_x", "src1", "video", "new"), ("ds_new", "added", "image", "new")], "dataset_id string, name string, data_type string, description string")
    old = _datasets(spark, sf_dir)
    return store.upsert(old, new, "name", ["description"]).select(*old.columns)


@query(f"select item_id, dataset, status from ({_ITEMS}) where dataset is not null and dataset <> 'src1'")
def cascade_delete(spark, sf_dir):
    """The items that are left when a dataset is deleted with what belongs to it."""
    rows = items(spark, sf_dir).withColumn("dataset_id", F.concat(F.lit("ds_"), "dataset"))
    _, left = store.cascade(_datasets(spark, sf_dir), rows, "src1")
    return left.where("dataset is not null").select("item_id", "dataset", "status")


@query(f"select i.item_id, case when l.doc_id is not null then 'labeled' else status end as status, coalesce(l.toxic::varchar, 'none') as toxic, dataset as origin from ({_ITEMS}) i left join (select doc_id, max(toxic) as toxic from labels group by 1) l on i.item_id = l.doc_id::varchar")
def status_update(spark, sf_dir):
    """Labelled items change their status; their metadata is merged."""
    rows = items(spark, sf_dir).withColumn("metadata", F.create_map(F.lit("origin"), "dataset", F.lit("toxic"), F.lit("none")))
    changes = read(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("toxic").alias("toxic")).select(F.col("doc_id").cast("string").alias("item_id"), F.lit("labeled").alias("status"), F.create_map(F.lit("toxic"), F.col("toxic").cast("string")).alias("metadata"))
    out = store.update_status(rows, changes)
    return out.select("item_id", "status", F.col("metadata")["toxic"].alias("toxic"), F.col("metadata")["origin"].alias("origin"))


@query("select doc_id from documents where doc_id not in (select doc_id from labels where doc_id is not null)")
def unlabelled_documents(spark, sf_dir):
    return text_of(spark, sf_dir).join(read(spark, sf_dir, "labels"), "doc_id", "left_anti").select("doc_id")


@query("select event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') as iso, (epoch(ts) - lag(epoch(ts)) over (partition by user_id order by ts, event_id))::bigint as gap, json_extract(props, '$.k')::bigint as k from (select event_id, user_id, date_trunc('second', ts) as ts, props from events)")
def events_time_and_json(spark, sf_dir):
    from pyspark.sql import Window

    ts = F.date_trunc("second", F.col("ts").cast("timestamp"))
    rows = read(spark, sf_dir, "events").withColumn("ts", ts)
    before = F.lag("ts").over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    return rows.select("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("iso"), (F.unix_timestamp("ts") - F.unix_timestamp(before)).alias("gap"), F.from_json("props", "k bigint")["k"].alias("k"))


# --- sources and samples -------------------------------------------------------------------------------------------
@query("select p_name || '#' || p_partkey as full_name, chr(10) || 'Repository: ' || p_name || '#' || p_partkey || chr(10) || 'Description: None' || chr(10) || 'Language: ' || p_brand || chr(10) || 'Stars: ' || p_size || chr(10) || 'URL: /' || p_partkey || chr(10) as text, p_brand as language, p_size::bigint as stars, '/' || p_partkey as url from part where p_size >= 10 order by p_size desc, full_name limit 100")
def repositories_top(spark, sf_dir):
    """The repository source's report over parts: 100 of most stars."""
    name = F.concat("p_name", F.lit("#"), F.col("p_partkey").cast("string"))
    rows = read(spark, sf_dir, "part").select(name.alias("full_name"), F.lit(None).cast("string").alias("description"), F.col("p_brand").alias("language"), F.col("p_size").cast("bigint").alias("stargazers_count"), F.concat(F.lit("/"), F.col("p_partkey").cast("string")).alias("html_url"))
    return readers.repositories(rows)


@query("select doc_id, md5(doc_id || ':42:3') as rank_key from documents")
def epoch_shuffle(spark, sf_dir):
    return sample.shuffled(text_of(spark, sf_dir), "doc_id", 3).select("doc_id", "rank_key")


@query("select (n_chars >= 200)::int + (n_chars >= 2000)::int + (n_chars >= 20000)::int as stage, count(*) as n from documents group by 1")
def curriculum_stages(spark, sf_dir):
    return sample.curriculum(text_of(spark, sf_dir), F.col("n_chars"), [200, 2000, 20000]).groupBy("stage").agg(F.count("*").alias("n"))


@query("select source_name, id from (select 'documents' as source_name, doc_id as id, ('0x' || substr(md5(doc_id::varchar || ':42'), 1, 13))::bigint / 4503599627370496.0 as p from documents union all select 'benchmark', item_id, ('0x' || substr(md5(item_id::varchar || ':42'), 1, 13))::bigint / 4503599627370496.0 from benchmark) where p < case source_name when 'documents' then 0.25 else 0.75 end")
def interleaved_sources(spark, sf_dir):
    parts = {"documents": text_of(spark, sf_dir).select(F.col("doc_id").alias("id")), "benchmark": read(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"))}
    return sample.interleaved(parts, "id", {"documents": 0.25, "benchmark": 0.75}).select("source_name", "id")


@query("select '<image>' || chr(10) || text as sample, item_id from benchmark")
def image_text_samples(spark, sf_dir):
    from sparkloom.operators import tokenize

    return read(spark, sf_dir, "benchmark").select(tokenize.image_text_sample(F.col("text")).alias("sample"), "item_id")


# --- batches and masks ---------------------------------------------------------------------------------------------
_LENGTHS = r"list_transform(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> ''), lambda x: length(x)::int)"


@query(f"with r as (select item_id, item_id % 7 as batch, {_LENGTHS} as ids from benchmark), m as (select batch, max(len(ids)) as n from r group by 1) select item_id, array_to_string(list_concat(ids, list_transform(range(0, n - len(ids)), lambda x: 0)), ' ') as padded_ids, array_to_string(list_concat(ids, list_transform(range(0, n - len(ids)), lambda x: -100)), ' ') as labels, list_sum(list_concat(list_transform(ids, lambda x: 1), list_transform(range(0, n - len(ids)), lambda x: 0)))::bigint as attended from r join m using (batch)")
def collated_batches(spark, sf_dir):
    """Batches padded to their longest row: ids with 0, labels with the ignored value, the mask with 0 (word lengths stand in for ids)."""
    from sparkloom.operators import tokenize

    ids = F.transform(T.words(F.col("text")), lambda w: F.length(w))
    rows = read(spark, sf_dir, "benchmark").select("item_id", (F.col("item_id") % 7).alias("batch"), ids.alias("input_ids"))
    joined = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), " ")
    out = tokenize.collate(rows, "batch")
    return out.select("item_id", joined("padded_ids").alias("padded_ids"), joined("labels").alias("labels"), F.aggregate("attention_mask", F.lit(0).cast("bigint"), lambda s, x: s + x).alias("attended"))


@query(f"select conv_id, string_agg(case when role = 'assistant' then array_to_string({_LENGTHS}, ' ') else array_to_string(list_transform({_LENGTHS}, lambda x: -100), ' ') end, ' ' order by turn) as labels from conversations group by 1")
def sft_label_masks(spark, sf_dir):
    """Labels of conversations: the answers' ids, the ignored value elsewhere."""
    from sparkloom.operators import chat, tokenize

    messages = F.transform("messages", lambda m: F.struct(m["role"].alias("role"), F.transform(T.words(m["text"]), lambda w: F.length(w)).alias("ids")))
    labels = tokenize.masked_labels(messages)
    return chat.assemble(read(spark, sf_dir, "conversations")).select("conv_id", F.array_join(F.transform(labels, lambda x: x.cast("string")), " ").alias("labels"))


@query(r"""select item_id, len(a) as n_ids, array_to_string(a, ' ') as input_ids, len(ids) + 2 > 20 as truncated from (select item_id, ids, list_concat(list_slice(list_concat([1], ids, [2]), 1, 20), list_transform(range(0, greatest(0, 20 - len(ids) - 2)), lambda x: 0)) as a from (select item_id, """ + _LENGTHS + r""" as ids from benchmark))""")
def sized_sequences(spark, sf_dir):
    """Special tokens added, cut and padded to a length (word lengths stand in for ids)."""
    from sparkloom.operators import tokenize

    ids = F.transform(T.words(F.col("text")), lambda w: F.length(w))
    parts = tokenize.sized(ids, 20, pad=0, bos=1, eos=2)
    return read(spark, sf_dir, "benchmark").select("item_id", F.size(parts["input_ids"]).alias("n_ids"), F.array_join(F.transform(parts["input_ids"], lambda x: x.cast("string")), " ").alias("input_ids"), parts["truncated"].alias("truncated"))


@query("select name, total, done, case when total > 0 then done / total * 100.0 else 0.0 end as percent from (select source as name, count(*) as total, count(*) filter (length(text) >= 50) as done from documents group by 1)")
def stage_progress(spark, sf_dir):
    from sparkloom.plans import stages

    rows = text_of(spark, sf_dir).groupBy(F.col("source").alias("name")).agg(F.count("*").alias("total"), F.count_if(F.length("text") >= 50).alias("done"))
    return rows.select("name", "total", "done", stages.progress(F.col("done"), F.col("total")).alias("percent"))


@query("select item_id, coalesce(json_array_length(nullif(regexp_extract(a, '(?s)\\[.*\\]'), '')), 0)::int as n from (select item_id, case when item_id % 2 = 0 then 'Sure: [{\"question\": \"q\", \"answer\": \"a\"}, {\"question\": \"r\", \"answer\": \"b\"}] done' else text end as a from benchmark)")
def parsed_answers(spark, sf_dir):
    """Question-answer pairs read from answers in JSON; none where there is no array."""
    from sparkloom.operators import hooks

    answer = F.when(F.col("item_id") % 2 == 0, 'Sure: [{"question": "q", "answer": "a"}, {"question": "r", "answer": "b"}] done').otherwise(F.col("text"))
    return read(spark, sf_dir, "benchmark").select("item_id", F.size(hooks.parsed_pairs(answer)).alias("n"))
