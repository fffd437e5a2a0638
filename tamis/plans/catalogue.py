"""Registered queries over the driver's tables, each with its DuckDB counterpart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tamis.functions import text as T
from tamis.operators import evalset, evaluation, filters, sessions, stats

QUERIES = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str, *tables: str):
    """Registers a function of tables as a query over a folder of them, with its SQL."""

    def register(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(*[spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables])

        QUERIES[f.__name__], ORACLE_SQL[f.__name__] = run, sql
        run.__name__ = f.__name__
        return f

    return register


FEATURES = """
  select conv_id, count(*) as n_messages, count(*) filter (role = 'user') as n_users, count(*) filter (role = 'assistant') as n_assistants,
    count(*) filter (role = 'tool') as n_tools, cast(sum(length(coalesce(text, ''))) as bigint) as n_chars,
    case when count(*) filter (role = 'user') >= 2 then 'question-multi' when count(*) filter (role = 'tool') > 0 then 'question-answer-tool-call'
      when count(*) filter (role = 'assistant') > 0 then 'question-answer' else 'question' end as category
  from conversations group by conv_id"""


@query(f"select conv_id, category from ({FEATURES})", "conversations")
def session_category(c):
    return sessions.features(c).select("conv_id", "category")


@query(f"select category, count(*) as n, cast(sum(n_messages) as bigint) as messages, cast(sum(n_chars) as bigint) as chars from ({FEATURES}) group by category", "conversations")
def session_category_counts(c):
    return sessions.features(c).groupBy("category").agg(F.count(F.lit(1)).alias("n"), F.sum("n_messages").alias("messages"), F.sum("n_chars").alias("chars"))


def _bins(value: str, bins, below: bool = False) -> str:
    return "case " + " ".join(f"when {value} {'<' if below else '<='} {u} then '{n}'" for u, n in bins[:-1]) + f" else '{bins[-1][1]}' end"


def _hist(source: str, value: str, bins, below: bool = False) -> str:
    names = ", ".join(f"({i}, '{b[1]}')" for i, b in enumerate(bins))
    return f"select t.ord, t.bin, coalesce(c.n, 0) as n from (values {names}) t(ord, bin) left join (select {_bins(value, bins, below)} as bin, count(*) as n from ({source}) s group by 1) c on c.bin = t.bin"


@query(_hist(FEATURES, "n_users", stats.TURN_BINS), "conversations")
def session_turn_histogram(c):
    return stats.histogram(sessions.features(c), F.col("n_users"), stats.TURN_BINS)


@query(_hist(FEATURES, "n_messages", stats.MESSAGE_BINS), "conversations")
def session_message_histogram(c):
    return stats.histogram(sessions.features(c), F.col("n_messages"), stats.MESSAGE_BINS)


@query(_hist(FEATURES, "n_chars", stats.CHAR_BINS, True), "conversations")
def session_char_histogram(c):
    return stats.histogram(sessions.features(c), F.col("n_chars"), stats.CHAR_BINS, below=True)


@query("select conv_id, string_agg(text, chr(10) order by turn) as question from conversations where role = 'user' group by conv_id", "conversations")
def session_question_view(c):
    ordered = F.array_sort(F.collect_list(F.struct("turn", "text")))
    return c.where("role = 'user'").groupBy("conv_id").agg(F.concat_ws("\n", F.transform(ordered, lambda m: m["text"])).alias("question"))


@query("select conv_id, arg_min(text, turn) as first_user from conversations where role = 'user' group by conv_id", "conversations")
def session_first_user(c):
    return sessions.first_user(c)


@query("select role, count(*) as n, count(distinct conv_id) as n_sessions from conversations group by role", "conversations")
def session_roles(c):
    return c.groupBy("role").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("conv_id").alias("n_sessions"))


@query("""
  with m as (select *, case when lag(role) over w is not distinct from role then 0 else 1 end as s from conversations window w as (partition by conv_id order by turn)),
  i as (select *, cast(sum(s) over (partition by conv_id order by turn) as bigint) as island from m)
  select conv_id, island, role, count(*) as n, string_agg(text, chr(10) order by turn) as text from i group by conv_id, island, role""", "conversations")
def session_islands(c):
    return sessions.islands(c)


@query("""select user_id, event_id, cast(sum(case when event_type = 'signup' then 1 else 0 end) over (partition by user_id order by ts, event_id) as bigint) as segment from events""", "events")
def event_segments(e):
    return sessions.segments(e, "user_id", ["ts", "event_id"], F.col("event_type") == "signup").select("user_id", "event_id", "segment")


@query("""select user_id, event_id, coalesce(last_value(case when event_type = 'signup' then event_id end ignore nulls)
  over (partition by user_id order by ts, event_id rows unbounded preceding), -1) as filled from events""", "events")
def event_forward_fill(e):
    return sessions.filled(e, "user_id", ["ts", "event_id"], F.when(F.col("event_type") == "signup", F.col("event_id")), -1).select("user_id", "event_id", "filled")


BUCKET = "case when coalesce(lang, '') = '' then 'unlabeled' when lang in ('zh', 'en') then 'zh-en' else 'other-lang' end"


@query(f"select doc_id, {BUCKET} as bucket from documents", "documents")
def doc_lang_bucket(d):
    return d.select("doc_id", T.lang_bucket(F.col("lang")).alias("bucket"))


@query(f"""select {BUCKET} as bucket, source, lang, count(*) as records, cast(sum(length(coalesce(text, ''))) as bigint) as chars,
  count(*) filter (regexp_matches(coalesce(text, ''), '[٠-٩۰-۹০-৯౦-౯๐-๙०-९૦-૯၀-၉]')) as other_digits from documents group by 1, 2, 3""", "documents")
def doc_split_report(d):
    return d.groupBy(T.lang_bucket(F.col("lang")).alias("bucket"), "source", "lang").agg(
        F.count(F.lit(1)).alias("records"), F.sum(F.length(F.coalesce("text", F.lit("")))).alias("chars"), F.count_if(T.has_other_digit(F.col("text"))).alias("other_digits"))


@query("""select lang, count(*) as n, count(*) * 1.0 / sum(count(*)) over () as share, avg(n_chars) as mean_chars from documents group by lang""", "documents")
def doc_lang_share(d):
    g = d.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.avg("n_chars").alias("mean_chars"))
    return g.select("lang", "n", (F.col("n") / F.sum("n").over(W.partitionBy())).alias("share"), "mean_chars")


@query(_hist("select length(coalesce(text, '')) as v from documents", "v", stats.LENGTH_BINS), "documents")
def doc_length_hist(d):
    return stats.histogram(d, F.length(F.coalesce("text", F.lit(""))), stats.LENGTH_BINS)


@query(_hist("select n_chars as v from documents", "v", stats.CHAR_BINS, True), "documents")
def doc_char_hist(d):
    return stats.histogram(d, F.col("n_chars"), stats.CHAR_BINS, below=True)


@query("""select doc_id, case when trim(substr(text, 1, 800), ' ' || chr(9) || chr(10) || chr(13)) = '' then 'other'
  when len(regexp_extract_all(substr(text, 1, 800), '[一-鿿㐀-䶿]')) * 1.0 / length(substr(text, 1, 800)) >= 0.15 then 'zh' else 'en' end as detected from documents""", "documents")
def doc_detect_lang(d):
    return d.select("doc_id", T.detect_lang(F.col("text")).alias("detected"))


@query("select lang, count(*) as n, cast(sum(cast(floor(length(text) / 3.0) as bigint)) as bigint) as tokens from documents where lang not in ('', 'zh', 'en') group by lang", "documents")
def doc_token_estimate(d):
    t = d.where("lang not in ('', 'zh', 'en')").select("lang", T.est_tokens(F.length("text"), F.col("lang")).alias("t"))
    return t.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum("t").alias("tokens"))


NORM = "lower(trim(regexp_replace(coalesce(text, ''), '[\\s\\x0b]+', ' ', 'g')))"


@query(f"select doc_id, md5({NORM}) as key from documents", "documents")
def doc_norm_key(d):
    return d.select("doc_id", F.md5(T.norm_question(F.col("text"))).alias("key"))


@query(f"select lang, min(doc_id) as doc_id, count(*) as copies from documents group by lang, md5({NORM})", "documents")
def doc_dedupe_first(d):
    key = F.md5(T.norm_question(F.col("text")))  # texts stay out of the shuffle
    return d.groupBy("lang", key.alias("key")).agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies")).drop("key")


@query(f"select copies, count(*) as groups from (select count(*) as copies from documents group by md5({NORM})) group by copies", "documents")
def doc_copy_groups(d):
    g = d.groupBy(F.md5(T.norm_question(F.col("text"))).alias("key")).agg(F.count(F.lit(1)).alias("copies"))
    return g.groupBy("copies").agg(F.count(F.lit(1)).alias("groups"))


REASON = "case when l.doc_id is null then 'unlabelled' when length(d.text) < 200 then 'too_short' when l.quality = 0 then 'low_quality' when l.toxic = 1 then 'toxic' end"


def _reasons(d, labels):
    reason = F.when(F.col("quality").isNull(), "unlabelled").when(F.length("text") < 200, "too_short").when(F.col("quality") == 0, "low_quality").when(F.col("toxic") == 1, "toxic")
    return d.join(labels, "doc_id", "left").select("doc_id", "source", "lang", reason.alias("reason"))


@query(f"select d.doc_id, {REASON} as reason from documents d left join labels l using (doc_id)", "documents", "labels")
def doc_clean_reasons(d, labels):
    return _reasons(d, labels).select("doc_id", "reason")


@query(f"select reason, count(*) as n from (select {REASON} as reason from documents d left join labels l using (doc_id)) where reason is not null group by reason", "documents", "labels")
def doc_reject_hist(d, labels):
    return _reasons(d, labels).where("reason is not null").groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query(f"""select source, count(*) as raw, count(*) filter (reason = 'unlabelled') as unlabelled, count(*) filter (reason = 'too_short') as too_short,
  count(*) filter (reason = 'low_quality') as low_quality, count(*) filter (reason = 'toxic') as toxic, count(*) filter (reason is null) as usable,
  least(count(*) filter (reason is null), 10) as picked
  from (select d.source, {REASON} as reason from documents d left join labels l using (doc_id)) group by source""", "documents", "labels")
def doc_funnel(d, labels):
    is_ = lambda r: F.count_if(F.col("reason") == r).alias(r)
    usable = F.count_if(F.col("reason").isNull())
    return _reasons(d, labels).groupBy("source").agg(
        F.count(F.lit(1)).alias("raw"), is_("unlabelled"), is_("too_short"), is_("low_quality"), is_("toxic"), usable.alias("usable"), F.least(usable, F.lit(10)).alias("picked"))


SAMPLE_KEY = "md5('42::' || source || '::' || doc_id)"


@query(f"select doc_id, {SAMPLE_KEY} as key from documents order by key, doc_id limit 50", "documents")
def doc_stable_sample(d):
    return d.select("doc_id", evalset.sample_key(42, "source", "doc_id").alias("key")).orderBy("key", "doc_id").limit(50)


BIN = _bins("length(coalesce(text, ''))", stats.LENGTH_BINS)
STRATIFIED = f"""
  with a as (select doc_id, source, lang, {BIN} as bin, {SAMPLE_KEY} as key from documents),
  b as (select *, row_number() over (partition by source, lang, bin order by key, doc_id) as i, count(*) over (partition by source, lang, bin) as stratum_n,
    min(doc_id) over (partition by source, lang, bin) as stratum_first from a),
  c as (select *, row_number() over (partition by source order by i, stratum_n desc, stratum_first) as pick from b)
  select doc_id, source, lang, bin, pick from c where pick <= least(20, case source when 'src0' then 5 when 'src1' then 12 else 20 end)"""


def _stratified(d):
    names = F.lit(stats.LENGTH_BINS[-1][1])
    for upper, label in reversed(stats.LENGTH_BINS[:-1]):
        names = F.when(F.length(F.coalesce("text", F.lit(""))) <= upper, label).otherwise(names)
    narrow = d.select("doc_id", "source", "lang", names.alias("bin"))
    picked = evalset.stratified(narrow, "source", ["lang", "bin"], evalset.sample_key(42, "source", "doc_id"), "doc_id", 20)
    return evalset.capped(picked, "source", {"src0": 5, "src1": 12}, 20)


@query(STRATIFIED, "documents")
def doc_stratified_sample(d):
    return _stratified(d).select("doc_id", "source", "lang", "bin", F.col("pick").cast("long").alias("pick"))


@query(f"""select d.source, d.pool, s.picked from (select source, count(*) as pool from documents group by source) d
  join (select source, count(*) as picked from ({STRATIFIED}) group by source) s using (source)""", "documents")
def doc_cap_table(d):
    pool = d.groupBy("source").agg(F.count(F.lit(1)).alias("pool"))
    return pool.join(_stratified(d).groupBy("source").agg(F.count(F.lit(1)).alias("picked")), "source")


@query("""select source, count(*) filter (lang = 'en') as en, count(*) filter (lang = 'de') as de, count(*) filter (lang = 'fr') as fr, count(*) filter (lang = 'es') as es, count(*) as total
  from documents group by source""", "documents")
def doc_source_matrix(d):
    return stats.matrix(d, "source", "lang", ["en", "de", "fr", "es"])


@query("select source as value, count(*) as n from documents group by source order by n desc, value limit 14", "documents")
def doc_top_sources(d):
    return stats.value_counts(d, "source").orderBy(F.desc("n"), "value").limit(14)


@query("select source, lang, count(*) as n from documents group by source, lang", "documents")
def doc_crosstab(d):
    return stats.cross(d, "source", "lang")


@query("""with x as (select coalesce(nullif(source, ''), 'unknown') as a, coalesce(nullif(lang, ''), 'unknown') as b, case when n_chars > 2000 then 'long' else 'short' end as c from documents)
  select 0 as level, a as source, b as target, count(*) as value from x group by a, b union all select 1, b, c, count(*) from x group by b, c""", "documents")
def doc_links(d):
    return stats.links(d.withColumn("size", F.when(F.col("n_chars") > 2000, "long").otherwise("short")), "source", "lang", "size")


@query("select doc_id, source || '-' || lpad(cast(row_number() over (partition by source order by doc_id) - 1 as varchar), 6, '0') as id from documents", "documents")
def doc_seq_ids(d):
    return evalset.seq_ids(d.select("doc_id", "source"), "source", ["doc_id"]).select("doc_id", "id")


@query(f"""with p as ({STRATIFIED}) select doc_id, source || '-' || lpad(cast(row_number() over (order by source, md5('42::' || source || '::' || doc_id)) - 1 as varchar), 5, '0') as id from p""", "documents")
def doc_running_ids(d):
    p = _stratified(d).select("doc_id", "source", evalset.sample_key(42, "source", "doc_id").alias("key"))
    n = F.row_number().over(W.orderBy("source", "key")) - 1  # over the capped sample only
    return p.select("doc_id", F.concat("source", F.lit("-"), F.lpad(n.cast("string"), 5, "0")).alias("id"))


@query(f"""with a as (select doc_id, lang, source, row_number() over (partition by lang, source order by {SAMPLE_KEY}, doc_id) as i from documents where lang not in ('', 'zh', 'en')),
  b as (select *, row_number() over (partition by lang order by i, source) as pick from a) select doc_id, lang, source, pick from b where pick <= 25""", "documents")
def doc_quota_by_lang(d):
    rows = d.where("lang not in ('', 'zh', 'en')").select("doc_id", "lang", "source")
    return evalset.quota_sample(rows, "lang", "source", evalset.sample_key(42, "source", "doc_id"), "doc_id", 25).select("doc_id", "lang", "source", F.col("pick").cast("long").alias("pick"))


@query("""select source, count(*) as n_rows, count(*) filter (coalesce(text, '') = '') as empty_text, count(*) filter (coalesce(lang, '') = '') as empty_lang,
  count(*) - count(distinct doc_id) as duplicate_ids, count(*) filter (n_chars <> length(text)) as wrong_length from documents group by source""", "documents")
def doc_review(d):
    empty = lambda c: F.count_if(F.coalesce(c, F.lit("")) == "")
    return d.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_rows"), empty("text").alias("empty_text"), empty("lang").alias("empty_lang"),
        (F.count(F.lit(1)) - F.countDistinct("doc_id")).alias("duplicate_ids"), F.count_if(F.col("n_chars") != F.length("text")).alias("wrong_length"))


def _item_keys(b):
    return b.select(F.md5(T.norm_question(F.col("text"))).alias("key")).distinct()


@query(f"select doc_id from documents where md5({NORM}) in (select md5({NORM}) from benchmark)", "documents", "benchmark")
def bench_overlap(d, b):
    keyed = d.select("doc_id", F.md5(T.norm_question(F.col("text"))).alias("key"))
    return keyed.join(_item_keys(b), "key", "left_semi").select("doc_id")


LINE_NORM = NORM.replace("coalesce(text, '')", "line")


@query(f"""with i as (select distinct {LINE_NORM} as k from (select unnest(string_split(text, chr(10))) as line from benchmark) where length(line) > 30),
  l as (select doc_id, {LINE_NORM} as k from (select doc_id, unnest(string_split(text, chr(10))) as line from documents) where length(line) > 30)
  select doc_id, count(*) as lines from l where k in (select k from i) group by doc_id""", "documents", "benchmark")
def bench_line_overlap(d, b):
    key = F.md5(T.norm_question(F.col("line"))).alias("key")
    lines = lambda x, *keep: x.select(*keep, F.explode(F.split("text", "\n")).alias("line")).where(F.length("line") > 30).select(*keep, key)
    return lines(d, "doc_id").join(lines(b).distinct(), "key", "left_semi").groupBy("doc_id").agg(F.count(F.lit(1)).alias("lines"))


@query(f"select lang, count(*) as n from documents where md5({NORM}) not in (select md5({NORM}) from benchmark) group by lang", "documents", "benchmark")
def bench_isolated(d, b):
    keyed = d.select("lang", F.md5(T.norm_question(F.col("text"))).alias("key"))
    return keyed.join(_item_keys(b), "key", "left_anti").groupBy("lang").agg(F.count(F.lit(1)).alias("n"))


@query("select d.doc_id, l.quality, l.toxic from documents d left join labels l using (doc_id)", "documents", "labels")
def doc_labels_left(d, labels):
    return d.select("doc_id").join(labels, "doc_id", "left").select("doc_id", "quality", "toxic")


@query("select doc_id from documents where doc_id not in (select doc_id from labels)", "documents", "labels")
def doc_unlabelled(d, labels):
    return d.select("doc_id").join(labels, "doc_id", "left_anti")


@query("select o_orderkey from orders where o_orderstatus = 'F' and o_totalprice >= 250000", "orders")
def filter_conjunction(o):
    return filters.where(o, "o_orderstatus = F", "o_totalprice >= 250000").select("o_orderkey")


@query("select doc_id from documents where regexp_matches(text, 'license|License') and lang <> 'en'", "documents")
def filter_regex(d):
    return filters.where(d, "text ~ 'license|License'", "lang != en").select("doc_id")


@query("select event_id from events where event_id % 3 = 0 and event_id % 5 <> 0", "events")
def filter_partly_missing(e):
    present = e.select("event_id", F.to_json(F.struct(F.when(F.col("event_id") % 3 == 0, F.col("event_id") % 5).alias("m"))).alias("j"))
    return filters.where(present, "m != 0", json_column="j").select("event_id")


@query("select doc_id from documents where length(text) > 5000", "documents")
def filter_length(d):
    return filters.where(d, "len(text) > 5000").select("doc_id")


@query("select event_id from events where cast(json_extract_string(props, '$.k') as double) >= 50", "events")
def filter_json_number(e):
    return filters.where(e, "k >= 50", json_column="props").select("event_id")


@query("select event_id from events where json_extract_string(props, '$.nope') <> '5'", "events")
def filter_missing(e):
    return filters.where(e, "nope != 5", json_column="props").select("event_id")


@query("select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 20", "orders")
def sort_numeric_limit(o):
    return o.orderBy(filters.ordering(o, "o_totalprice", True), "o_orderkey").limit(20).select("o_orderkey", "o_totalprice")


@query("select o_orderkey, o_orderpriority from orders order by o_orderpriority, o_orderkey limit 20", "orders")
def sort_text_limit(o):
    return o.orderBy(filters.ordering(o, "o_orderpriority"), "o_orderkey").limit(20).select("o_orderkey", "o_orderpriority")


@query("select event_id from events order by md5('7:' || event_id), event_id limit 100", "events")
def sample_rows(e):
    return filters.sample_n(e, 100, 7, "event_id").select("event_id")


@query("select event_id from events order by md5('7:' || event_id), event_id limit (select cast(floor(count(*) * 10 / 100.0 + 0.5) as bigint) from events)", "events")
def sample_percent(e):
    return filters.sample_share(e, 10, 7, "event_id").select("event_id")


@query(f"""with u as (select lang, doc_id, text from documents union all select cast(null as varchar), item_id, text from benchmark)
  select lang, min(doc_id) as doc_id from u group by lang, md5({NORM})""", "documents", "benchmark")
def union_dedupe(d, b):
    u = d.select("lang", "doc_id", "text").unionByName(b.select(F.lit(None).cast("string").alias("lang"), F.col("item_id").alias("doc_id"), "text"))
    return u.groupBy("lang", F.md5(T.norm_question(F.col("text"))).alias("key")).agg(F.min("doc_id").alias("doc_id")).drop("key")


@query("select coalesce(o_orderpriority, '') as value, count(*) as n from orders group by 1", "orders")
def value_counts_orders(o):
    return stats.value_counts(o, "o_orderpriority")


@query("select coalesce(p_brand, '') as value, count(*) as n from part group by 1", "part")
def value_counts_part(p):
    return stats.value_counts(p, "p_brand")


@query("select coalesce(c_mktsegment, '') as value, count(*) as n from customer group by 1", "customer")
def value_counts_customer(c):
    return stats.value_counts(c, "c_mktsegment")


@query("select event_id, cast(json_extract_string(props, '$.k') as bigint) as k from events", "events")
def json_field(e):
    return e.select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


WIDE = """select l_orderkey, l_linenumber, 'quantity' as candidate, l_quantity / 50.0 as value from lineitem
  union all select l_orderkey, l_linenumber, 'discount', l_discount * 10.0 from lineitem"""


def _wide(li):
    return li.select("l_orderkey", "l_linenumber", (F.col("l_quantity") / 50.0).alias("answer_quantity"), (F.col("l_discount") * 10.0).alias("answer_discount"))


@query(WIDE, "lineitem")
def unpivot_candidates(li):
    return evaluation.candidates(_wide(li), ["l_orderkey", "l_linenumber"], "answer_(.+)")


@query(f"select candidate, count(value) as scored, count(*) filter (value is null) as failed, round(avg(value), 6) as avg_score, round(avg(case when value >= 0.6 then 1.0 else 0.0 end), 6) as pass_rate from ({WIDE}) group by candidate", "lineitem")
def candidate_pass_rates(li):
    r = evaluation.pass_rates(evaluation.candidates(_wide(li), ["l_orderkey", "l_linenumber"], "answer_(.+)"), "candidate", "value", 0.6)
    return r.withColumns({c: F.round(c, 6) for c in ("avg_score", "pass_rate")})


@query("select l_returnflag, count(*) as n, round(avg(l_quantity / 50.0 * 0.75 + l_discount * 10.0 * 0.25), 6) as score from lineitem group by l_returnflag", "lineitem")
def weighted_score(li):
    s = evaluation.weighted({"q": F.col("l_quantity") / 50.0, "d": F.col("l_discount") * 10.0}, {"q": 3.0, "d": 1.0})
    return li.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(s), 6).alias("score"))


@query("select page_id, regexp_replace(regexp_replace(url, '[^A-Za-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') as slug from pages", "pages")
def page_slug(p):
    return p.select("page_id", T.field_slug(F.col("url")).alias("slug"))
