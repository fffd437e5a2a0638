"""Queries of ingest, sinks, profiles, manifests, totals and plug-ins, with their SQL. Files they read back are written from the tables into the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tamis.functions import text as T
from tamis.operators import evalbuild, manifest, plugins, profile, sessions, stats, translation, vectors
from tamis.operators.evalset import numbered
from tamis.plans import evalset_queries
from tamis.plans.catalogue import BUCKET
from tamis.scratch import scratch_folder, written
from tamis.sources import export
from tamis.sources.byte_ranges import register
from tamis.sources.json_index import elements
from tamis.sources.readers import numbered_lines

QUERIES = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None, *tables: str):
    def register(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(*[spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables])

        QUERIES[f.__name__] = run
        if sql:
            ORACLE_SQL[f.__name__] = sql
        run.__name__ = f.__name__
        return f

    return register


def _folder(df: DataFrame, name: str) -> str:
    return f"{scratch_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"


WHY = "case when lang is null or lang = '' then 'no_language' when length(coalesce(text, '')) < 200 then 'too_short' when source = 'src3' then 'left_out' end"


@query(f"""with d as (select *, coalesce({WHY}, 'written') as outcome from documents), c as (select outcome, count(*) as n from d group by 1)
  select 'rows' as what, count(*) as n, count(*) as found from d union all select 'chars', coalesce(cast(sum(length(text)) as bigint), 0), coalesce(cast(sum(length(text)) as bigint), 0) from d where outcome = 'written'
  union all select v, coalesce(n, 0), coalesce(n, 0) from (values ('written'), ('no_language'), ('too_short'), ('other')) x(v) left join (select case outcome when 'left_out' then 'other' else outcome end as outcome, sum(n)::bigint as n from c group by 1) y on v = outcome""", "documents")
def sink_counts(d):
    """Counts observed while a sink writes documents by outcome, beside a recount of what stands there."""
    path = _folder(d, "sink")
    counts = export.write_counted(d.select("doc_id", "text", F.expr(WHY).alias("why")), path, "why", ["no_language", "too_short"], ["text"])
    back = d.sparkSession.read.schema("doc_id long, text string, outcome string").json(path)
    code = F.when(F.col("outcome").isin("written", "no_language", "too_short"), F.col("outcome")).otherwise("other")
    cells = [F.lit("rows"), F.when(F.col("outcome").isNotNull(), code)]
    recount = back.select(F.explode(F.array(*cells)).alias("what")).groupBy("what").agg(F.count(F.lit(1)).alias("found"))
    recount = recount.unionByName(back.where("outcome = 'written'").agg(F.lit("chars").alias("what"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("found")))
    seen = d.sparkSession.createDataFrame(list(counts.items()), "what string, n long")  # six counts
    return seen.join(recount, "what", "left").select("what", "n", F.coalesce("found", F.lit(0)).cast("long").alias("found"))


@query("""select row_number() over (order by coalesce(lang, ''), doc_id) as k, '"' || doc_id || '"' as "row", replace(coalesce(text, ''), chr(13), '') as text from documents""", "documents")
def export_ordered(d):
    """An export in the order of language and id, its parts read back one after the other: the place of each row in the whole."""
    path = _folder(d, "export") + ".jsonl"
    rows = d.select(F.coalesce("lang", F.lit("")).alias("lang"), F.col("doc_id").cast("string").alias("doc_id"), F.regexp_replace(F.coalesce("text", F.lit("")), "\r", "").alias("text"))
    export.export(rows, path, order=["lang", F.col("doc_id").cast("long")])
    lines = numbered_lines(d.sparkSession, path).select(F.regexp_extract("file", r"part-(\d+)", 1).cast("long").alias("part"), "line", "value")
    sizes = lines.groupBy("part").agg(F.max("line").alias("n"))
    before = sizes.select("part", F.coalesce(F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))  # a row a part
    v = F.from_json("value", "doc_id string, text string")
    return lines.join(before, "part").select((F.col("before") + F.col("line")).alias("k"), F.concat(F.lit('"'), v["doc_id"], F.lit('"')).alias("row"), v["text"].alias("text"))


@query("""with l as (select case when doc_id % 9 = 0 then '{"t": ' when doc_id % 10 = 0 then ' ' when doc_id % 11 = 0 then '[1]' else '{"t":"' || coalesce(lang, '') || '"}' end as v from documents)
  select cast(sum(octet_length(encode(v)) + 1) as bigint) as bytes, count(*) filter (trim(v) = '') as blank, count(*) filter (v = '[1]' or v = '{"t": ') as bad, count(*) filter (v like '%}') as records, count(*) filter (v like '%}') as found from l""", "documents")
def line_policy(d):
    """Lines of which some are blank, broken or no objects: written, read by byte ranges, counted in the pass that reads them."""
    path, spark = _folder(d, "lines"), d.sparkSession
    value = "case when doc_id % 9 = 0 then '{\"t\": ' when doc_id % 10 = 0 then ' ' when doc_id % 11 = 0 then '[1]' else '{\"t\":\"' || coalesce(lang, '') || '\"}' end"
    d.selectExpr(f"{value} as value").write.text(path)
    register(spark)
    good, seen = export.line_counts(spark.read.format("tamis_lines").option("block", 1 << 16).load(path).select("value"))
    found = good.count()
    return spark.createDataFrame([(*[seen.get[k] for k in ("bytes", "blank", "bad", "records")], found)], "bytes long, blank long, bad long, records long, found long")


@query("""with p as (select doc_id, coalesce(lang, '') as lang, coalesce(text, '') as text from documents), n as (select *, row_number() over (partition by lang order by doc_id) - 1 as n from p)
  select lang || '-' || n // 5000 as file, n % 5000 as "at", doc_id, text from n""", "documents")
def array_elements(d):
    """JSON arrays of 5,000 rows of a language, written as files and read back through the structural index in blocks of 256 KB."""
    path, spark, each = _folder(d, "arrays"), d.sparkSession, 5_000
    rows = d.select(F.coalesce("lang", F.lit("")).alias("lang"), F.to_json(F.struct("doc_id", F.coalesce("text", F.lit("")).alias("text"))).alias("j"), "doc_id")
    placed = numbered(rows, "lang", ["doc_id"]).withColumns({"file": F.concat("lang", F.lit("-"), F.floor(F.col("n") / each).cast("string")), "at": F.col("n") % each})
    # Lines that make up one array a file: the first opens it, every other begins with a comma. The window leaves a file's rows in one task, in order.
    last = F.lead("at").over(W.partitionBy("file").orderBy("at")).isNull()
    lines = placed.select("file", F.concat(F.when(F.col("at") == 0, "[").otherwise(","), "j", F.when(last, "]").otherwise("")).alias("value"))
    lines.write.partitionBy("file").text(path)
    v = F.from_json("value", "doc_id long, text string")
    return elements(spark, path, block=1 << 18).select(F.regexp_extract("file", r"file=([^/]*)/", 1).alias("file"), "at", v["doc_id"].alias("doc_id"), v["text"].alias("text"))


# --- totals -------------------------------------------------------------------------------------


@query(f"""with d as (select {BUCKET} as bucket, coalesce(source, '') as source, lang, length(coalesce(text, '')) as c from documents)
  select source, bucket, grouping(source, bucket) as level, count(*) as n, cast(sum(c) as bigint) as chars, count(distinct lang) as langs, ((20 * cast(sum(c) as bigint) + count(*)) // (2 * count(*))) / 10.0 as mean_chars, ((2000 * count(*) + (select count(*) from d)) // (2 * (select count(*) from d))) / 10.0 as share
  from d group by grouping sets ((source, bucket), (source), (bucket), ())""", "documents")
def source_totals(d):
    d = d.select("source", T.lang_bucket(F.col("lang")).alias("bucket"), "lang", "text")
    return stats.totals(d, ["source", "bucket"], [["source", "bucket"], ["source"], ["bucket"], []], "text", "lang").withColumn("level", F.col("level").cast("long"))


FUNNEL = evalset_queries.ORACLE_SQL["eval_funnel"]


@query(f"""with f as ({FUNNEL}), s as (select coalesce(dataset, '') as dataset, dataset is null as whole, {', '.join(f'cast(sum({c}) as bigint) as {c}' for c in ('raw', 'code', 'lang', 'invalid', 'valid', 'duplicate', 'pool', 'train', 'usable', 'cap', 'picked'))},
    string_agg(case when band = 'none' then dataset end, ',' order by dataset) as none, string_agg(case when band = 'low' then dataset end, ',' order by dataset) as low from f group by grouping sets ((dataset), ()))
  select * exclude (whole, none, low), case when raw > 0 then round(100 * (picked / raw), 1) else 0 end as coverage, case when whole then coalesce(none, '') else '' end as none, case when whole then coalesce(low, '') else '' end as low from s""", "documents")
def eval_funnel_totals(d):
    return evalbuild.funnel_totals(evalbuild.funnel(evalset_queries._records(d), evalset_queries.SEED, evalset_queries.CAPS, 9))


# --- profiles -----------------------------------------------------------------------------------


def _profile_sql(table: str, texts: tuple[str, ...], numbers: tuple[str, ...], others: tuple[str, ...] = ()) -> str:
    one = lambda c, kind, text: f"select '{c}' as \"column\", '{kind}' as family, count(*) as n, count(*) filter ({c} is null) as nulls, {f'min({c})' if text else 'cast(null as varchar)'} as least_text, {f'max({c})' if text else 'cast(null as varchar)'} as most_text, {f'cast(min({c}) as double)' if kind == 'number' else 'cast(null as double)'} as least, {f'cast(max({c}) as double)' if kind == 'number' else 'cast(null as double)'} as most from {table}"
    return " union all ".join([*[one(c, "text", True) for c in texts], *[one(c, "number", False) for c in numbers], *[one(c, "other", False) for c in others]])


def _exact(df: DataFrame) -> DataFrame:
    family = F.when(F.col("kind") == "string", "text").when(F.col("kind").rlike("^(tinyint|smallint|int|bigint|float|double|decimal)"), "number").otherwise("other")
    return profile.states(df).select("column", family.alias("family"), "n", "nulls", "least_text", "most_text", "least", "most")


@query(_profile_sql("events", ("event_type", "props"), ("event_id", "user_id", "value"), ("ts",)), "events")
def profile_events(e):
    return _exact(e)


@query(_profile_sql("pages", ("url", "html"), ("page_id",)), "pages")
def profile_pages(p):
    return _exact(p)


@query(None, "events")
def profile_sketches(e):
    """Distinct values, quartiles and frequent values of events from the merged states of four loads."""
    loads = None
    for k in range(4):
        own = profile.states(e.where(F.pmod("event_id", F.lit(4)) == k))
        loads = own if loads is None else loads.unionByName(own)
    return profile.read(profile.merged(loads)).withColumn("frequent", F.to_json("frequent"))


# --- frozen tables ------------------------------------------------------------------------------

KEPT = ("doc_id", "lang", "source", "text")
_PIECES = ", ".join(f"cast(sum(('0x' || substr({{h}}, {at}, {n}))::bigint::hugeint) as varchar) as s{at}" for at, n in manifest.PIECES)
_DIGEST = "sha256(concat_ws(':', n::varchar, " + ", ".join(f"s{at}" for at, _ in manifest.PIECES) + "))"
_CANON = "concat_ws(',', " + ", ".join(f"coalesce(length({c}::varchar)::varchar || ':' || {c}::varchar, '-')" for c in sorted(KEPT)) + ")"


def _leaves_sql(table: str) -> str:
    return f"""select part, bucket, n, {_DIGEST} as hash from (select coalesce(source, '') as part, substr(sha256(coalesce(doc_id::varchar, '')), 1, 2) as bucket, count(*) as n, {_PIECES.format(h='h')} from (select *, sha256({_CANON}) as h from {table}) group by 1, 2)"""


@query(f"""with low as ({_leaves_sql('documents')}), middle as (select part, cast(sum(n) as bigint) as n, sha256(string_agg(bucket || ':' || hash, ',' order by bucket)) as hash from low group by part),
  top as (select cast(coalesce(sum(n), 0) as bigint) as n, {_PIECES.format(h="sha256(part || ':' || hash)")} from middle)
  select 'leaf' as level, part, bucket, n, hash from low union all select 'partition', part, '', n, hash from middle union all select 'root', '', '', n, {_DIGEST} from top""", "documents")
def manifest_documents(d):
    return manifest.manifest(d.select(*KEPT), "doc_id", "source")


CHANGED = f"select doc_id, lang, source, case when doc_id % 50 = 0 then text || '.' else text end as text from documents where doc_id % 70 <> 1 union all select doc_id, lang, source, text from documents where doc_id % 90 = 2"


@query(f"""with old as ({_leaves_sql('documents')}), changed as ({CHANGED}), new as ({_leaves_sql('changed')})
  select coalesce(old.part, new.part) as part, coalesce(old.bucket, new.bucket) as bucket, case when coalesce(old.n, 0) > coalesce(new.n, 0) then 'lost' when coalesce(old.n, 0) < coalesce(new.n, 0) then 'added' else 'changed' end as change, coalesce(old.n, 0) as was, coalesce(new.n, 0) as now
  from old full join new on old.part = new.part and old.bucket = new.bucket where old.hash is distinct from new.hash""", "documents")
def manifest_changes(d):
    d = d.select(*KEPT)
    text = F.when(F.col("doc_id") % 50 == 0, F.concat("text", F.lit("."))).otherwise(F.col("text"))
    changed = d.where("doc_id % 70 <> 1").withColumn("text", text).unionByName(d.where("doc_id % 90 = 2"))
    return manifest.verified(changed, manifest.manifest(d, "doc_id", "source"), "doc_id", "source")


# --- plug-ins -----------------------------------------------------------------------------------


def _words(row: dict) -> list[dict] | None:
    if row["role"] == "system":
        return None
    if row["turn"] % 5 == 4:
        raise KeyError("turn 4")
    if row["turn"] % 5 == 3:
        return {"word": "x", "place": "three"}
    return [{"word": w, "place": k} for k, w in enumerate((row["text"] or "").split(" ")[:2])]


@query("""select conv_id, turn, w as word, cast(k - 1 as bigint) as place, cast(null as varchar) as error from (select conv_id, turn, string_split(coalesce(text, ''), ' ')[k] as w, k, role from conversations, (values (1), (2)) v(k) where turn % 5 < 3 and k <= len(string_split(coalesce(text, ''), ' '))) where role is distinct from 'system'
  union all select conv_id, turn, null, null, case turn % 5 when 4 then 'KeyError: ''turn 4''' else 'bad type' end from conversations where turn % 5 > 2 and role is distinct from 'system'""", "conversations")
def plugin_rows(c):
    out = plugins.processed(c, _words, "word string, place long", ["conv_id", "turn"])
    return out.withColumn("error", F.when(F.col("turn") % 5 == 3, F.when(F.col("error").isNotNull(), "bad type")).otherwise(F.col("error")))


def _scored(row: dict) -> dict:
    n = len(row["text"] or "")
    return {"dimensions": {"long": min(n, 500) / 500, "asked": 1.0 if "?" in (row["text"] or "") else 0.0}, "comment": row["role"]}


@query("""select conv_id, turn, 0.75 * (least(length(coalesce(text, '')), 500) / 500) + 0.25 * (case when contains(coalesce(text, ''), '?') then 1 else 0 end) as score,
  0.75 * (least(length(coalesce(text, '')), 500) / 500) + 0.25 * (case when contains(coalesce(text, ''), '?') then 1 else 0 end) >= 0.4 as passed, role as comment, cast(null as varchar) as error from conversations""", "conversations")
def plugin_scores(c):
    judge = plugins.Judge(_scored, threshold=0.4, weights=(("long", 0.75), ("asked", 0.25)))
    return plugins.judged(c, judge, ["conv_id", "turn"]).drop("dimensions")


@query(None, "embeddings")
def vector_neighbours(e):
    """The ten nearest other vectors of every row whose id is divisible by 50; the tests hold its recall against all pairs."""
    return vectors.neighbours(e, "vec_id", "embedding", F.col("vec_id") % 50 == 0)


# --- session records, pairs, policies, fields ---------------------------------------------------

_CONV = "select conv_id, count(*) as n, count(*) filter (role = 'user') as u, count(*) filter (role = 'assistant') as a, count(*) filter (role = 'system') as s, coalesce(sum(length(text)), 0) as chars, count(*) filter (role = 'user' and trim(text) <> '') as turns, arg_min(case when role = 'user' and trim(text) <> '' then text end, turn) as first from conversations group by conv_id"


@query(f"""with c as ({_CONV}) select case when u > 1 then 'multi' else 'single' end as bucket, count(*) filter (conv_id % 11 <> 0) as records, count(*) filter (conv_id % 11 = 0) as bad_lines,
  cast(coalesce(sum(n) filter (conv_id % 11 <> 0), 0) as bigint) as messages, cast(coalesce(sum(chars + 3 * a) filter (conv_id % 11 <> 0), 0) as bigint) as chars, cast(coalesce(sum(turns) filter (conv_id % 11 <> 0), 0) as bigint) as turns,
  cast(coalesce(sum(a) filter (conv_id % 11 <> 0), 0) as bigint) as tool_uses, cast(coalesce(sum(u) filter (conv_id % 11 <> 0), 0) as bigint) as users, cast(coalesce(sum(s) filter (conv_id % 11 <> 0), 0) as bigint) as systems,
  count(*) filter (conv_id % 11 <> 0 and coalesce(trim(substr(first, 1, 800)), '') <> '') as en from c group by 1""", "conversations")
def bucket_scan(c):
    """Session records, one a line, some of them broken: counts of lines, messages, blocks and languages by bucket in one pass."""
    m = c.select("conv_id", "turn", "role", F.when(F.col("role") == "assistant", F.to_json(F.array(F.struct(F.lit("text").alias("type"), F.col("text").alias("text"), F.lit(None).cast("string").alias("input")), F.struct(F.lit("tool_use").alias("type"), F.lit(None).cast("string").alias("text"), F.lit("abc").alias("input"))))).otherwise(F.expr("substring(to_json(array(text)), 2, length(to_json(array(text))) - 2)")).alias("content"))
    line = F.concat(F.lit('{"messages":['), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "role", "content"))), lambda x: F.concat(F.lit('{"role":"'), x["role"], F.lit('","content":'), x["content"], F.lit("}"))), ","), F.when(F.col("conv_id") % 11 != 0, "]}").otherwise(""))
    lines = m.groupBy("conv_id").agg(line.alias("value"), F.when(F.count_if(F.col("role") == "user") > 1, "multi").otherwise("single").alias("bucket"))
    return sessions.bucket_scan(lines).select("bucket", "records", "bad_lines", "messages", "chars", "turns", "tool_uses", "users", "systems", "en")


@query("""with a as (select doc_id as x, row_number() over (order by doc_id) - 1 as n from documents where lang = 'fr'), b as (select doc_id as y, row_number() over (order by doc_id) - 1 as n from documents where lang = 'de')
  select a.n as "at", x, y, abs((select count(*) from a) - (select count(*) from b)) as unpaired from a join b using (n)""", "documents")
def parallel_places(d):
    """French and German documents side by side by their places, with how many the longer list has more."""
    out = evalbuild.zipped(d.where("lang = 'fr'").select("doc_id"), d.where("lang = 'de'").select("doc_id"), ["doc_id"])
    return out.select("at", F.col("a.doc_id").alias("x"), F.col("b.doc_id").alias("y"), "unpaired")


def _policy_sql(rank: str) -> str:
    return f"""{evalset_queries.CHAIN}, pool as (select * exclude (r) from (select *, row_number() over (partition by lang, nq, ch order by dataset, id) as r from good) where r = 1),
  usable as (select *, md5('{evalset_queries.SEED}::' || dataset || '::' || id) as key, {rank} as sr from pool),
  one as (select *, row_number() over (partition by dataset, task_type, subject, difficulty, variant order by sr, key, id) as i, count(*) over (partition by dataset, task_type, subject, difficulty, variant) as sn, min(id) over (partition by dataset, task_type, subject, difficulty, variant) as sf from usable),
  two as (select *, row_number() over (partition by dataset order by i, sn desc, sf) as pick from one)
  select id, dataset, sp as split, pick from two where pick <= case dataset when 'longbench-data' then 4 when 'CUAD' then 300 else 9 end"""


def _policy(d: DataFrame, policy: str) -> DataFrame:
    pool = evalbuild.deduped(evalbuild.admitted(evalset_queries._records(d)).where("dropped is null"))
    return evalbuild.picked(pool, evalset_queries.SEED, policy, evalset_queries.CAPS, 9).select("id", "dataset", "split", F.col("pick").cast("long").alias("pick"))


@query(_policy_sql("case when sp <> 'train' then 0 else 1 end"), "documents")
def eval_pick_test_first(d):
    return _policy(d, "test-first")


@query(_policy_sql("0"), "documents")
def eval_pick_all(d):
    return _policy(d, "all")


@query("""select doc_id, case when doc_id % 4 < 2 then coalesce(trim(replace(replace(text, chr(96), ''), chr(92), ''), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '') else '' end as bare,
  array_to_string(list_filter([case when doc_id % 6 in (0, 3) then '孟加拉数字' end, case when doc_id % 6 = 3 then '泰文数字' end], lambda x: x is not null), ',') as kinds from documents""", "documents")
def text_fences(d):
    """Texts of the table in code fences of several forms, and numeral systems named."""
    text = F.regexp_replace(F.coalesce("text", F.lit("")), "[`\\\\]", "")
    fence = F.when(F.col("doc_id") % 4 == 0, F.concat(F.lit(" ```json\n"), text, F.lit("\n```"))).when(F.col("doc_id") % 4 == 1, F.concat(F.lit("```"), text, F.lit("  ``` ")))
    kinds = F.expr("case doc_id % 6 when 0 then '৩' when 3 then '7 ১ ๒' when 4 then '12' else null end")
    return d.select("doc_id", T.without_fence(fence).alias("bare"), F.array_join(T.digit_kinds(kinds), ",").alias("kinds"))


@query("""select conv_id, turn, substr(case when conv_id % 3 = 0 then text when conv_id % 3 = 1 then 'a' || text || coalesce(role, '') else '' end, 1, 800) as said from conversations where text is not null""", "conversations")
def content_texts(c):
    c = c.where("text is not null")
    quoted = F.expr("substring(to_json(array(text)), 2, length(to_json(array(text))) - 2)")
    listed = F.concat(F.lit('["a",{"text":'), quoted, F.lit('},{"input":{"x":1}},{"text":7,"content":"'), F.coalesce("role", F.lit("")), F.lit('"}]'))
    content = F.when(F.col("conv_id") % 3 == 0, quoted).when(F.col("conv_id") % 3 == 1, listed).otherwise("17")
    return c.select("conv_id", "turn", sessions.content_text(content).alias("said"))


@query("""select doc_id, case when doc_id % 5 = 1 then 'empty_question' else array_to_string(list_filter([case when doc_id % 5 = 2 then 'options_count' end, case when doc_id % 5 = 3 then 'numbers_changed:question' end, case when doc_id % 5 = 2 then 'numbers_changed:options' end,
  case when doc_id % 7 = 0 then 'numbers_changed:answer' end, case when doc_id % 5 = 4 then 'latex_changed:solution' end], lambda x: x is not null), ',') end as problems from documents""", "documents")
def translation_all_fields(d):
    c = lambda e: F.expr(e)
    source = {"question": c("'Question ' || doc_id || ' of the text'"), "options": c("array('1 a', 'b')"), "answer": c("cast(doc_id as string)"), "solution": c("'so $x$'")}
    result = {
        "question": c("case doc_id % 5 when 1 then ' ' when 3 then 'The question 7.77 of a text' else 'The question ' || doc_id || ' of a text' end"), "options": c("case when doc_id % 5 = 2 then array('1 a') || array('2', 'c') else array('1 c', 'd') end"),
        "answer": c("case when doc_id % 7 = 0 then 'none' else cast(doc_id as string) end"), "solution": c("case when doc_id % 5 = 4 then 'so x' else 'thus $y$' end"),
    }
    return d.select("doc_id", F.array_join(translation.all_problems(source, result, F.lit("bn")), ",").alias("problems"))
