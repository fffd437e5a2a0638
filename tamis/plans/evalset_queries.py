"""Queries of the evaluation-set build, its funnel and statistics, over records made of the documents, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamis.functions import text as T
from tamis.operators import evalbuild as B
from tamis.operators import evalset, translation

QUERIES = {}
ORACLE_SQL: dict[str, str] = {}
SEED = "formal"


def query(sql: str, table: str = "documents"):
    def register(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(spark.read.parquet(f"{sf_dir}/{table}.parquet"))

        QUERIES[f.__name__], ORACLE_SQL[f.__name__] = run, sql
        run.__name__ = f.__name__
        return f

    return register


# Columns of a record in SQL that both engines read; options and metadata are written for each.
RAW = {
    "id": "'r' || lpad(cast(doc_id as string), 7, '0')", "dataset": "case when source = 'src1' then 'GAOKAO-Bench' when source = 'src2' then 'longbench-data' else source end",
    "category": "case when doc_id % 11 = 0 then 'code' else 'math' end", "task_type": "case when doc_id % 3 = 0 then 'mcq' else 'open_qa' end",
    "lang": "case when doc_id % 5 = 0 then 'fr' when doc_id % 2 = 0 then 'en' else 'zh' end", "split": "case doc_id % 4 when 0 then 'train' when 1 then 'test' when 2 then 'dev' else '' end",
    "question": "case when doc_id % 13 = 0 then '' when doc_id % 17 = 0 then ' x ' else 'Q  ' || cast(doc_id % 400 as string) || ' ?' end",
    "answer": "case when doc_id % 7 = 0 then '' when doc_id % 3 = 0 then case when doc_id % 9 = 0 then 'C' else 'B' end else 'steps <<1>> #### ' || cast(doc_id as string) end", "solution": "case when doc_id % 6 = 1 then 'own' else '' end",
}
LEVEL, CONTEXT = "'Level ' || cast(doc_id % 5 + 1 as string)", "case when doc_id % 2 = 0 then 'ctx ' || cast(doc_id % 3 as string) else '' end"


def _records(d: DataFrame) -> DataFrame:
    metadata = f"to_json(named_struct('subject', 's' || cast(doc_id % 3 as string), 'level', {LEVEL}, 'context', {CONTEXT}, 'perturbation_type', '', 'category', '（新课标ii）', 'subject_file', '2010-2022_Biology_MCQs.json', 'tags', array()))"
    return d.selectExpr(*[f"{v} as {k}" for k, v in RAW.items()], "case when doc_id % 3 = 0 then array(' alpha ', 'beta x') else array() end as options", f"{metadata} as metadata")


CHAIN = f"""
with raw as (select doc_id, {', '.join(f'{v} as {k}' for k, v in RAW.items())}, {LEVEL} as level, {CONTEXT} as context, trim({RAW['question']}) as q from documents),
seen as (select *, case when category = 'code' then 'code' when lang not in ('zh', 'en') then 'lang' when q = '' or length(q) < 2 or answer = '' or (doc_id % 9 = 0) then 'invalid' end as dropped,
    case when q = '' then 'empty_question' when length(q) < 2 then 'question_too_short' when answer = '' then 'empty_answer' when doc_id % 9 = 0 then 'option_missing_for_letter' end as reject_reason,
    md5(lower(regexp_replace(q, '\\s+', ' ', 'g'))) as nq, case when context = '' then '' else substr(md5(context), 1, 12) end as ch, case when split = '' then 'unspecified' else split end as sp,
    case when dataset = 'GAOKAO-Bench' then 'Biology' when dataset = 'longbench-data' then 's' || doc_id % 3 else 's' || doc_id % 3 end as subject,
    case when dataset = 'GAOKAO-Bench' then '' else level end as difficulty, case when dataset = 'GAOKAO-Bench' then '新课标Ⅱ' else '' end as variant from raw),
good as (select * from seen where dropped is null)"""


def _picked(pool: str) -> str:
    return f"""
usable as (select *, md5('{SEED}::' || dataset || '::' || id) as key from {pool} where sp <> 'train'),
one as (select *, row_number() over (partition by dataset, task_type, subject, difficulty, variant order by key, id) as i, count(*) over (partition by dataset, task_type, subject, difficulty, variant) as sn,
    min(id) over (partition by dataset, task_type, subject, difficulty, variant) as sf from usable),
two as (select *, row_number() over (partition by dataset order by i, sn desc, sf) as pick from one),
picked as (select * from two where pick <= case dataset when 'longbench-data' then 4 when 'CUAD' then 300 else 9 end)"""


CAPS = {"longbench-data": 4}


@query(f"""{CHAIN}, pool as (select * exclude (r) from (select *, row_number() over (partition by lang, nq, ch order by dataset, id) as r from good) where r = 1),{_picked('pool')}
  select dataset || '-' || lpad(cast(row_number() over (order by dataset, key) as varchar), 5, '0') as id, dataset as source, category, task_type, lang, sp as split, subject, difficulty, variant, q as question, context,
    case when doc_id % 3 = 0 then '["alpha","beta x"]' else '' end as options, case when doc_id % 3 = 0 then 'beta x' else cast(doc_id as varchar) end as answer,
    case when solution <> '' then solution when doc_id % 3 = 0 then '' else 'steps <<1>>' end as solution,
    case when doc_id % 3 = 0 then '{{"answer_letter":"B",' else '{{' end || '"category":"（新课标ii）","level":"' || level || '","subject":"s' || doc_id % 3 || '","subject_file":"2010-2022_Biology_MCQs.json"}}' as extra from picked""".replace("{{", "{").replace("}}", "}"))
def eval_build(d):
    return B.built(_records(d), SEED, caps=CAPS, default=9)


@query(f"""{CHAIN}, pool as (select * exclude (r) from (select *, row_number() over (partition by lang, nq order by dataset, id) as r from good) where r = 1),{_picked('pool')},
  a as (select dataset, count(*) as raw, count(*) filter (dropped = 'code') as code, count(*) filter (dropped = 'lang') as lang, count(*) filter (dropped = 'invalid') as invalid, count(*) filter (dropped is null) as valid from seen group by 1),
  p as (select dataset, count(*) as pool, count(*) filter (sp <> 'train') as usable from pool group by 1), k as (select dataset, count(*) as picked from picked group by 1),
  j as (select a.*, coalesce(p.pool, 0) as pool, coalesce(p.usable, 0) as usable, coalesce(k.picked, 0) as picked from a left join p using (dataset) left join k using (dataset))
  select dataset, raw, code, lang, invalid, valid, valid - pool as duplicate, pool, pool - usable as train, usable, case when usable > 0 then case dataset when 'longbench-data' then 4 when 'CUAD' then 300 else 9 end else 0 end as cap, picked,
    round(100 * (picked / raw), 1) as coverage, case when picked = 0 then 'none' when picked / raw < 0.05 then 'low' else '' end as band from j""")
def eval_funnel(d):
    return B.funnel(_records(d), SEED, CAPS, 9)


@query(f"""{CHAIN}, r as (select dataset, reject_reason, count(*) as n from seen where dropped = 'invalid' group by 1, 2)
  select * from r union all select '', reject_reason, cast(sum(n) as bigint) from r group by 2""")
def eval_reasons(d):
    return B.reasons(_records(d))


@query("""with c as (select coalesce(source, '') as source, coalesce(lang, '') as lang from documents)
  select 'source' as section, source as key, '' as sub, count(*) as n from c group by 2 union all select 'lang', lang, '', count(*) from c group by 2
  union all select 'source_lang', source, lang, count(*) from c group by 2, 3 union all select 'total', '', '', count(*) from c""")
def eval_statistics(d):
    return B.counts_document(d, ("source", "lang"), (("source", "lang"),))


@query("""select c as "column", case c when 'lang' then l when 'source' then s else t end as filled, n as rows, round(case c when 'lang' then l when 'source' then s else t end / n, 4) as share
  from (select count(*) as n, count(*) filter (coalesce(lang, '') <> '') as l, count(*) filter (coalesce(source, '') <> '') as s, count(*) filter (coalesce(text, '') <> '') as t from documents), (values ('lang'), ('source'), ('text')) v(c)""")
def eval_fill_rates(d):
    return B.fill_rates(d, "lang", "source", "text")


DIFFICULTY = "case doc_id % 9 when 0 then 'Level 3' when 1 then 'Level 1' when 2 then 'Level x' when 3 then 'high' when 4 then 'Low' when 5 then 'top' when 6 then 'medium' when 7 then 'odd' else 'Level 12' end"


@query(f"""with c as (select {DIFFICULTY} as difficulty, count(*) as n from documents group by 1)
  select difficulty, n, row_number() over (order by case difficulty when 'Level 1' then 1 when 'Level 3' then 3 when 'Level x' then 9 when 'Level 12' then 12 when 'Low' then 20 when 'medium' then 21 when 'high' then 22 when 'top' then 23 else 28 end) as place from c""")
def eval_difficulties(d):
    from pyspark.sql import Window as W

    c = d.selectExpr(f"{DIFFICULTY} as difficulty").groupBy("difficulty").agg(F.count(F.lit(1)).alias("n"))
    return c.withColumn("place", F.row_number().over(W.orderBy(B.difficulty_order(F.col("difficulty")))))  # nine rows


@query("""with c as (select case when doc_id % 6 = 5 then 'n/a' else cast((doc_id * 7) % 13 as varchar) end as steps, count(*) as n from documents group by 1)
  select steps, n, row_number() over (order by case when steps = 'n/a' then -1 else cast(steps as int) end) as place from c""")
def eval_steps(d):
    from pyspark.sql import Window as W

    c = d.selectExpr("case when doc_id % 6 = 5 then 'n/a' else cast((doc_id * 7) % 13 as string) end as steps").groupBy("steps").agg(F.count(F.lit(1)).alias("n"))
    return c.withColumn("place", F.row_number().over(W.orderBy(B.steps_order(F.col("steps")))))  # fourteen rows


QUESTION = "'How  many ' || cast(doc_id % 300 as string) || '?'"
STEPS = "repeat('<<1+1=2>> ', cast(doc_id % 6 as int))"
UNIFORM = "(cast('0x' || substr(md5('42:' || id), 1, 12) as bigint) / 281474976710656.0)"


def _solved(d):
    rows = d.selectExpr("'g-' || cast(doc_id as string) as id", f"{QUESTION} as question", f"case when doc_id % 10 = 0 then 'no mark' else {STEPS} || '#### ' || cast(doc_id as string) end as answer", "doc_id as order")
    return B.worked(rows)


@query(f"""select 'g-' || doc_id as id, case when doc_id % 10 = 0 then '' else cast(doc_id as varchar) end as final, case when doc_id % 10 = 0 then 0 else doc_id % 6 end as steps,
  case when doc_id % 10 = 0 then 'no mark' else trim({STEPS.replace('as int', 'as bigint')}) end as solution from documents""")
def simple_worked(d):
    return _solved(d).select("id", "final", "steps", "solution")


@query(f"""with s as (select 'g-' || doc_id as id, doc_id % 300 as q, doc_id % 6 as steps from documents where doc_id % 10 <> 0)
  select id, steps, {UNIFORM} as u from s where steps <= 3 and q not in (select doc_id % 40 from documents) order by steps, {UNIFORM}, id limit 60""")
def simple_supplement(d):
    used = d.selectExpr("'HOW many ' || cast(doc_id % 40 as string) || '?' as question")
    out = B.supplement(_solved(d), used, 3, 60, 42)
    return out.select("id", "steps", B.stable_uniform(42, F.col("id")).alias("u"))


@query(f"""with last as (select doc_id % 300 as q, max(doc_id) as d from documents group by 1), e as (select doc_id as place from documents), z as (select doc_id * 2 as place from documents),
  b as (select e.place, l.d from e join z using (place) left join last l on l.q = e.place % 300)
  select place as "at", side || '-' || place as id, lang, case when d % 10 = 0 then 0 else d % 6 end as reasoning_steps, case when d % 10 = 0 then 'no mark' else trim(repeat('<<1+1=2>> ', d % 6)) end as solution from b, (values ('e', 'en'), ('z', 'zh')) s(side, lang)""")
def simple_parallel(d):
    first = d.selectExpr("'e-' || cast(doc_id as string) as id", f"{QUESTION} as question", "'a' as answer", "'en' as lang")
    second = d.selectExpr("'z-' || cast(doc_id * 2 as string) as id", "'题' as question", "'a' as answer", "'zh' as lang")
    return B.parallel(first, second, _solved(d)).select("at", "id", "lang", "reasoning_steps", "solution")


@query("""with c as (select lang, count(*) as n from documents group by lang), o as (select *, row_number() over (order by n desc, lang) as r from c), rounds as (select unnest(range(0, 333)) as round),
  slots as (select o.lang, row_number() over (order by rounds.round, o.r) as place from o, rounds where rounds.round < o.n)
  select o.lang, any_value(o.n) as n, count(*) filter (place <= 333) as quota from o left join slots s on s.lang = o.lang group by o.lang""")
def translation_quotas(d):
    return evalset.language_quotas(d, "lang", 333)


@query("""with c as (select source, lang, count(*) as n from documents group by 1, 2), r as (select *, row_number() over (partition by source order by n desc, lang) as r from c)
  select source, string_agg(case when r <= 2 then coalesce(lang, '') || ':' || n end, ' ' order by r) || case when count(*) filter (r > 2) > 0 then ' …(' || count(*) filter (r > 2) || ')' else '' end as langs from r group by source""")
def source_languages(d):
    return B.top_languages(d, "source", "lang", 2)


@query("""with a as (select source, count(*) as n from documents where length(text) > 1000 group by 1), b as (select source, count(*) as n from documents where lang = 'de' group by 1)
  select coalesce(a.source, b.source) as source, coalesce(a.n, 0) as long, coalesce(b.n, 0) as german from a full join b on a.source = b.source""")
def merged_source_counts(d):
    count = lambda x: x.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    return B.merged_counts(["source"], {"long": count(d.where(F.length("text") > 1000)), "german": count(d.where("lang = 'de'"))})


@query("select doc_id, source, cast(null as varchar) as lang from documents union all select doc_id, cast(null as varchar), lang from documents")
def header_union(d):
    return B.union_of_headers([d.select("doc_id", "source"), d.select("doc_id", "lang")])


@query("""select doc_id, case doc_id % 4 when 0 then 'Ⅰ' when 1 then '新课标Ⅲ' when 2 then '新课标Ⅰ' else 'x' end as paper, case doc_id % 3 when 0 then 'Biology' when 1 then 'Math_II' else '' end as subject from documents""")
def exam_names(d):
    p = F.expr("case doc_id % 4 when 0 then '（ⅰ）' when 1 then ' (新课标iii)' when 2 then '新课标 I ' else 'x' end")
    f = F.expr("case doc_id % 3 when 0 then '2010-2022_Biology_MCQs.json' when 1 then '2010_Math_II_Fill-in-the-Blank.json' else 'other.json' end")
    return d.select("doc_id", B.paper(p).alias("paper"), B.exam_subject(f).alias("subject"))


# --- functions of texts ------------------------------------------------------------------------


@query("""select doc_id, length(text) + length(lang) + 5 + 3 as chars, cast(case when text like '%license%' then 1 else 0 end as bigint) as has, case when doc_id % 3 = 0 then cast(doc_id as varchar) end as final,
  case when doc_id % 3 = 0 then 'work' else '' end as cot, doc_id % 4 as steps from documents where text is not null""")
def text_answers(d):
    d = d.where("text is not null")
    a = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("work #### "), F.col("doc_id").cast("string"))).otherwise("plain")
    chars = T.record_chars(F.col("text"), F.array(F.lit("ab"), F.lit("c"), F.lit(None)), F.col("lang"), F.lit("solve"), F.lit(None).cast("string"))
    return d.select("doc_id", chars.alias("chars"), F.contains("text", F.lit("license")).cast("long").alias("has"), T.final_answer(a).alias("final"), T.reasoning(a).alias("cot"), T.count_steps(F.repeat(F.lit("<<x>>"), (F.col("doc_id") % 4).cast("int"))).alias("steps"))


NUMERALS = "case doc_id % 5 when 0 then '१२' when 1 then '٣' when 2 then '12' when 3 then 'x१' else '' end"


@query(f"""select doc_id, case doc_id % 5 when 0 then '12' when 1 then '3' when 2 then '12' when 3 then 'x1' else '' end as ascii, doc_id % 5 in (0, 1, 3) as other, doc_id % 3 <> 0 as need,
  case doc_id % 4 when 0 then 'bn' when 1 then 'ge' when 2 then 'kk' else '' end as code, case doc_id % 4 when 0 then 'bn' when 1 then 'src-x' when 2 then 'a-b' else '' end as name from documents""")
def text_numerals(d):
    c = F.expr(NUMERALS)
    lang = F.expr("case doc_id % 4 when 0 then 'Bengali ' when 1 then 'german' when 2 then ' Kazakh' else '' end")
    name = F.expr("case doc_id % 4 when 0 then ' BN' when 1 then 'Src_X' when 2 then 'a_b' else '' end")
    return d.select("doc_id", T.ascii_digits(c).alias("ascii"), T.has_other_digit(c).alias("other"), T.need_translate(F.expr("case doc_id % 3 when 0 then '4/3 ok' when 1 then 'über 3' else '四' end")).alias("need"), T.norm_lang(lang).alias("code"), T.canonical_name(name).alias("name"))


@query("""select doc_id, case when doc_id % 40 = 0 then 'other' when (doc_id % 40) / ((doc_id % 40) + 100.0) >= 0.15 then 'zh' else 'en' end as detected from documents""")
def text_languages(d):
    mixed = F.when(F.col("doc_id") % 40 == 0, " \t").otherwise(F.concat(F.repeat(F.lit("中"), (F.col("doc_id") % 40).cast("int")), F.repeat(F.lit("a"), F.lit(100))))
    return d.select("doc_id", T.detect_lang(mixed).alias("detected"))


@query("""select doc_id, case doc_id % 5 when 0 then '' when 1 then 'empty_question' when 2 then 'numbers_changed' when 3 then 'latex_changed' else 'length_ratio,source_script_left' end as problems from documents""")
def translation_problems(d):
    source = F.lit("2 যোগ 12 $x$")
    result = F.expr("case doc_id % 5 when 0 then 'the sum of 2 and 12 $x$' when 1 then ' ' when 2 then 'sum of 2 13 $x$' when 3 then 'the sum of 2 and 12 x' else repeat('যোগ ', 30) || '2 12 $x$' end")
    p = d.select("doc_id", source.alias("source_text"), result.alias("result_text"))
    return p.select("doc_id", F.array_join(translation.problems("source_text", "result_text", F.lit("bn")), ",").alias("problems"))


@query("""select doc_id, cast(case when doc_id % 3 = 0 then 0.5 when doc_id % 3 = 1 then 0 else 1 end as double) as residual from documents""")
def text_residuals(d):
    c = F.expr("case doc_id % 3 when 0 then 'abক খ' when 1 then '12' else 'কখ' end")
    return d.select("doc_id", F.round(T.residual_ratio(c, F.lit("bn")), 4).alias("residual"))
