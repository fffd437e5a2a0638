"""Queries of wide evaluation tables and translation payloads over the orders and documents, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamis.functions import text as T
from tamis.operators import evaluation as E
from tamis.operators import translation

QUERIES = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str, table: str = "orders"):
    def register(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(spark.read.parquet(f"{sf_dir}/{table}.parquet"))

        QUERIES[f.__name__], ORACLE_SQL[f.__name__] = run, sql
        run.__name__ = f.__name__
        return f

    return register


NAMES = ["model-1.5", "other 5"]
LONG = """select o_orderkey, candidate, referee, case when referee is null and o_orderkey % 5 <> n then 'a' || o_orderkey || candidate end as answer, case when referee is null then o_orderkey % 7 + n end as prompt_tokens,
  case when referee is null and o_orderkey % 5 = n then 'timeout' end as error, case when referee is not null then (o_orderkey % 10) / 10.0 end as score
  from orders, (values ('model-1.5', 0, null), ('other 5', 1, null), ('other 5', 1, 'strict')) c(candidate, n, referee)"""


def _long(o: DataFrame) -> DataFrame:
    cells = E.cells(o.select("o_orderkey"), NAMES).withColumn("n", F.when(F.col("candidate") == NAMES[0], 0).otherwise(1))
    run = cells.selectExpr("o_orderkey", "candidate", "cast(null as string) as referee", "case when o_orderkey % 5 <> n then 'a' || o_orderkey || candidate end as answer", "o_orderkey % 7 + n as prompt_tokens", "case when o_orderkey % 5 = n then 'timeout' end as error", "cast(null as double) as score")
    judge = cells.where("n = 1").selectExpr("o_orderkey", "candidate", "'strict' as referee", "cast(null as string) as answer", "cast(null as bigint) as prompt_tokens", "cast(null as string) as error", "cast((o_orderkey % 10) / 10.0 as double) as score")
    return run.unionByName(judge)


WIDE = """select o_orderkey, case when o_orderkey % 5 <> 0 then 'a' || o_orderkey || 'model-1.5' end as answer_model_1_5, case when o_orderkey % 5 = 0 then 'timeout' end as error_model_1_5,
  case when o_orderkey % 5 <> 1 then 'a' || o_orderkey || 'other 5' end as answer_other_5, case when o_orderkey % 5 = 1 then 'timeout' end as error_other_5, cast((o_orderkey % 10) / 10.0 as double) as score_strict_other_5 from orders"""
KEPT = ["o_orderkey", "answer_model_1_5", "error_model_1_5", "answer_other_5", "error_other_5", "score_strict_other_5"]


def _wide(o: DataFrame) -> DataFrame:
    return E.widened(o.select("o_orderkey"), _long(o), ["o_orderkey"], NAMES, ("answer",), ("strict",))


@query(WIDE)
def wide_results(o):
    return _wide(o).select(*KEPT)


@query(f"select o_orderkey from ({WIDE}) where error_model_1_5 is not null or error_other_5 is not null")
def wide_failed(o):
    w = _wide(o)
    return w.where(E.failed(w)).select("o_orderkey")


@query(f"""select o_orderkey, case when o_orderkey % 10 = 0 then 'second' else answer_model_1_5 end as answer_model_1_5, case when o_orderkey % 10 = 0 then '' else error_model_1_5 end as error_model_1_5, answer_other_5, error_other_5, score_strict_other_5 from ({WIDE})""")
def wide_retried(o):
    again = o.select("o_orderkey", F.lit("second").alias("answer_model_1_5"), F.when(F.col("o_orderkey") % 10 == 0, "").otherwise("timeout").alias("error_model_1_5"))
    return E.retried(_wide(o).select(*KEPT), again, ["o_orderkey"], NAMES[0], ("answer",))


@query(f"""select candidate, count(*) filter (error is null) as ok, count(*) filter (error is not null) as failed, avg(case when error is null then o_orderkey % 100 end) as avg_latency_ms, cast(sum(prompt_tokens) as bigint) as prompt_tokens,
  cast(sum(prompt_tokens * 2) as bigint) as completion_tokens from ({LONG}) where referee is null group by candidate""")
def run_statistics(o):
    long = _long(o).where("referee is null").withColumns({"latency_ms": F.col("o_orderkey") % 100, "completion_tokens": F.col("prompt_tokens") * 2})
    return E.run_stats(long)


@query("select o_orderkey, o_orderkey % 3 = 0 or o_orderkey % 3 = 1 and o_orderkey % 2 = 0 as judge from orders")
def judge_skips(o):
    k = F.col("o_orderkey")
    return o.select("o_orderkey", E.to_judge(F.when(k % 3 == 0, "x"), F.when((k % 3 == 1) & (k % 2 == 0), "[]").otherwise(""), F.when(k % 3 == 2, "error").otherwise("")).alias("judge"))


@query("""select doc_id, '{"question":' || to_json('q' || doc_id) || case when doc_id % 2 = 0 then ',"options":["a","b"]' else '' end || case when doc_id % 3 = 0 then ',"answer":"quatre été"' else '' end || case when doc_id % 5 = 0 then ',"solution":"s"' else '' end || '}' as payload,
  'question' || case when doc_id % 2 = 0 then ',options' else '' end || case when doc_id % 3 = 0 then ',answer' else '' end || case when doc_id % 5 = 0 then ',solution' else '' end as keys,
  case when doc_id % 4 = 0 then 'q' || doc_id else 'done' end as question, case when doc_id % 4 = 0 then 'kept_original:question' end as warning from documents where lang not in ('', 'zh', 'en')""", "documents")
def translation_payload(d):
    r = d.select("doc_id", "lang", F.concat(F.lit("q"), F.col("doc_id").cast("string")).alias("question"), F.expr("case when doc_id % 2 = 0 then array('a', 'b') else array() end").alias("options"),
                 F.expr("case when doc_id % 3 = 0 then 'quatre été' else '4/3' end").alias("answer"), F.expr("case when doc_id % 5 = 0 then 's' else '' end").alias("solution"), F.lit("").alias("context"))
    q = translation.queue(r)
    field, warning = translation.filled_in(F.col("question"), F.when(F.col("doc_id") % 4 == 0, " ").otherwise("done"), "question")
    p = translation.payload(q)
    return q.select("doc_id", p["payload"].alias("payload"), F.array_join(p["keys"], ",").alias("keys"), field.alias("question"), warning.alias("warning"))


@query("""select o_orderkey, case o_orderkey % 4 when 0 then o_orderkey % 1024 || ' B' when 1 then printf('%.0f KB', 4.0 * (o_orderkey % 50 + 1)) when 2 then printf('%.1f MB', 2.5 * (o_orderkey % 50 + 1)) else printf('%.2f GB', 1.25 * (o_orderkey % 50 + 1)) end as size from orders""")
def byte_sizes(o):
    n = F.expr("case o_orderkey % 4 when 0 then o_orderkey % 1024 when 1 then 4096 * (o_orderkey % 50 + 1) when 2 then 2621440 * (o_orderkey % 50 + 1) else 1342177280 * (o_orderkey % 50 + 1) end")
    return o.select("o_orderkey", T.byte_size(n).alias("size"))
