"""Queries of the session parsers: log lines are made of the conversations, parsed, and held against SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamis.operators import session_logs as L
from tamis.operators import sessions

QUERIES = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str):
    """Registers a function of the conversations over a folder of tables, with its SQL."""

    def register(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(spark.read.parquet(f"{sf_dir}/conversations.parquet"))

        QUERIES[f.__name__], ORACLE_SQL[f.__name__] = run, sql
        run.__name__ = f.__name__
        return f

    return register


def _lines(c: DataFrame, file: str, at: str, row: str) -> DataFrame:
    return c.selectExpr(f"{file} as file", f"cast({at} as bigint) as at", f"parse_json(to_json({row})) as row")


def _flat(sessions_: DataFrame) -> DataFrame:
    said = F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit(":"), m["content"])), "\n")
    return sessions_.select("file", F.coalesce("session", F.col("line").cast("string")).alias("session"), F.size("messages").cast("long").alias("n_messages"), said.alias("said"))


FILE, AT = "'f' || (conv_id % 10)", "conv_id * 1000 + turn"
BLOCK = "'{\"type\":\"text\",\"text\":' || to_json({0}) || '}'"


@query(f"""select {FILE} as file, cast({AT} as varchar) as session, 2 as n_messages, 'user:' || to_json('q ' || role) || chr(10) || 'assistant:' || to_json('a' || turn) as said from conversations where role <> 'system'""")
def log_distilled(c):
    text = "case when role = 'system' then '<|user|> <|assistant|>none' else 'x<|user|> q ' || role || ' <|assistant|> a' || turn || '<|end|>rest' end"
    return _flat(L.distilled(_lines(c, FILE, AT, f"named_struct('text', {text}, 'quality_score', 1)")))


@query(f"""select {FILE} as file, cast({AT} as varchar) as session, case when turn % 3 = 2 then 2 else 3 end as n_messages,
  'user:' || to_json('one ' || role) || chr(10) || 'user:"two"' || case when turn % 3 = 2 then '' else chr(10) || 'assistant:[{{"type":"thinking","thinking":' || to_json('t' || turn) || '}}' ||
    case turn % 3 when 0 then ',{{"type":"tool_use","name":"run","input":"ls"}}' else ',{{"type":"text","text":"done"}}' end || ']' end as said from conversations""".replace("{{", "{").replace("}}", "}"))
def log_traces(c):
    row = """named_struct('context', 'head USER: one ' || role || ' USER: <command-name>x USER:  USER: two', 'cot', case when turn % 3 = 2 then '' else 't' || turn end, 'output_type', case turn % 3 when 0 then 'tool_use' when 1 then 'text' else 'none' end,
      'output', named_struct('tool', 'run', 'input', 'ls', 'text', 'done'))"""
    return _flat(L.traces(_lines(c, FILE, AT, row)))


@query(f"""select {FILE} as file, cast({AT} as varchar) as session, 6 as n_messages, 'system:"be brief"' || chr(10) || 'user:' || to_json('p' || turn) || chr(10) ||
  'assistant:[{{"type":"thinking","thinking":"a\\n\\nPlan: b"}},{{"type":"tool_use","name":"shell","input":"ls\\npwd"}}]' || chr(10) || 'tool:"out"' || chr(10) || 'assistant:[{{"type":"thinking","thinking":"c"}}]' || chr(10) ||
  'assistant:[{{"type":"tool_use","name":"shell","input":"cd"}}]' as said from conversations where role <> 'system'""".replace("{{", "{").replace("}}", "}"))
def log_terminal(c):
    row = """named_struct('task_name', 't', 'system_instructions', 'be brief', 'prompt', case when role = 'system' then '' else 'p' || turn end, 'solution', case when role <> 'system' then array(
      named_struct('analysis', 'a', 'plan', 'b', 'commands', parse_json('["ls","pwd"]'), 'terminal_output', 'out'), named_struct('analysis', '', 'plan', 'c', 'commands', parse_json('null'), 'terminal_output', ''),
      named_struct('analysis', '', 'plan', '', 'commands', parse_json('"cd"'), 'terminal_output', '')) end)"""
    return _flat(L.terminal(_lines(c, FILE, AT, row)))


MARKED = """with m as (select *, case when lag(role) over w is not distinct from role and role = 'assistant' then 0 else 1 end as s from conversations window w as (partition by conv_id order by turn)),
  i as (select *, sum(s) over (partition by conv_id order by turn) as island from m)"""


@query(f"""{MARKED}, g as (select conv_id, island, role, min(turn) as turn, case role when 'assistant' then '[' || string_agg('{{"type":"text","text":' || to_json(text) || '}},{{"type":"tool_use","name":"f","input":"{{}}"}}', ',' order by turn) || ']' else to_json(any_value(text)) end as content from i group by 1, 2, 3)
  select {FILE} as file, 's' || conv_id as session, count(*) as n_messages, string_agg(role || ':' || content, chr(10) order by island) as said from g group by 1, 2""".replace("{{", "{").replace("}}", "}"))
def log_codex(c):
    starts = _lines(c.groupBy("conv_id").agg(F.min("turn").alias("turn")), FILE, "conv_id * 1000 - 1", "named_struct('type', 'session_meta', 'payload', named_struct('id', 's' || conv_id))")
    text = "named_struct('type', 'message', 'role', case role when 'system' then 'developer' else role end, 'content', array(named_struct('text', text)))"
    said = _lines(c, FILE, "conv_id * 1000 + 2 * turn", f"named_struct('type', 'response_item', 'payload', {text})")
    calls = _lines(c.where("role = 'assistant'"), FILE, "conv_id * 1000 + 2 * turn + 1", "named_struct('type', 'response_item', 'payload', named_struct('type', 'function_call', 'name', 'f', 'arguments', '{}'))")
    other = _lines(c, FILE, "conv_id * 1000 + 900 + turn", "named_struct('type', 'event_msg', 'payload', named_struct('type', 'message'))")
    return _flat(L.codex(starts.unionByName(said).unionByName(calls).unionByName(other)))


@query(f"""select {FILE} as file, 's' || conv_id as session, count(*) as n_messages, string_agg(role || ':' || case when role = 'assistant' then '[{{"text":' || to_json(text) || ',"type":"text"}},{{"input":{{"x":1}},"name":"f","type":"tool_use"}}]' else to_json(text) end, chr(10) order by turn) as said
  from conversations group by 1, 2""".replace("{{", "{").replace("}}", "}"))
def log_pi(c):
    starts = _lines(c.groupBy("conv_id").agg(F.min("turn").alias("turn")), FILE, "conv_id * 1000 - 1", "named_struct('type', 'session', 'id', 's' || conv_id)")
    content = "case when role = 'assistant' then parse_json(to_json(array(named_struct('type', 'text', 'text', text, 'name', null, 'arguments', null), named_struct('type', 'toolCall', 'text', null, 'name', 'f', 'arguments', named_struct('x', 1))))) else parse_json(substring(to_json(array(text)), 2, length(to_json(array(text))) - 2)) end"
    said = _lines(c, FILE, AT, f"named_struct('type', 'message', 'message', named_struct('role', role, 'content', {content}))")
    return _flat(L.pi(starts.unionByName(said)))


@query(f"""select {FILE} as file, 's' || conv_id as session, count(*) as n_messages, string_agg(role || ':' || to_json(text), chr(10) order by turn desc) as said from conversations where role <> 'system' group by 1, 2""")
def log_events(c):
    row = "named_struct('type', role, 'sessionId', 's' || conv_id, 'timestamp', '2026-01-01T00:00:' || lpad(cast(60 - turn as string), 2, '0'), 'message', named_struct('role', role, 'content', text))"
    return _flat(L.event_log(_lines(c, FILE, AT, row)))


SNIFFED = "case conv_id % 10 when 0 then 'gpt_distilled' when 1 then 'fable_traces' when 2 then 'gpt_terminal' when 3 then 'codex_log' when 4 then 'pi_traces' when 5 then 'claude_code_log' else 'unknown' end"


@query(f"select {SNIFFED} as format, count(*) as lines, count(*) filter (turn > 0) as parsed, count(distinct conv_id % 10) as files from conversations group by 1")
def log_formats(c):
    fields = """case conv_id % 10 when 0 then '{"text": "x", "quality_score": 1}' when 1 then '{"context": "x", "cot": ""}' when 2 then '{"task_name": "x", "prompt": "y", "solution": []}' when 3 then '{"type": "session_meta"}'
      when 4 then '{"type": "model_change"}' when 5 then '{"type": "ai-title"}' else '{"other": 1}' end"""
    return L.format_counts(c.selectExpr(f"{FILE} as file", f"cast({AT} as bigint) as at", f"case when turn > 0 then parse_json({fields}) end as row"))


@query(f"""with s as (select conv_id, count(*) filter (role = 'user') as users, count(*) filter (role = 'assistant') as replies, string_agg(case when role = 'user' then role || ':' || to_json(text) end, chr(10) order by turn) as asked,
    string_agg(role || ':' || case when role = 'assistant' then '[' || '{{"text":' || to_json(text) || ',"type":"text"}}]' else to_json(text) end, chr(10) order by turn) as answered,
    string_agg(role || ':' || case when role = 'assistant' then '[' || '{{"text":' || to_json(text) || ',"type":"text"}}]' else to_json(text) end, chr(10) order by turn) as whole from conversations group by conv_id)
  select conv_id, 'question' as category, asked as said from s where users > 0 union all
  select conv_id, case when users >= 2 then 'question-multi' else 'question-answer' end, case when users >= 2 then whole else answered end from s where users >= 2 or replies > 0""".replace("{{", "{").replace("}}", "}"))
def session_records(c):
    content = F.when(F.col("role") == "assistant", F.to_json(F.array(F.struct(F.col("text").alias("text"), F.lit("text").alias("type"))))).otherwise(L.json_text(F.col("text")))
    m = c.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", L.message(F.col("role"), content).alias("m")))), lambda x: x["m"]).alias("messages"))
    said = F.array_join(F.transform("messages", lambda x: F.concat(x["role"], F.lit(":"), x["content"])), "\n")
    return sessions.records(m).select("conv_id", "category", said.alias("said"))


@query("""select conv_id, cast(sum(length(text) + case when role = 'assistant' then 7 else 0 end) as bigint) as chars, count(*) filter (role = 'user' and trim(text) <> '') as asked from conversations group by conv_id""")
def session_content(c):
    blocks = F.to_json(F.array(F.struct(F.lit("text").alias("type"), F.col("text").alias("text"), F.lit(None).cast("struct<x:int>").alias("input")), F.struct(F.lit("tool_use").alias("type"), F.lit(None).cast("string").alias("text"), F.struct(F.lit(1).alias("x")).alias("input"))))
    content = F.when(F.col("role") == "assistant", blocks).otherwise(L.json_text(F.col("text")))
    return c.groupBy("conv_id").agg(F.sum(sessions.content_chars(content)).alias("chars"), F.count_if((F.col("role") == "user") & sessions.asks(content)).alias("asked"))
