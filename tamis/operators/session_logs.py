"""Session logs of several tools to sessions: which format a file has, and its sessions as arrays of (role, raw JSON content).

Lines come as ``file``, ``at`` (their order in the file) and ``row`` (VARIANT; null where a line is no JSON). A parser
returns file, session (null where a line is a session by itself), line, messages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamis.functions.text import null_empty, strip
from tamis.operators.scan import scanned

MESSAGE = "struct<role:string,content:string>"

# What tells a format, in this order: fields that a line has, or its type.
FIELDS = (("gpt_distilled", ("text", "quality_score")), ("fable_traces", ("context", "cot")), ("gpt_terminal", ("task_name", "prompt", "solution")))
TYPES = (
    ("codex_log", ("session_meta", "response_item")),
    ("pi_traces", ("session", "model_change", "thinking_level_change")),
    ("claude_code_log", ("custom-title", "ai-title", "mode", "queue-operation", "user", "assistant", "last-prompt", "permission-mode", "file-history-snapshot", "bridge-session", "agent-name")),
)
# Marks around the parts of a distilled text, and turns that are a tool's own.
USER_MARK, ASSISTANT_MARK, END_MARK = "<|user|>", "<|assistant|>", "<|end|>"
TOOL_TURNS = ("<local-command-caveat>", "<command-name>", "<command-message>", "<command-args>", "<local-command-stdout>", "<local-command-stderr>")


def get(path: str, kind: str = "string", of: str | Column = "row") -> Column:
    return F.try_variant_get(of, f"$.{path}", kind)


def json_text(c: Column) -> Column:
    """A text as a JSON string."""
    listed = F.to_json(F.array(c))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def message(role, content: Column) -> Column:
    return F.struct((F.lit(role) if isinstance(role, str) else role).alias("role"), content.alias("content")).cast(MESSAGE)


def block(kind: str, **fields: Column) -> Column:
    """A content block; one shape for all kinds, what a kind hasn't is null and left out of the JSON."""
    names = ("thinking", "text", "name", "input")
    return F.struct(F.lit(kind).alias("type"), *[fields.get(n, F.lit(None)).cast("string").alias(n) for n in names])


BLOCKS = "array<struct<type:string,thinking:string,text:string,name:string,input:string>>"


def present(items: list[Column], kind: str = BLOCKS) -> Column:
    return F.array_compact(F.array(*items)).cast(kind)


def format_of(lines: DataFrame) -> DataFrame:
    """file, format: told by each file's first line that is JSON; 'unknown' where nothing fits."""
    keys = F.map_keys(F.col("row").cast("map<string,string>"))
    name = F.lit(None).cast("string")
    for label, types in reversed(TYPES):
        name = F.when(get("type").isin(*types), label).otherwise(name)
    for label, fields in reversed(FIELDS):
        name = F.when(F.array_size(F.array_intersect(keys, F.array(*map(F.lit, fields)))) == len(fields), label).otherwise(name)
    told = F.min_by(F.coalesce(name, F.lit("unknown")), F.when(F.col("row").isNotNull(), F.col("at")))
    return lines.groupBy("file").agg(F.coalesce(told, F.lit("unknown")).alias("format"))


def _by_line(lines: DataFrame, messages: Column, keep: Column) -> DataFrame:
    return lines.where(F.col("row").isNotNull()).where(keep).select("file", F.lit(None).cast("string").alias("session"), F.col("at").alias("line"), messages.alias("messages"))


def distilled(lines: DataFrame) -> DataFrame:
    """A text with marks is one question and its answer."""
    text = null_empty(get("text"))
    after = F.when(F.contains(text, F.lit(USER_MARK)), F.substring(text, F.instr(text, USER_MARK) + len(USER_MARK), F.length(text)))
    question = strip(F.when(F.contains(after, F.lit(ASSISTANT_MARK)), F.substring_index(after, ASSISTANT_MARK, 1)))
    answer = F.substring(after, F.instr(after, ASSISTANT_MARK) + len(ASSISTANT_MARK), F.length(after))
    answer = strip(F.substring_index(answer, END_MARK, 1))
    return _by_line(lines, F.array(message("user", json_text(question)), message("assistant", json_text(answer))), question != "")


def traces(lines: DataFrame) -> DataFrame:
    """Turns cut from a context, then one assistant message of thinking and a tool use or text."""
    turns = F.transform(F.slice(F.split(null_empty(get("context")), "USER:"), F.lit(2), F.lit(1 << 30)), strip)
    own = lambda q: F.exists(F.array(*map(F.lit, TOOL_TURNS)), lambda p: F.startswith(q, p))
    users = F.transform(F.filter(turns, lambda q: (q != "") & ~own(q)), lambda q: message("user", json_text(q)))
    kind, said = get("output_type"), null_empty(get("output.text"))
    blocks = present([
        F.when(null_empty(get("cot")) != "", block("thinking", thinking=get("cot"))),
        F.when(kind == "tool_use", block("tool_use", name=null_empty(get("output.tool")), input=null_empty(get("output.input")))).when((kind == "text") & (said != ""), block("text", text=said)),
    ])
    reply = F.when(F.size(blocks) > 0, F.array(message("assistant", F.to_json(blocks)))).otherwise(F.array().cast(f"array<{MESSAGE}>"))
    return _by_line(lines, F.concat(users, reply), F.size(users) > 0)


def terminal(lines: DataFrame) -> DataFrame:
    """Instructions, a prompt, and steps of thinking, commands and terminal output. A session of one message is none."""

    def step(s: Column) -> Column:
        analysis, plan = null_empty(get("analysis", of=s)), null_empty(get("plan", of=s))
        thinking = F.concat(analysis, F.when(plan == "", "").when(analysis == "", plan).otherwise(F.concat(F.lit("\n\nPlan: "), plan)))
        commands = F.coalesce(F.array_join(get("commands", "array<string>", s), "\n"), get("commands", of=s))
        blocks = present([F.when(thinking != "", block("thinking", thinking=thinking)), F.when(get("commands", of=s).isNotNull() & (get("commands", of=s) != ""), block("tool_use", name=F.lit("shell"), input=commands))])
        output = null_empty(get("terminal_output", of=s))
        return present([F.when(F.size(blocks) > 0, message("assistant", F.to_json(blocks))), F.when(output != "", message("tool", json_text(output)))], f"array<{MESSAGE}>")

    system, prompt = null_empty(get("system_instructions")), null_empty(get("prompt"))
    head = present([F.when(system != "", message("system", json_text(system))), F.when(prompt != "", message("user", json_text(prompt)))], f"array<{MESSAGE}>")
    steps = F.coalesce(get("solution", "array<variant>"), F.array().cast("array<variant>"))
    messages = F.concat(head, F.flatten(F.transform(steps, step)))
    return _by_line(lines, messages, F.size(messages) > 1)


def _collected(items: DataFrame, *keys: str) -> DataFrame:
    """items: keys, at, message. Messages of each session in order; a session is held by one task, files are not."""
    ordered = F.array_sort(F.collect_list(F.struct("at", "message")))
    return items.groupBy(*keys).agg(F.transform(ordered, lambda m: m["message"]).alias("messages"))


def codex_items(lines: DataFrame) -> DataFrame:
    """file, at, named (the session that a line opens), block (a piece of an assistant message), other (a message of another role)."""
    d = lines.where(get("type").isin("session_meta", "response_item"))
    named = F.when(get("type") == "session_meta", get("payload.id"))
    item = get("type") == "response_item"
    p = lambda path, kind="string": get(f"payload.{path}", kind)
    texts = lambda path: F.filter(F.transform(F.coalesce(p(path, "array<variant>"), F.array().cast("array<variant>")), lambda b: null_empty(get("text", of=b))), lambda t: t != "")
    said, thought, kind, role = F.array_join(texts("content"), "\n"), F.array_join(texts("summary"), ""), p("type"), p("role")
    call = lambda name, value: block("tool_use", name=name, input=null_empty(value))
    own = (
        F.when((kind == "message") & (role == "assistant"), block("text", text=said)).when((kind == "reasoning") & (thought != ""), block("thinking", thinking=thought))
        .when(kind == "function_call", call(null_empty(p("name")), p("arguments"))).when(kind == "custom_tool_call", call(null_empty(p("name")), p("input")))
        .when(kind == "web_search_call", call(F.lit("web_search"), p("action.query")))
    )
    other = (
        F.when((kind == "message") & (role == "developer"), message("system", json_text(said))).when((kind == "message") & (role == "user"), message("user", json_text(said)))
        .when(kind.isin("function_call_output", "custom_tool_call_output"), message("tool", F.coalesce(F.to_json(p("output", "variant")), F.lit('""'))))
    )
    return d.select("file", "at", named.alias("named"), F.when(item, own).alias("block"), F.when(item, other).alias("other"))


def codex_sessions(items: DataFrame) -> DataFrame:
    """items: file, session, at, island, block, other. The blocks of an island are one assistant message."""
    blocks = F.transform(F.array_sort(F.collect_list(F.when(F.col("block").isNotNull(), F.struct("at", "block")))), lambda b: b["block"])
    islands = items.groupBy("file", "session", "island").agg(F.min("at").alias("first"), F.first("other", ignorenulls=True).alias("other"), F.min(F.when(F.col("block").isNotNull(), F.col("at"))).alias("at"), blocks.alias("blocks"))
    single = islands.where("other is not null").select("file", "session", F.col("first").alias("at"), F.col("other").alias("message"))
    joined = islands.where("size(blocks) > 0").select("file", "session", "at", message("assistant", F.to_json(F.col("blocks").cast(BLOCKS))).alias("message"))
    return _collected(single.unionByName(joined), "file", "session").select("file", "session", F.lit(0).cast("long").alias("line"), "messages")


def codex(lines: DataFrame) -> DataFrame:
    """Items under the session last named; texts, reasoning and calls between two other messages become one assistant message."""
    d = scanned(codex_items(lines), ["file"], ["at"], lasts={"session": F.col("named")})
    items = d.withColumn("session", F.coalesce("session", F.lit("default"))).where("block is not null or other is not null")
    return codex_sessions(scanned(items, ["file", "session"], ["at"], sums={"island": F.col("other").isNotNull().cast("int")}))


def pi(lines: DataFrame) -> DataFrame:
    """Messages between two session marks; a later session of the same id is another one. toolCall blocks become tool_use."""
    marks = (get("type") == "session").cast("int")
    d = scanned(lines.where(get("type").isin("session", "message")), ["file"], ["at"], sums={"mark": marks})
    raw = get("message.content", "variant")
    blocks = get("message.content", "array<variant>")
    renamed = F.transform(blocks, lambda b: F.when(get("type", of=b) == "toolCall", F.to_variant_object(F.struct(F.lit("tool_use").alias("type"), null_empty(get("name", of=b)).alias("name"), F.coalesce(get("arguments", "variant", b), F.parse_json(F.lit('""'))).alias("input")))).otherwise(b))
    content = F.when(blocks.isNotNull(), F.to_json(renamed)).otherwise(F.to_json(raw))
    d = d.withColumn("id", F.when(get("type") == "session", get("id"))).withColumn("message", F.when((get("type") == "message") & raw.isNotNull() & ~F.is_variant_null(raw), message(get("message.role"), content)))
    named = d.where("mark > 0").groupBy("file", "mark").agg(F.max("id").alias("session"), F.transform(F.array_sort(F.collect_list(F.when(F.col("message").isNotNull(), F.struct("at", "message")))), lambda m: m["message"]).alias("messages"))
    return named.where("session is not null and size(messages) > 0").select("file", "session", F.lit(0).cast("long").alias("line"), "messages")


def event_log(lines: DataFrame) -> DataFrame:
    """User and assistant events by their session id, in the order of their times (then of their lines)."""
    d = lines.where(get("type").isin("user", "assistant") & (null_empty(get("sessionId")) != ""))
    content = get("message.content", "variant")
    items = d.where(content.isNotNull() & ~F.is_variant_null(content)).select(
        "file", get("sessionId").alias("session"), F.struct(null_empty(get("timestamp")).alias("time"), F.col("at")).alias("at"), message(F.coalesce(get("message.role"), get("type")), F.to_json(content)).alias("message"))
    return _collected(items, "file", "session").select("file", "session", F.lit(0).cast("long").alias("line"), "messages")


PARSERS = {"gpt_distilled": distilled, "fable_traces": traces, "gpt_terminal": terminal, "codex_log": codex, "pi_traces": pi, "claude_code_log": event_log}


def parsed(lines: DataFrame) -> DataFrame:
    """Sessions of files of any known format; lines of others give none."""
    told = lines.join(format_of(lines), "file")
    out = None
    for name, parse in PARSERS.items():
        part = parse(told.where(F.col("format") == name).drop("format")).withColumn("format", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


def format_counts(lines: DataFrame) -> DataFrame:
    """Lines, and lines that are JSON, by format; those of unknown formats are counted too."""
    return lines.join(format_of(lines), "file").groupBy("format").agg(F.count(F.lit(1)).alias("lines"), F.count("row").alias("parsed"), F.countDistinct("file").alias("files"))
