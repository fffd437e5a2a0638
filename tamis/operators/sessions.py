"""Chat sessions: classification, views, islands of speakers, forward fill and marker-based segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamis.functions.text import detect_lang
from tamis.operators.scan import scanned

CATEGORIES = ["question", "question-answer", "question-answer-tool-call", "question-multi"]


def category(users: Column, assistants: Column, tools: Column) -> Column:
    """Category from a session's counts of real user messages, assistant messages and tool uses."""
    return (
        F.when(users >= 2, "question-multi").when(tools > 0, "question-answer-tool-call")
        .when(assistants > 0, "question-answer").otherwise("question")
    )


def features(messages: DataFrame, session: str = "conv_id") -> DataFrame:
    """Flat messages (session, turn, role, text) to one row a session, by partial sums."""
    role = lambda r: F.count_if(F.col("role") == r)
    return messages.groupBy(session).agg(
        F.count(F.lit(1)).alias("n_messages"), role("user").alias("n_users"), role("assistant").alias("n_assistants"), role("tool").alias("n_tools"),
        F.sum(F.length(F.coalesce("text", F.lit("")))).alias("n_chars"),
    ).withColumn("category", category(F.col("n_users"), F.col("n_assistants"), F.col("n_tools")))


def first_user(messages: DataFrame, session: str = "conv_id") -> DataFrame:
    return messages.where("role = 'user'").groupBy(session).agg(F.min_by("text", "turn").alias("first_user"))


def islands(messages: DataFrame, session: str = "conv_id") -> DataFrame:
    """Consecutive messages of one role become one message; their texts stand in turn order, cut by newlines."""
    before = scanned(messages, [session], ["turn"], previous={"before": F.struct("role")})
    starts = (F.col("before").isNull() | ~F.col("before.role").eqNullSafe(F.col("role"))).cast("int")
    marked = scanned(before, [session], ["turn"], sums={"island": starts})
    return marked.groupBy(session, "island", "role").agg(
        F.count(F.lit(1)).alias("n"), F.concat_ws("\n", F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda m: m["text"])).alias("text")
    )


def segments(events: DataFrame, key: str, order: list[str], marker: Column) -> DataFrame:
    """Number of markers up to each row: rows between two markers share a segment."""
    return scanned(events, [key], order, sums={"segment": marker.cast("int")})


def filled(events: DataFrame, key: str, order: list[str], value: Column, default) -> DataFrame:
    """Last value that was not null, up to each row."""
    return scanned(events, [key], order, lasts={"filled": value}).withColumn("filled", F.coalesce("filled", F.lit(default)))


BLOCK = "struct<type:string,text:string,name:string,input:string>"


def blocks(content: Column) -> Column:
    """Raw JSON content to an array of blocks: a string is one text block, an array is itself, else nothing."""
    text = F.array(F.struct(F.lit("text").alias("type"), F.get_json_object(F.concat(F.lit('{"v":'), content, F.lit("}")), "$.v").alias("text"), F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("input")))
    return F.when(F.startswith(content, F.lit('"')), text.cast(f"array<{BLOCK}>")).when(F.startswith(content, F.lit("[")), F.from_json(content, f"array<{BLOCK}>")).otherwise(F.array().cast(f"array<{BLOCK}>"))


def real_user(message: Column) -> Column:
    """A user's message that doesn't consist of tool results only."""
    b = blocks(message["content"])
    return (message["role"] == "user") & ((F.size(b) == 0) | F.exists(b, lambda x: F.coalesce(x["type"] != "tool_result", F.lit(True))))


def uses_tool(message: Column) -> Column:
    return (message["role"] == "tool") | ((message["role"] == "assistant") & F.exists(blocks(message["content"]), lambda x: F.coalesce(x["type"] == "tool_use", F.lit(False))))


def nested_category(messages: Column) -> Column:
    """Category of an array of (role, raw JSON content) messages."""
    count = lambda p: F.size(F.filter(messages, p))
    return category(count(real_user), count(lambda m: m["role"] == "assistant"), count(uses_tool))


def question_view(messages: Column) -> Column:
    return F.filter(messages, real_user)


def answer_view(messages: Column) -> Column:
    """Without tool messages and users' messages of tool results only; tool uses go from assistants' contents."""
    kept = F.filter(messages, lambda m: (m["role"] != "tool") & ~((m["role"] == "user") & ~real_user(m)))
    own = lambda m: F.try_variant_get(F.try_parse_json(m["content"]), "$", "array<variant>")
    is_use = lambda b: F.coalesce(F.try_variant_get(b, "$.type", "string") == "tool_use", F.lit(False))
    cleared = lambda m: F.struct(m["role"].alias("role"), F.to_json(F.filter(own(m), lambda b: ~is_use(b))).alias("content"))
    return F.transform(kept, lambda m: F.when((m["role"] == "assistant") & uses_tool(m), cleared(m)).otherwise(F.struct(m["role"].alias("role"), m["content"].alias("content"))))


def records(sessions: DataFrame) -> DataFrame:
    """messages -> up to two rows: the question view (if not empty), and the session under its category (unless that is question).

    Plain question-answer sessions come as their answer view.
    """
    cat = nested_category(F.col("messages"))
    q = F.when(F.size(question_view(F.col("messages"))) > 0, F.struct(F.lit("question").alias("category"), question_view(F.col("messages")).alias("messages")))
    s = F.when(cat != "question", F.struct(cat.alias("category"), F.when(cat == "question-answer", answer_view(F.col("messages"))).otherwise(F.col("messages")).alias("messages")))
    return sessions.withColumn("r", F.explode(F.array_compact(F.array(q, s)))).select(*[c for c in sessions.columns if c != "messages"], "r.category", "r.messages")


def asks(content: Column) -> Column:
    """The statistics' own rule of a real question: not a blank text, not an empty list, not tool results only."""
    blank = F.when(F.startswith(content, F.lit('"')), F.trim(F.get_json_object(F.concat(F.lit('{"v":'), content, F.lit("}")), "$.v")) == "").otherwise(F.size(blocks(content)) == 0)
    results = (F.size(blocks(content)) > 0) & F.forall(blocks(content), lambda b: F.coalesce(b["type"] == "tool_result", F.lit(False)))
    return ~blank & ~results


def content_text(content: Column, most: int = 800) -> Column:
    """The first characters of a content: its text, or its blocks' texts (or contents that are texts) one after the other."""
    v = F.try_parse_json(content)
    is_text = lambda b: F.schema_of_variant(b) == "STRING"
    text_at = lambda b, path: F.when(F.coalesce(is_text(F.try_variant_get(b, path, "variant")), F.lit(False)), F.try_variant_get(b, path, "string"))
    of = lambda b: F.when(is_text(b), F.try_variant_get(b, "$", "string")).otherwise(F.coalesce(text_at(b, "$.text"), text_at(b, "$.content"), F.lit("")))
    listed = F.try_variant_get(v, "$", "array<variant>")
    whole = F.when(listed.isNotNull(), F.array_join(F.transform(listed, of), "")).when(is_text(v), F.try_variant_get(v, "$", "string")).otherwise("")
    return F.substring(F.coalesce(whole, F.lit("")), 1, most)


def bucket_scan(lines: DataFrame, bucket: str = "bucket") -> DataFrame:
    """lines: bucket, value (a line of session records). One aggregate: bucket, bytes, records, bad_lines, messages, chars, turns, by role
    users, assistants, tools, systems; thinking and tool_uses (blocks), and zh, en, other (records by the language of the first real question).
    """
    row = F.try_parse_json("value")
    messages = F.coalesce(F.try_variant_get("row", "$.messages", "array<variant>"), F.array().cast("array<variant>"))
    role = lambda m: F.coalesce(F.try_variant_get(m, "$.role", "string"), F.lit("unknown"))
    content = lambda m: F.to_json(F.try_variant_get(m, "$.content", "variant"))
    d = lines.where(F.col("value") != "").select(F.col(bucket).alias("bucket"), (F.octet_length("value") + 1).alias("size"), row.alias("row"))
    d = d.withColumn("m", F.transform(messages, lambda m: F.struct(role(m).alias("role"), F.coalesce(content(m), F.lit("null")).alias("content"))))
    m = F.col("m")
    kinds = lambda kind: F.aggregate(m, F.lit(0), lambda n, x: n + F.size(F.filter(blocks(x["content"]), lambda b: F.coalesce(b["type"] == kind, F.lit(False)))))
    asked = F.filter(m, lambda x: (x["role"] == "user") & asks(x["content"]))
    lang = detect_lang(content_text(F.coalesce(F.try_element_at(asked, F.lit(1))["content"], F.lit('""'))))
    of = lambda name: F.sum(F.size(F.filter(m, lambda x: x["role"] == name)))
    good = F.col("row").isNotNull()
    sums = {"messages": F.size(m), "chars": F.aggregate(m, F.lit(0), lambda n, x: n + content_chars(x["content"])), "turns": F.size(asked), "thinking": kinds("thinking"), "tool_uses": kinds("tool_use")}
    counts = [F.sum("size").alias("bytes"), F.count_if(good).alias("records"), F.count_if(~good).alias("bad_lines"), *[F.sum(c).alias(n) for n, c in sums.items()]]
    counts += [of(r).alias(f"{r}s") for r in ("user", "assistant", "tool", "system")] + [F.count_if(good & (lang == x)).alias(x) for x in ("zh", "en", "other")]
    return d.groupBy("bucket").agg(*counts)


def content_chars(content: Column) -> Column:
    """Characters of a content: its text, or of each block its text, its content, or its input as JSON."""
    of = lambda b: F.coalesce(*[F.try_variant_get(b, path, "string") for path in ("$.text", "$.content", "$.input")], F.when(F.schema_of_variant(b) == "STRING", F.try_variant_get(b, "$", "string")), F.lit(""))
    v = F.try_parse_json(content)
    listed = F.try_variant_get(v, "$", "array<variant>")
    return F.when(listed.isNotNull(), F.aggregate(listed, F.lit(0), lambda a, b: a + F.length(of(b)))).otherwise(F.length(F.coalesce(F.try_variant_get(v, "$", "string"), F.lit(""))))
