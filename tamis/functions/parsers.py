"""Parsers of answers and options in texts, as Column expressions; two small helpers read Python and TOML literals."""

from __future__ import annotations

import ast
import json
import tomllib

from pyspark.sql import Column
from pyspark.sql import functions as F

from tamis.functions.text import null_empty, strip

OPTION = "struct<letter:string,text:string>"


def boxed(c: Column) -> Column:
    r"""Content of the last balanced \boxed{...}; if that is blank, the word behind the last \boxed without braces; else empty."""
    text = null_empty(c)
    pieces = F.split(text, r"\\boxed\{", -1)
    rests = F.transform(F.sequence(F.lit(2), F.size(pieces)), lambda k: F.array_join(F.slice(pieces, k, F.size(pieces)), "\\boxed{"))
    start = F.struct(F.lit(1).alias("depth"), F.lit(0).alias("n"))

    def step(s, ch):  # counts characters until the brace that closes; depth 0 ends it
        depth = s["depth"] + F.when(ch == "{", 1).when(ch == "}", -1).otherwise(0)
        return F.when(s["depth"] == 0, s).otherwise(F.struct(depth.alias("depth"), (s["n"] + 1).alias("n")))

    inside = F.transform(rests, lambda r: F.aggregate(F.split(r, ""), start, step, lambda s: F.when(s["depth"] == 0, F.substring(r, F.lit(1), s["n"] - 1))))
    last = strip(F.try_element_at(F.array_compact(F.when(F.size(pieces) > 1, inside).otherwise(F.array().cast("array<string>"))), F.lit(-1)))
    bare = F.element_at(F.concat(F.array(F.lit("")), F.regexp_extract_all(text, F.lit(r"\\boxed\s+([^\s$.\\,;]+)"), F.lit(1))), -1)
    return F.when(last != "", last).otherwise(bare)


def lettered(option: Column) -> Column:
    """'A) text' to (letter, text); no letter where there is none."""
    return F.struct(F.regexp_extract(option, r"^\s*([A-E])\)", 1).alias("letter"), strip(F.regexp_replace(option, r"^\s*[A-E]\)\s*", "")).alias("text"))


def pairs(text: Column, marker: str) -> Column:
    """(letter, text up to the next marker) of every marker, whose first group is the letter."""
    letters, pieces = F.regexp_extract_all(text, F.lit(marker), F.lit(1)), F.split(text, marker, -1)
    return F.zip_with(letters, F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0))), lambda k, p: F.struct(k.alias("letter"), strip(p).alias("text")))


def marked_options(text: Column) -> Column:
    """'a ) x , b ) y' to (letter, text); a repeated marker 'a ) a ) x' counts once, by its last place."""
    every = pairs(null_empty(text), r"([a-eA-E])\s*\)")
    low = F.transform(every, lambda p: F.struct(F.lower(p["letter"]).alias("letter"), F.regexp_replace(strip(F.regexp_replace(p["text"], r"\s*,?\s*$", "")), ",+$", "").alias("text")))
    last = lambda all_: F.filter(all_, lambda p, k: (k == F.size(all_) - 1) | (F.try_element_at(all_, k + 2)["letter"] != p["letter"]))
    return F.transform(F.array(low), last)[0]  # evaluated once, not for every element


def choice_list(field: Column, is_list: Column, items: Column) -> Column:
    """Choices from a list, the text of a Python list, or 'A. x, B. y', to (letter, text)."""
    text = null_empty(field)
    listed = F.from_json(literal_json(text), "array<string>")
    given = F.when(is_list, items).when(text == "", F.array().cast("array<string>")).otherwise(F.coalesce(listed, F.transform(F.split(text, r",\s*(?=[A-Z]\.)"), strip)))
    letter = r"^([A-Z])[.\)]\s*"
    return F.transform(given, lambda x: F.struct(F.regexp_extract(strip(x), letter, 1).alias("letter"), strip(F.regexp_replace(strip(x), letter, "")).alias("text")))


def from_a(found: Column) -> Column:
    """Options that a question holds: null unless there are two at least and the first is A."""
    return F.when((F.size(found) >= 2) & (found[0]["letter"] == "A"), found)


def before_first(text: Column, marker: str) -> Column:
    """What stands before the first marker."""
    return strip(F.element_at(F.split(text, marker, 2), 1))


# How options are marked in exam papers, after a colon, and within a line.
PAPER_OPTION = r"(?:^|\n|\s)([A-E])\s*[．.、)]\s*"
COLON_OPTION = r"(?:^|\s)([A-E])\s*[:：]\s*"
INLINE_OPTION = r"(?<![A-Za-z0-9])([A-D])[:：]"


def text_of(options: Column, letter: Column) -> Column:
    """Text of the last option with a letter; null without one."""
    return F.try_element_at(F.filter(options, lambda p: p["letter"] == letter), F.lit(-1))["text"]


def first_of_json_array(c: Column) -> Column:
    """First element of a JSON array, a JSON scalar, or the text itself where it is no JSON."""
    v = F.try_parse_json(c)
    kind = F.schema_of_variant(v)
    first = F.coalesce(F.try_variant_get(v, "$[0]", "string"), F.lit(""))
    return F.when(v.isNull(), null_empty(c)).when(F.startswith(kind, F.lit("ARRAY")), first).otherwise(F.coalesce(F.try_variant_get(v, "$", "string"), F.lit("")))


def literal_json(c: Column) -> Column:
    """JSON of a Python literal in a text; null where it is none."""

    @F.udf("string", useArrow=True)
    def read(text):
        try:
            return None if text is None else json.dumps(ast.literal_eval(text), ensure_ascii=False)
        except (ValueError, SyntaxError, TypeError, MemoryError, RecursionError):
            return None

    return read(c)


def toml_json(c: Column) -> Column:
    """JSON of a TOML text; {} where it is missing or isn't TOML."""

    @F.udf("string", useArrow=True)
    def read(text):
        try:
            return json.dumps(tomllib.loads(text or ""), ensure_ascii=False, default=str)
        except tomllib.TOMLDecodeError:
            return "{}"

    return read(c)


def leaves(c: Column) -> Column:
    """All texts of a nested list, given as JSON or as a Python literal, in order; a plain text is its own leaf."""

    @F.udf("array<string>", useArrow=True)
    def read(text):
        def walk(x):
            if isinstance(x, str):
                try:
                    x = ast.literal_eval(x)
                except (ValueError, SyntaxError, MemoryError, RecursionError):
                    pass
            if isinstance(x, (list, tuple)):
                return [leaf for item in x for leaf in walk(item)]
            return [str(x)] if str(x) else []

        if text is None:
            return []
        try:
            return walk(json.loads(text))
        except ValueError:
            return walk(text)

    return read(c)


def template(instruction: Column, values: Column, strict: bool = False) -> Column:
    """{{column}} places filled from a map with lower-case keys; if one of them has no value: empty, or with strict an error that names it."""
    fields = F.array_distinct(F.regexp_extract_all(instruction, F.lit(r"\{\{(\w+)\}\}"), F.lit(1)))
    value = lambda f: null_empty(F.try_element_at(values, F.lower(f)))
    filled = F.aggregate(fields, instruction, lambda a, f: F.replace(a, F.concat(F.lit("{{"), f, F.lit("}}")), value(f)))
    missing = F.filter(fields, lambda f: value(f) == "")
    if strict:
        return F.when(F.size(missing) > 0, F.raise_error(F.concat(F.lit("no value for "), F.array_join(missing, ", ")))).otherwise(filled)
    return F.when(F.size(missing) > 0, "").otherwise(filled)
