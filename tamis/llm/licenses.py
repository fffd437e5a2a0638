"""License scans by ordered signature rules (DataFrame functions only).

A document's words are joined by single blanks; only if a rule's keyword occurs in that
line is it looked at further. There each rule whose pattern's longest fixed part
occurs is matched against the line, and every match becomes a detection: label,
first and last word, priority, confidence. A detection whose interval lies inside that of
another with a higher priority (or the same priority and a longer interval) is suppressed. Everything
happens within the row: there is no shuffle, and the rule table is a literal.

Columns of the input named n_words, base, found or __d are replaced. Null or empty text: no words, no places, empty labels, score 0. Texts of any length are scanned whole; of detections with equal priority and interval all stay; an empty table: no rows. Rows, also
repeated ones and null ids, are each answered; columns beyond doc_id and text are ignored.
"""

from __future__ import annotations

import json
import re
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tamis.llm.common import table

# Fixed by the contract: words, phrases and their labels.
# Words are what stands between separators: once A-Z are lower case, runs of [^\x00-\x2F\x3A-\x60\x7B-\x7F].
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def version(text: str) -> str:
    """'2.0' as words: '2 0', 'v2 0', 'version 2 0' or 'version 2'."""
    major, _, minor = text.partition(".")
    tail = "" if not minor else f"(?: {minor})?" if minor == "0" else f" {minor}"
    return f"(?:v|version |v )?{major}{tail}"


def rules() -> list[tuple[str, str, str, int, float]]:
    """(label, keyword, pattern over blank-joined words, priority, confidence), most specific families first.

    A line that a pattern matches in holds the rule's keyword; keywords are chosen so that common words of other languages (the
    German "mit") aren't among them.
    """
    out: list[tuple[str, str, str, int, float]] = []
    add = lambda label, keyword, pattern, priority, confidence: out.append((label, keyword, pattern, priority, confidence))
    # Creative Commons: element sets by name and by abbreviation, with and without version.
    elements = {
        "by": ("by", "attribution"),
        "by-sa": ("by sa", "attribution share ?alike"),
        "by-nc": ("by nc", "attribution non ?commercial"),
        "by-nd": ("by nd", "attribution no ?deriv(?:ative)?s?(?: works)?"),
        "by-nc-sa": ("by nc sa", "attribution non ?commercial share ?alike"),
        "by-nc-nd": ("by nc nd", "attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?"),
    }
    for k, (name, (short, long)) in enumerate(elements.items()):
        for v in ("1.0", "2.0", "2.5", "3.0", "4.0"):
            add(f"cc-{name}-{v}", " cc ", f"cc {short} {version(v)}", 90 + k, 1.0)
            add(f"cc-{name}-{v}", " creative commons ", f"creative commons {long} (?:international |unported |generic )?{version(v)}", 90 + k, 1.0)
        if name != "by":
            add(f"cc-{name}", " cc ", f"cc {short}", 60 + k, 0.9)
        add(f"cc-{name}", " creative commons ", f"creative commons {long}", 60 + k, 0.9)
    add("cc0-1.0", " cc", f"cc ?(?:0|zero) {version('1.0')}", 95, 1.0)
    add("cc0-1.0", " cc", "cc ?(?:0|zero)", 60, 0.9)
    add("cc-unspecified", " creative commons ", "creative commons(?: license)?", 20, 0.5)
    # GNU family.
    gnu = {
        "gpl": ("gnu general public license", ("1.0", "2.0", "3.0")),
        "lgpl": ("(?:gnu )?(?:lesser|library) general public license", ("2.0", "2.1", "3.0")),
        "agpl": ("(?:gnu )?affero general public license", ("1.0", "3.0")),
    }
    for name, (long, versions) in gnu.items():
        for v in versions:
            for suffix, words in (("-or-later", " or (?:any )?later(?: version)?"), ("-only", " only"), ("", "")):
                add(f"{name}-{v}{suffix}", " general public license ", f"{long} {version(v)}{words}", 90 + bool(suffix), 1.0)
                add(f"{name}-{v}{suffix}", f" {name}", f"{name} ?{version(v)}{words}", 80 + bool(suffix), 0.95)
        add(f"{name}-unspecified", " general public license ", long, 40, 0.7)
        add(f"{name}-unspecified", f" {name} ", f"{name} licensed?", 40, 0.6)
    for v in ("1.1", "1.2", "1.3"):
        add(f"gfdl-{v}", " free documentation license ", f"(?:gnu )?free documentation license {version(v)}", 90, 1.0)
    add("gfdl-unspecified", " free documentation license ", "(?:gnu )?free documentation license", 40, 0.7)
    # Families of one name and several versions: label, words of the name, versions.
    for label, long, versions in (
        ("apache", "apache (?:software )?license", ("1.0", "1.1", "2.0")),
        ("mpl", "mozilla public license", ("1.0", "1.1", "2.0")),
        ("epl", "eclipse public license", ("1.0", "2.0")),
        ("cpl", "common public license", ("1.0",)),
        ("cddl", "common development and distribution license", ("1.0", "1.1")),
        ("eupl", "european union public licen[cs]e", ("1.0", "1.1", "1.2")),
        ("ofl", "(?:sil )?open font license", ("1.0", "1.1")),
        ("artistic", "artistic license", ("1.0", "2.0")),
        ("osl", "open software license", ("1.0", "2.0", "2.1", "3.0")),
        ("afl", "academic free license", ("1.1", "1.2", "2.0", "2.1", "3.0")),
        ("zpl", "zope public license", ("1.1", "2.0", "2.1")),
        ("psf", "python software foundation license", ("2.0",)),
        ("php", "php license", ("3.0", "3.01")),
        ("lppl", "latex project public license", ("1.0", "1.1", "1.2", "1.3")),
        ("odbl", "open database license", ("1.0",)),
        ("odc-by", "open data commons attribution license", ("1.0",)),
        ("ms-pl", "microsoft public license", ()),
        ("ms-rl", "microsoft reciprocal license", ()),
        ("ipl", "ibm public license", ("1.0",)),
        ("upl", "universal permissive license", ("1.0",)),
        ("ecl", "educational community license", ("1.0", "2.0")),
        ("bsl", "boost software license", ("1.0",)),
        ("busl", "business source license", ("1.1",)),
        ("sspl", "server side public license", ("1.0",)),
        ("elastic", "elastic license", ("2.0",)),
        ("cecill", "cecill(?: free software)? licen[cs]e", ("1.0", "2.0", "2.1")),
        ("mulan-psl", "mulan psl", ("1.0", "2.0")),
        ("openrail", "(?:creativeml )?open ?rail(?: m)?(?: license)?", ()),
        ("llama", "llama (?:[0-9]+ )*community license", ()),
        ("gemma", "gemma terms of use", ()),
    ):
        keyword = " licen" if "licen" in long else " " + long.split("(?")[0].strip().split(" ")[0]
        keyword = {"openrail": "rail", "mulan-psl": " mulan ", "gemma": " gemma "}.get(label, keyword)
        for v in versions:
            add(f"{label}-{v}", keyword, f"{long} {version(v)}", 90, 1.0)
        add(f"{label}" if not versions else f"{label}-unspecified", keyword, long, 50, 0.8)
    # Single licenses, by name or by a telling sentence.
    for label, keyword, pattern, priority, confidence in (
        ("mit", " mit license ", "(?:the )?mit license", 80, 0.95),
        ("mit", " licen", "licensed? under (?:the )?mit", 85, 0.95),
        ("mit", " permission ", "permission is hereby granted free of charge to any person obtaining a copy", 85, 0.95),
        ("mit-0", " mit no ", "mit no attribution", 90, 1.0),
        ("isc", " isc ", "(?:the )?isc license", 80, 0.95),
        ("isc", " permission ", "permission to use copy modify and or distribute this software", 85, 0.9),
        ("bsd-2-clause", " bsd ", "(?:2 clause|simplified|freebsd) bsd(?: license)?", 90, 1.0),
        ("bsd-3-clause", " bsd ", "(?:3 clause|new|revised|modified) bsd(?: license)?", 90, 1.0),
        ("bsd-4-clause", " bsd ", "(?:4 clause|original) bsd(?: license)?", 90, 1.0),
        ("bsd-2-clause", " bsd ", "bsd 2 clause(?: license)?", 90, 1.0),
        ("bsd-3-clause", " bsd ", "bsd 3 clause(?: license)?", 90, 1.0),
        ("bsd-4-clause", " bsd ", "bsd 4 clause(?: license)?", 90, 1.0),
        ("0bsd", " bsd ", "(?:zero clause bsd|bsd zero clause)(?: license)?", 90, 1.0),
        ("bsd-unspecified", " bsd ", "bsd(?: style)? license", 50, 0.7),
        ("bsd-unspecified", " redistribution ", "redistribution and use in source and binary forms", 70, 0.9),
        ("zlib", " zlib ", "zlib(?: libpng)? license", 80, 0.95),
        ("libpng", " libpng ", "libpng license", 70, 0.95),
        ("unlicense", " unlicense ", "(?:the )?unlicense", 80, 0.95),
        ("unlicense", " unencumbered ", "free and unencumbered software released into the public domain", 85, 0.95),
        ("wtfpl", " wtfpl ", "wtfpl", 80, 0.95),
        ("ruby", " ruby ", "ruby license", 80, 0.9),
        ("vim", " vim ", "vim license", 80, 0.9),
        ("curl", " curl ", "curl license", 80, 0.9),
        ("openssl", " openssl ", "openssl license", 80, 0.9),
        ("ncsa", " ncsa ", "(?:university of illinois )?ncsa open source license", 80, 0.95),
        ("x11", " x11 ", "x11 license", 80, 0.9),
        ("beerware", " beer", "beer ?ware license", 80, 0.9),
        ("json", " json ", "json license", 70, 0.9),
        ("json", " good ", "shall be used for good not evil", 80, 0.95),
        ("hpnd", " permission ", "historical permission notice and disclaimer", 80, 0.95),
        ("public-domain", " public domain ", "(?:dedicated to|released into|in) the public domain", 60, 0.8),
        ("public-domain", " public domain ", "public domain", 30, 0.5),
        ("copyright", " copyright ", "copyright c? ?[12][0-9]{3}", 40, 0.6),
        ("copyright", " copyright ", "copyright (?:the |by )?(?:authors?|owner|holders?)", 35, 0.5),
        ("proprietary", " proprietary ", "proprietary and confidential", 70, 0.8),
        ("proprietary", " permission ", "(?:may not|must not|do not) (?:copy|reproduce|distribute) without (?:prior )?(?:written )?permission", 70, 0.8),
        ("no-warranty", " warrant", "without warrant(?:y|ies)(?: or conditions)? of any kind", 30, 0.4),
        ("no-warranty", " warrant", "as is without (?:any )?warrant(?:y|ies)", 30, 0.4),
        ("spdx", " spdx ", "spdx license identifier", 20, 0.6),
        ("copyleft", " copyleft ", "copyleft", 20, 0.3),
        ("license-text", " licen", "licensed under(?: the)?", 10, 0.3),
        ("license-text", " licen", "see (?:the )?license(?: file)? for details", 15, 0.4),
    ):
        add(label, keyword, pattern, priority, confidence)
    return out


RULE = "struct<label:string,keyword:string,pattern:string,priority:int,confidence:double>"


def _literal(rows) -> Column:
    names = ("label", "keyword", "pattern", "priority", "confidence")
    return F.from_json(F.lit(json.dumps([dict(zip(names, row, strict=True)) for row in rows])), f"array<{RULE}>")


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, SEPARATORS), "")


def gate_words(signatures) -> list[str]:
    """Keywords and base phrases of which every line with a detection holds one; those that hold another are left out."""
    every = {rule[1] for rule in signatures} | {f" {phrase} " for phrase, _ in BASE}
    return sorted(w for w in every if not any(o != w and o in w for o in every))


def fixed_part(pattern: str) -> str:
    """The longest text that every match of a pattern holds, with the blank before or after the match where it stands at its end."""
    cut = re.sub(r"\(\?:[^()]*\)[?*]?|\[[^\]]*\](?:\{\d+\}|[+*?])?|.\?", "\0", f" {pattern} ")
    return max(cut.split("\0"), key=len)


def by_fixed_part(signatures) -> Column:
    """The rules as a literal: array of (part, rules)."""
    grouped: dict[str, list] = {}
    for rule in signatures:
        grouped.setdefault(fixed_part(rule[2]), []).append(dict(zip(("label", "keyword", "pattern", "priority", "confidence"), rule, strict=True)))
    return F.from_json(F.lit(json.dumps([{"part": k, "rules": v} for k, v in grouped.items()])), f"array<struct<part:string,rules:array<{RULE}>>>")


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _let(value: Column, body) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


def _detections(line: Column, rule: Column) -> Column:
    """All places of one rule in the line: array of (start, end, label, priority, confidence), in words, end exclusive."""
    pattern = F.concat(F.lit("(?<= )(?:"), rule["pattern"], F.lit(")(?= )"))
    found = F.regexp_extract_all(line, pattern, F.lit(0))
    between = F.split(line, pattern, -1)
    pairs = F.zip_with(F.slice(between, 1, F.size(found)), found, lambda b, m: F.struct(_spaces(b).alias("skip"), _spaces(m).alias("len")))
    spot = "struct<at:int,out:array<struct<start:bigint,end:bigint>>>"
    walked = F.aggregate(
        pairs, F.struct(F.lit(-1).alias("at"), F.array().alias("out")).cast(spot),
        lambda a, x: F.struct(
            (a["at"] + x["skip"] + x["len"]).alias("at"),
            F.concat(a["out"], F.array(F.struct((a["at"] + x["skip"]).cast("long").alias("start"), (a["at"] + x["skip"] + x["len"] + 1).cast("long").alias("end")))).alias("out"),
        ).cast(spot),
        lambda a: a["out"],
    )
    return F.transform(walked, lambda d: F.struct(d["start"].alias("start"), d["end"].alias("end"), rule["label"].alias("label"), rule["priority"].alias("priority"), rule["confidence"].alias("confidence")))


def scan(docs: DataFrame, signatures=None) -> DataFrame:
    """docs: doc_id, text. Adds n_words, base and found (arrays of detections); other columns stay."""
    signatures = rules() if signatures is None else signatures
    # _let binds a value, so that it is computed once a row.
    gate = lambda line: reduce(or_, [F.contains(line, F.lit(w)) for w in gate_words(signatures)])
    line = F.concat(F.lit(" "), F.array_join(words(F.translate("text", UPPER, LOWER)), " "), F.lit(" "))
    base = _literal([(label, " ", phrase, 1000, 1.0) for phrase, label in BASE])
    own = by_fixed_part(signatures)
    places = lambda line, table: F.flatten(F.transform(table, lambda r: _detections(line, r)))
    rank = lambda d: F.struct(d["priority"], d["end"] - d["start"])
    inside = lambda d, o: (o["start"] <= d["start"]) & (o["end"] >= d["end"]) & (rank(o) > rank(d))
    hits = lambda line: places(line, F.flatten(F.transform(F.filter(own, lambda g: F.contains(line, g["part"])), lambda g: g["rules"])))
    kept = lambda every: F.filter(every, lambda d: ~F.exists(every, lambda o: inside(d, o)))
    detected = _let(line, lambda one: F.when(gate(one), F.struct(places(one, base).alias("base"), _let(hits(one), kept).alias("found"))))
    none = F.array().cast("array<struct<start:bigint,end:bigint,label:string,priority:int,confidence:double>>")
    out = docs.withColumn("n_words", F.size(words(F.coalesce("text", F.lit("")))).cast("long"))
    out = out.withColumn("__d", detected)
    return out.withColumns({c: F.coalesce(F.col("__d")[c], none) for c in ("base", "found")}).drop("__d")


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    d = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    starts, label = F.transform("base", lambda x: x["start"]), lambda c: F.transform(c, lambda x: x["label"])
    joined = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    sure = F.aggregate(F.concat("base", "found"), F.lit(0.0), lambda a, x: F.greatest(a, x["confidence"]))
    return d.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        joined(label("base")).alias("base_labels"), joined(F.concat(label("base"), label("found"))).alias("labels"), sure.alias("score"),
    )
