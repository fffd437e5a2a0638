r"""URL rules by a sort-merge range join (DataFrame functions only).

A rule names a host and the start of a path; it fits that host and its subdomains where the url's path starts so. Hosts become canonical
keys with their labels reversed, each closed by a dot (``www.example.org`` is ``org.example.www.``), so that a rule's host is a prefix of
the keys of its subdomains: an interval of the sorted keys. Rules and rows are sorted together and dealt by ranges; the sweep carries the
last rule that opened with the stack of rules around it (``scanned``: no task needs a whole host), and the rules of that stack
that begin a row's key are the ones that hold it. Two sweeps: hosts first, which gives each url the rule hosts above it, then
key and path for each of these; the second sweep's innermost rule is the longest path under one host, and of these the longest rule
wins. A rule's stack has at most as many entries as its key has characters.

Base rules decide first. Where none fits, the method's own do: rules of ``own`` in the same sweeps, then the words in the host's labels
(``WORDS``): block where one is there, else allow.

Null url, or one without ``://``: host and path are empty, no rule fits, the verdict is allow. Urls of any length are read whole. Repeated rows and
ids stay as they are. Of rules with equal host and path, block wins. Empty table: no rows; no rules: all by words. Columns of any other name stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tamis.llm.common import table, written
from tamis.operators.scan import scanned

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# The base rules, then the method's own: verdict, host/path.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
OWN_RULES = (
    ("block", "doubleclick.net/"), ("block", "googlesyndication.com/"), ("block", "googleadservices.com/"), ("block", "adnxs.com/"), ("block", "taboola.com/"), ("block", "outbrain.com/"),
    ("block", "bit.ly/"), ("block", "t.co/"), ("block", "tinyurl.com/"), ("block", "goo.gl/"), ("block", "xxx/"), ("block", "porn/"), ("block", "adult/"), ("block", "sex/"), ("block", "casino/"), ("block", "bet/"),
    ("allow", "edu/"), ("allow", "gov/"), ("block", "facebook.com/sharer"), ("block", "twitter.com/intent"), ("block", "pinterest.com/pin/create"),
)
# Words of a host's labels that tell spam and adult sites.
WORDS = (
    "adult", "bet", "betting", "bingo", "casino", "cheap", "cialis", "cracked", "escort", "farm", "gambling", "hentai", "jackpot", "keygen", "lottery", "milf", "nude", "payday",
    "pharmacy", "pills", "poker", "porn", "replica", "sex", "slots", "spam", "tramadol", "viagra", "warez", "webcam", "xxx",
)


def host_of(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z lower-cased; empty without ://."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    return F.translate(F.coalesce(F.regexp_extract(rest, r"^[^/?#]*", 0), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ? # or the end; empty without ://."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    """Labels reversed, each closed by a dot."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def rule_table(spark: SparkSession, rules: tuple[tuple[str, str], ...], tier: int = 0) -> DataFrame:
    """Rules as tier, verdict, rule (host and path), host, path. A rule must have a host."""
    for verdict, rule in rules:
        if verdict not in ("allow", "block") or not rule.partition("/")[0]:
            raise ValueError(f"a rule is allow or block with a host: {verdict} {rule}")
    rows = spark.createDataFrame([(tier, verdict, rule) for verdict, rule in rules], "tier int, verdict string, rule string")
    host = F.translate(F.substring_index("rule", "/", 1), UPPER, LOWER)
    return rows.select("tier", "verdict", "rule", host.alias("host"), F.substring(F.col("rule"), F.length(host) + 1, F.length("rule")).alias("path"))


def stacks(rules: DataFrame) -> DataFrame:
    """rules: key and columns of a rule. One row a key: the rules whose keys begin this one, the shortest first, as structs of all columns.

    Each key asks for all its prefixes, so the join is on equality; a key has as many as it has characters.
    """
    one = rules.select("key", F.struct("*").alias("rule"))
    asked = one.select(F.col("key").alias("of"), F.explode(F.sequence(F.lit(1), F.length("key"))).alias("n")).select("of", F.col("of").substr(F.lit(1), F.col("n")).alias("key"))
    return asked.join(one, "key").groupBy("of").agg(F.array_sort(F.collect_list(F.struct(F.length("key").alias("size"), "rule"))).alias("s")).select(F.col("of").alias("key"), F.transform("s", lambda x: x["rule"]).alias("stack"))


def swept(rows: DataFrame, rules: DataFrame, key: str, tie: list[str]) -> DataFrame:
    """rows with holding: the rules whose keys begin the row's key, the shortest first. rules: key (unique) and others; tie tells rows of one key apart.

    Rules and rows in one order of keys, a rule before the rows of its key. The last rule that opened stands for the whole
    stack there: those of its stack that don't hold the row are closed.
    """
    packed = rows.select(F.col(key).alias("key"), F.lit(1).alias("kind"), *[F.col(c).alias(f"tie{i}") for i, c in enumerate(tie)], F.struct("*").alias("row"))
    opened = stacks(rules)
    opens = opened.select("key", F.lit(0).alias("kind"), *[F.lit(None).cast(rows.schema[c].dataType).alias(f"tie{i}") for i, c in enumerate(tie)], "stack")
    both = packed.unionByName(opens, allowMissingColumns=True)
    run = scanned(both, [], ["key", "kind", *[f"tie{i}" for i in range(len(tie))]], lasts={"open": F.col("stack")}).where("kind = 1")
    holding = F.filter(F.coalesce("open", F.array().cast(opened.schema["stack"].dataType)), lambda r: F.startswith(F.col("key"), r["key"]))
    return run.select(*[F.col("row").getField(c).alias(c) for c in rows.columns], holding.alias("holding"))


def judged(pages: DataFrame, rules: DataFrame, url: str = "url", words: tuple[str, ...] = WORDS) -> DataFrame:
    """pages with host, path, rule (a base rule's text, else null), own_rule (of a later tier), verdict.

    rules: what rule_table gives, any number of rows. The least tier that fits decides, in it the longest rule, then the longest host.
    """
    rows = written(pages.select(F.struct("*").alias("page"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"), F.monotonically_increasing_id().alias("at")), "urls")
    # Equal host and path: the least tier, block before allow.
    keyed = rules.withColumn("host_key", host_key(F.col("host"))).groupBy("host_key", "path").agg(F.min(F.struct("tier", (F.col("verdict") == "allow").alias("late"), "rule", "verdict")).alias("r"))
    keyed = written(keyed.select(F.concat("host_key", "path").alias("key"), "host_key", "r.tier", "r.verdict", "r.rule"), "url-rules")

    urls = rows.where("host <> ''").select("at", "path", host_key(F.col("host")).alias("key"))
    hosts = swept(urls, keyed.select(F.col("host_key").alias("key")).distinct(), "key", ["at"])
    asked = hosts.select("at", F.explode("holding").alias("h"), "path").select("at", F.concat("h.key", "path").alias("key"), F.col("h.key").alias("host_key"))
    held = swept(asked, keyed, "key", ["at"])
    # Of one tier the innermost rule is the longest here.
    fits = held.select("at", F.explode("holding").alias("r"))
    order = F.struct((-F.col("r.tier")).alias("tier"), F.length("r.rule").alias("size"), F.length("r.host_key").alias("host"), F.col("r.rule").alias("rule"), F.col("r.verdict").alias("verdict"))
    best = fits.groupBy("at").agg(F.max(order).alias("best")).withColumnRenamed("at", "of")
    listed = F.array_intersect(F.split("host", r"[.\-_]"), F.array(*map(F.lit, words)).cast("array<string>"))
    by_words = F.when(F.size(listed) > 0, "block").otherwise("allow")
    out = rows.join(best, F.col("at") == F.col("of"), "left")
    names = ("host", "path", "rule", "own_rule", "verdict")
    return out.select(
        *[F.col("page").getField(c).alias(c) for c in pages.columns if c not in names], "host", "path", F.when(F.col("best.tier") == 0, F.col("best.rule")).alias("rule"),
        F.when(F.col("best.tier") < 0, F.col("best.rule")).alias("own_rule"), F.coalesce("best.verdict", by_words).alias("verdict"),
    )


def op13_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page: page_id, host, path, rule, verdict (and own_rule)."""
    rules = rule_table(spark, RULES).unionByName(rule_table(spark, OWN_RULES, 1))
    return judged(table(spark, sf_dir, "pages").select("page_id", "url"), rules).select("page_id", "host", "path", "rule", "verdict", "own_rule")
