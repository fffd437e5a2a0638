"""Mixing sources to target weights by Pareto order sampling (DataFrame functions only).

Every source gets a target in words: its weight's share of ``share`` times all
words, at most ``most`` times its own words, with the excess shared again by
weight among the others. A document's expected copies are its importance times a factor of its source, at most
``most``, such that the source's expected words are its target. By default the importance is the share of distinct words
among a text's words, so that repetitive texts come less often. The whole part is certain; for the rest
documents are ranked by ``(u / (1 - u)) / (p / (1 - p))``, random odds over
inclusion odds, and the lowest ranks are taken until the source's remaining words
are filled. Where a long text doesn't fit, later ranks that do are tried, ``PASSES`` times; the last time the row that crosses the
target is taken if that comes nearer to it. A third of all rows may belong to one source, so ranks are first cut
into narrow bins summed with map-side partial sums, and only the bin in which a source's
target is met is ranked row by row.

Nulls: a null text has size 0; null source is a source of its own, ordered last;
null ids hash as such. Texts of any length count all their words. Empty table: no rows. Equal rows draw equal numbers and get
equally many copies. Columns other than those named are ignored by ``mix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tamis.llm.common import WORD, table, written

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
BINS = 65_536
PASSES = 3
GRID = 8  # steps of importance in a factor of two
SEED = 20_240


def words_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """sizes: source, source_size (one row a source). Adds rank, weight and target.

    Sharing the excess again and again ends where every source has min(cap, level * weight)
    words; that level is read off prefix sums in the order of cap / weight.
    """
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("rank", F.row_number().over(by_name) - 1)
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("weight", pick).withColumn("cap", F.lit(float(most)) * F.col("source_size"))
    everything = W.partitionBy()
    by_ratio = W.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = by_ratio.rowsBetween(W.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(0, W.unboundedFollowing)
    levels = (
        ranked.withColumn("goal", F.lit(float(share)) * F.sum("source_size").over(everything))
        .withColumn("full", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("open", F.sum("weight").over(after))
        .withColumn("level", (F.col("goal") - F.col("full")) / F.col("open"))
    )
    fits = F.col("level") * F.col("weight") <= F.col("cap")
    level = F.min(F.when(fits, F.struct(F.col("cap") / F.col("weight"), "rank", "level"))).over(everything)["level"]
    return levels.withColumn("found", level).select(
        "source", "source_size", "rank", "weight", F.least("cap", F.coalesce(F.col("found") * F.col("weight"), F.col("cap"))).alias("target")
    )


def diversity(text: Column) -> Column:
    """Distinct words over words; 1 without words."""
    found = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    return F.when(F.size(found) > 0, F.size(F.array_distinct(found)) / F.size(found)).otherwise(1.0)


def draws(seed: int) -> Column:
    """A number between 0 and 1 from the seed, id, source and text of a row."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("null"))
    hexed = F.md5(F.concat_ws(":", F.lit(str(seed)), part("doc_id"), part("source"), F.coalesce(F.md5("text"), F.lit("null"))))
    return (F.conv(F.substring(hexed, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def factors(rows: DataFrame, goal: DataFrame, most: float) -> DataFrame:
    """s, source_size, target, factor: expected copies are least(most, factor * importance).

    Above some importance of its source a document has ``most`` copies; which, is read off sums over the grid of importances.
    """
    grid = rows.groupBy("source", "grid").agg(F.sum("size").alias("words"), F.first("imp").alias("imp"))
    grid = grid.join(goal, F.col("source").eqNullSafe(F.col("s"))).drop("source")
    falling = W.partitionBy("s").orderBy(F.desc("grid"))
    full = F.coalesce(F.sum("words").over(falling.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    moved = F.sum(F.col("words") * F.col("imp")).over(falling.rowsBetween(0, W.unboundedFollowing))
    factor = F.when(moved > 0, (F.col("target") - most * full) / moved).otherwise(0.0)
    tried = grid.withColumn("factor", factor)
    fits = F.col("factor") * F.col("imp") <= most * (1 + 1e-9)
    return tried.groupBy("s", "source_size", "target").agg(F.max_by("factor", F.when(fits, F.col("grid"))).alias("factor"))


def order_of() -> Column:
    return F.struct("r", "id", "key")


def cut(placed: DataFrame, state: DataFrame, last: bool) -> DataFrame:
    """state: s, room. Adds limit (rows up to this size are tried) and upto (the order of the last one taken); room is what then stays open.

    placed holds the rows that aren't taken yet, with s.
    """
    limit = F.col("room") * (2 if last else 1)
    tried = placed.join(state.select(F.col("s").alias("t"), "room"), F.col("s").eqNullSafe(F.col("t"))).where((F.col("rest") > 0) & (F.col("size") <= limit))
    # One narrow row per source and bin; the bin in which the room is filled.
    sums = tried.groupBy("s", "bin").agg(F.sum("size").alias("words"), F.first("room").alias("room"), F.max(order_of()).alias("last"))
    along = W.partitionBy("s").orderBy("bin").rowsBetween(W.unboundedPreceding, W.currentRow)
    sums = sums.withColumn("upto", F.sum("words").over(along))
    met = F.col("upto") > F.col("room")
    edge = sums.groupBy("s").agg(
        F.max(F.when(~met, F.struct("upto", "bin", "last"))).alias("full"), F.min(F.when(met, F.struct("bin", (F.col("room") - (F.col("upto") - F.col("words"))).alias("left")))).alias("edge")
    )
    edge = written(edge.select(F.col("s").alias("t"), F.col("full.last").alias("full_last"), F.coalesce("full.upto", F.lit(0)).alias("full_words"), F.col("edge.bin").alias("edge_bin"), F.col("edge.left").alias("left")), "mix-edges")
    running = W.partitionBy("s").orderBy("r", "id", "key")  # a range frame: equal rows share one fate
    at_edge = tried.drop("t").join(edge, F.col("s").eqNullSafe(F.col("t")) & (F.col("bin") == F.col("edge_bin")))
    at_edge = at_edge.withColumn("run", F.sum("size").over(running))
    fits = F.col("run") - F.col("size") / 2 <= F.col("left") if last else F.col("run") <= F.col("left")
    more = at_edge.where(fits).groupBy("s").agg(F.max(order_of()).alias("more"), F.max("run").alias("more_words")).withColumnRenamed("s", "m")
    out = state.join(edge, F.col("s").eqNullSafe(F.col("t")), "left").join(more, F.col("s").eqNullSafe(F.col("m")), "left")
    taken = F.coalesce("full_words", F.lit(0)) + F.coalesce("more_words", F.lit(0))
    return out.select(*[c for c in state.columns if c != "room"], (F.col("room") - taken).alias("room"), limit.alias("limit"), F.coalesce("more", "full_last").alias("upto"))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST, importance: Column | None = None, seed: int = SEED) -> DataFrame:
    """docs: doc_id, text, source. Returns doc_id, source, key, size, source_size, target, copies, taken.

    ``importance`` is a positive number per row, taken to the nearest eighth of a power of two.
    ``key`` is the hash of the row's text, so that copies of an id with other texts are told apart.
    """
    importance = diversity(F.col("text")) if importance is None else importance.cast("double")
    rows = docs.select("doc_id", "source", F.xxhash64("text").alias("key"), words_of(F.col("text")).alias("size"), F.round(F.log2(importance) * GRID).cast("int").alias("grid"), draws(seed).alias("u"))
    rows = written(rows.withColumn("imp", F.pow(F.lit(2.0), F.col("grid") / GRID)), "mix-rows")
    goal = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most).withColumnRenamed("source", "s")
    goal = written(factors(rows, written(goal.select("s", "source_size", "target"), "mix-goals"), most), "mix-targets")

    expected = F.round(F.least(F.lit(float(most)), F.col("factor") * F.col("imp")), 9)
    placed = rows.join(goal, F.col("source").eqNullSafe(F.col("s"))).withColumn("expected", expected)
    placed = placed.withColumn("sure", F.floor("expected")).withColumn("rest", F.col("expected") - F.col("sure"))
    odds = (F.col("u") / (1 - F.col("u"))) * ((1 - F.col("rest")) / F.col("rest"))
    placed = placed.withColumn("odds", F.when(F.col("rest") > 0, odds)).withColumn("r", F.col("odds") / (1 + F.col("odds")))
    placed = placed.withColumns({"bin": F.floor(F.col("r") * BINS).cast("int"), "id": F.coalesce("doc_id", F.lit(-1 << 63))})

    certain = placed.groupBy("s").agg((F.first("target") - F.sum(F.col("size") * F.col("sure"))).alias("room"))
    state, extra = written(certain, "mix-rooms"), F.lit(False)
    open_rows = placed.select("s", "r", "id", "key", "size", "rest", "bin")
    for k in range(PASSES):
        tried = open_rows
        if k:
            cuts = state.select(F.col("s").alias("c"), *[f"{name}_{i}" for i in range(k) for name in ("limit", "upto")])
            tried = open_rows.join(cuts, F.col("s").eqNullSafe(F.col("c"))).where(~extra).select(*open_rows.columns)
        state = written(cut(tried, state, k == PASSES - 1).withColumnsRenamed({"limit": f"limit_{k}", "upto": f"upto_{k}"}), "mix-cuts")
        extra = extra | F.coalesce((F.col("size") <= F.col(f"limit_{k}")) & (order_of() <= F.col(f"upto_{k}")), F.lit(False))
    cuts = state.withColumnRenamed("s", "c").drop("room")
    copies = (F.col("sure") + ((F.col("rest") > 0) & extra).cast("int")).cast("long")
    done = placed.join(cuts, F.col("s").eqNullSafe(F.col("c")))
    return done.select("doc_id", "source", "key", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed: doc_id, size, source_size, target, taken (and source, copies)."""
    out = mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return out.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def repeated(docs: DataFrame) -> DataFrame:
    """docs as often as the mix takes them: rows with no copy go, rows with two stand twice; same columns."""
    taken = mix(docs.select("doc_id", "text", "source")).filter("copies > 0")
    taken = taken.groupBy("doc_id", "source", "key").agg(F.max("copies").alias("copies"))
    d = docs.select(F.struct("*").alias("row"), F.xxhash64("text").alias("h"))  # whatever the columns' names
    same = d["row.doc_id"].eqNullSafe(taken["doc_id"]) & d["row.source"].eqNullSafe(taken["source"]) & (d["h"] == taken["key"])
    return d.join(taken, same).select("row", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))).select("row.*")
