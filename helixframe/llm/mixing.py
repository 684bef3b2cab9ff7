"""Mixing sources to target weights.

Every document gets a hash-random key. Keys are dealt in ranges of their first three hexadecimal
digits within each source, so a source with a third of all rows fills thousands of ranges. Sums by
range, prefix sums over ranges and running sums within a range give each document the exact number
of words before it in its source's random order; the order is cut where the source's budget ends.
A budget above the source's size repeats the whole order before.

Targets: each source's share of all words by weight, but at most ``max_epochs`` times its size; what
is above is shared again by weight among the others until none is above.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, unused, word_count

#: Hexadecimal digits of the key that number a range within a source.
RANGE_DIGITS = 3


def source_targets(sizes: DataFrame, weights: tuple = (1, 2, 3), max_epochs: int = 3) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row for each source.

    The n-th source by code point, null last, has weight ``weights[(n - 1) % len(weights)]``. If no
    source has words, all targets are 0. The windows here run over one row for each source.
    """
    ranked = sizes.withColumn("n", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weighed = ranked.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("n") % len(weights) + 1).cast("int")))
    weighed = weighed.withColumn("cap", F.col("source_size").cast("double") * max_epochs)
    # Sources in order of cap / weight: the first ones are at their caps, the others share the rest by weight.
    order = Window.orderBy(F.col("cap") / F.col("weight"), "n")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    every = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    levels = weighed.withColumn("level", level).withColumn("free", F.col("level") <= F.col("cap") / F.col("weight"))
    first = F.first(F.when(F.col("free"), F.col("level")), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    target = F.when(first.isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), F.col("weight") * first))
    return levels.select("source", F.col("source_size").cast("long"), target.alias("target"))


def random_key(doc: Column, seed: str) -> Column:
    """A key that is random over documents and the same in every run."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc.cast("string"), F.lit("null"))))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple = (1, 2, 3), max_epochs: int = 3, seed: str = "mix") -> DataFrame:
    """What a mix takes of each document: (doc, source, text_key, size, source_size, target, taken, copies).

    ``taken`` counts words, repeats included, and sums to each source's target rounded to a whole
    word: every document is taken whole ``target div source_size`` times, then documents follow in
    random order until the budget ends, the last one in part. ``copies`` is the same cut at whole
    documents: the document at the end of the budget counts if at least half of it is taken.
    No document is taken more than ``max_epochs`` times.

    Null texts have size 0; null sources are one source; rows with equal or null ids are documents
    like others, ties in the random order being broken by id, size and text. An empty table gives
    an empty table. Other columns are ignored.
    """
    row = docs.select(F.col(id_col).alias("doc"), F.col(source_col).alias("source"), F.xxhash64(text_col).alias("text_key"), word_count(F.col(text_col)).alias("size"))
    sized = materialize(row.withColumn("key", random_key(F.col("doc"), seed)))
    place = [F.col("source").isNull().alias("no_source"), F.coalesce("source", F.lit("")).alias("name"), F.substring("key", 1, RANGE_DIGITS).alias("range")]
    by_range = sized.groupBy(*place).agg(F.sum("size").alias("range_size"))
    sums = by_range.withColumn("offset", F.coalesce(F.sum("range_size").over(Window.partitionBy("no_source", "name").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    sizes = by_range.groupBy("no_source", "name").agg(F.sum("range_size").alias("source_size"))
    source = F.when(~F.col("no_source"), F.col("name")).alias("source")
    targets = source_targets(sizes.select(source, "source_size"), weights, max_epochs)
    targets = targets.select(F.col("source").isNull().alias("no_source"), F.coalesce("source", F.lit("")).alias("name"), "source_size", "target")
    known = sums.join(targets, ["no_source", "name"]).drop("range_size")
    keys = ["no_source", "name", "range"]
    dealt = sized.select("*", *place).join(known, keys)
    until = F.col("offset") + F.sum("size").over(Window.partitionBy(*keys).orderBy("key", "doc", "size", "text_key").rowsBetween(Window.unboundedPreceding, 0))
    budget = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.expr("cast(round(target) as bigint) div source_size")).otherwise(F.lit(0))
    cut = dealt.withColumn("until", until).withColumn("epochs", epochs)
    rest = budget - F.col("epochs") * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - (F.col("until") - F.col("size"))))
    cut = cut.withColumn("part", part)
    whole = (F.col("size") > 0) & (F.col("part") * 2 >= F.col("size"))
    return cut.select(
        "doc", "source", "text_key", "size", "source_size", "target",
        (F.col("epochs") * F.col("size") + F.col("part")).alias("taken"),
        (F.when(F.col("size") > 0, F.col("epochs")).otherwise(F.lit(0)) + whole.cast("long")).cast("int").alias("copies"),
    )


def mix_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """``docs`` with each row as often as the mix takes it, in whole documents.

    Each source's words are within one document of its target. Rows with size 0 are not taken.
    """
    taken = mix_sources(docs, id_col, text_col, source_col, **options)
    # One row for each distinct (id, text, source): equal rows are taken together.
    doc, key, source, copies, rows, rank, copy = unused(docs, "doc", "key", "source", "copies", "rows", "rank", "copy")
    own = [F.col("doc").alias(doc), F.col("text_key").alias(key), F.col("source").alias(source)]
    times = taken.groupBy(*own).agg(F.sum("copies").alias(copies), F.count("*").alias(rows)).where(F.col(copies) > 0)
    on = docs[id_col].eqNullSafe(times[doc]) & (F.xxhash64(docs[text_col]) == times[key]) & docs[source_col].eqNullSafe(times[source])
    place = F.row_number().over(Window.partitionBy(doc, key, source).orderBy(F.lit(0)))
    share = F.expr(f"cast({copies} div {rows} + if({rank} <= {copies} % {rows}, 1, 0) as int)")
    joined = docs.join(times, on).withColumn(rank, place)
    return joined.withColumn(copy, F.explode(F.array_repeat(F.lit(1), share))).select(*docs.columns)
