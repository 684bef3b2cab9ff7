"""Ordered work along keys of any size: rows are dealt in ranges of their order, and each range is told what the ranges before it leave.

A chromosome may fill many ranges, and a range may hold many chromosomes. Sums, maxima and neighbours
need one row for each range and key. A greedy chain, whose state depends on where it began, needs a
range's state at its end as a function of the state at its start: each range follows the few chains
that may enter it, and the functions are composed range by range.
"""

from __future__ import annotations

import bisect

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from .shared import materialize


def deal(rows: DataFrame, *order) -> DataFrame:
    """``rows``, written, with ``__range``: the number of their range in an order, keys first."""
    return materialize(rows.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()))


def _carried(dealt: DataFrame, by: tuple, value: Column, how) -> DataFrame:
    """(``by``, __range, __carried): ``how`` of a value over the ranges before, for each key."""
    each = dealt.groupBy("__range", *by).agg(how(value).alias("__value"))
    before = Window.partitionBy(*by).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    return each.select("__range", *by, how("__value").over(before).alias("__carried"))


def _joined(dealt: DataFrame, small: DataFrame, by: tuple) -> DataFrame:
    """A left join by range and keys, which may be null."""
    named = small.select(F.col("__range").alias("__r"), *[F.col(c).alias(f"__k{i}") for i, c in enumerate(by)], *[c for c in small.columns if c not in ("__range", *by)])
    on = F.col("__range") == F.col("__r")
    for i, c in enumerate(by):
        on = on & F.col(c).eqNullSafe(F.col(f"__k{i}"))
    return dealt.join(named, on, "left").drop("__r", *[f"__k{i}" for i in range(len(by))])


def running(dealt: DataFrame, by: tuple, order: tuple, name: str, value: Column, how=F.sum, itself: bool = True) -> DataFrame:
    """``name``: ``how`` (F.sum or F.max) of a value over a key's rows up to each row, or only before it, null where there is none.

    ``dealt`` comes from ``deal`` by ``by``, then ``order``.
    """
    own = Window.partitionBy("__range", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0 if itself else -1)
    known = _joined(dealt.withColumn("__own", how(value).over(own)), _carried(dealt, by, value, how), by)
    both = F.greatest("__own", "__carried") if how is F.max else F.when(F.col("__own").isNotNull() | F.col("__carried").isNotNull(), F.coalesce("__own", F.lit(0)) + F.coalesce("__carried", F.lit(0)))
    return known.withColumn(name, both).drop("__own", "__carried")


def following(dealt: DataFrame, by: tuple, order: tuple, name: str, value: Column) -> DataFrame:
    """``name``: a value of the next row of the key, null after the last one."""
    own = Window.partitionBy("__range", *by).orderBy(*order)
    heads = dealt.groupBy("__range", *by).agg(F.min_by(F.struct(value.alias("v")), F.struct(*order)).alias("__head"))
    next_ = heads.select("__range", *by, F.lead("__head").over(Window.partitionBy(*by).orderBy("__range")).alias("__far"))
    known = _joined(dealt.withColumn("__near", F.lead(F.struct(value.alias("v"))).over(own)), next_, by)
    return known.withColumn(name, F.coalesce("__near", "__far")["v"]).drop("__near", "__far")


class _Chains:
    """The greedy chains that may enter a range within its first key.

    A chain's state is where its last group started. Chains that reach the same state go on as one.
    """

    def __init__(self, most: int):
        self.most, self.first, self.reach = most, None, None
        self.lows, self.members = [], []  # of each entry: the largest end before it; (chain, groups started before it joined)
        self.chains: list[list] = []  # (start of the last group, groups started)

    def add(self, start: int, end: int) -> None:
        moved: dict = {}
        for chain in self.chains:
            if chain and end - chain[0] > self.most:
                chain[0], chain[1] = start, chain[1] + 1
                moved[start] = [*moved.get(start, []), chain]
        # An entry: a chain from outside, whose last group started before all of these, may start a group here first.
        if self.first is None or (end > self.reach and self.reach <= self.first + self.most):
            self.lows.append(self.reach)
            fresh = [start, 1]
            self.members.append((fresh, 0))
            moved[start] = [*moved.get(start, []), fresh]
            self.chains.append(fresh)
        if self.first is None:
            self.first, self.reach = start, end
        self.reach = max(self.reach, end)
        for same in moved.values():
            if len(same) > 1:
                kept, gone = same[0], same[1:]
                for other in gone:
                    for i, (chain, base) in enumerate(self.members):
                        if chain is other:
                            self.members[i] = (kept, base + other[1] - kept[1])
                dropped = {id(c) for c in gone}
                self.chains = [c for c in self.chains if id(c) not in dropped]

    def ends(self) -> tuple[list, list, list]:
        """(largest end before, last group's start, groups started) of each entry."""
        return self.lows, [c[0] for c, _ in self.members], [c[1] + base for c, base in self.members]


def _functions(most: int):
    """Of rows (__range, key, start, end) in order: for each range, its first and last key and how it maps the state."""
    schema = pa.schema(
        [("range", pa.int64()), ("first", pa.string()), ("last", pa.string()), ("lows", pa.list_(pa.int64())), ("reach", pa.int64()), ("exits", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())), ("exit", pa.int64()), ("count", pa.int64())]
    )

    def run(batches):
        at = key = first = chains = lone = None
        begun = False

        def row():
            lows, exits, counts = chains.ends()
            return (at, first, key, lows, chains.reach, exits, counts, *(lone or (None, 0)))

        out = []
        for batch in batches:
            for range_, name, start, end in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if not begun or range_ != at:
                    if begun:
                        out.append(row())
                    at, first, key, chains, lone, begun = range_, name, name, _Chains(most), None, True
                elif name != key:
                    key, lone = name, (None, 0)
                if start is None or end is None:
                    continue
                if lone is None:
                    chains.add(start, end)
                elif lone[0] is None or end - lone[0] > most:
                    lone = (start, lone[1] + 1)
        if begun:
            out.append(row())
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out) if out else [[]] * len(schema), schema)], schema=schema)

    return run


def _composed(most: int):
    """Of the ranges' functions in order: (__range, key, at, n), the state that each range's first key begins with."""

    def run(batches):
        key = at = None
        n = 0
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if key is None or r["first"] != key[0]:
                    at, n = None, 0
                out.append((r["range"], r["first"], at, n))
                lows = r["lows"]
                if lows:
                    if at is None:
                        entry = 0
                    else:  # the entry whose end is the first one beyond reach
                        entry = bisect.bisect_right(lows, at + most, lo=1) - 1
                    if at is None or r["reach"] - at > most:
                        at, n = r["exits"][entry], n + r["counts"][entry]
                if r["last"] != r["first"]:
                    at, n = r["exit"], r["count"]
                key = (r["last"],)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.string(), pa.int64(), pa.int64()))], names=["__range", "__first", "__at", "__n"])

    return run


def greedy_groups(rows: DataFrame, by: tuple, order: tuple, start: Column, end: Column, most: int, starts: str = "__starts", group: str = "__group") -> DataFrame:
    """``starts`` and ``group``: a row starts a group if it ends more than ``most`` after the start of the group before, and the first row of a key does.

    Rows go by ``order``, which must name columns that order them wholly, beginning with the start.
    Groups are numbered from 1 for each key. Rows whose start or end is null start nothing and are of
    the group before, 0 if there is none. Rows are read twice in ranges; what one task composes is a
    row for each range, with the few chains that may enter it. The result has ``__range`` as ``deal``.
    """
    key = F.concat_ws("\x00", *[F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in by])
    dealt = deal(rows.withColumns({"__key": key, "__start": start.cast("long"), "__end": end.cast("long")}), "__key", *order)
    ranged = lambda df: df.repartition("__range").sortWithinPartitions("__range", "__key", *order)
    functions = ranged(dealt.select("__range", "__key", "__start", "__end", *[c for c in order if c not in ("__start", "__end")])).select(F.col("__range").cast("long").alias("__range"), "__key", "__start", "__end")
    maps = materialize(functions.mapInArrow(_functions(most), "range long, first string, last string, lows array<long>, reach long, exits array<long>, counts array<long>, exit long, count long"))
    states = maps.repartition(1).sortWithinPartitions("range").mapInArrow(_composed(most), "__range long, __first string, __at long, __n long")
    # One row for each range.
    placed = dealt.join(F.broadcast(states.withColumn("__range", F.col("__range").cast("int"))), "__range", "left")
    names = ["__range", "__key", "__start", "__end", "__first", "__at", "__n"]

    def run(batches):
        key, at, n = None, None, 0
        for batch in batches:
            firsts, groups = [], []
            for range_, name, a, b, first, held, count in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in names)):
                if (range_, name) != key:
                    key, (at, n) = (range_, name), (held, count) if name == first else (None, 0)
                begins = a is not None and b is not None and (at is None or b - at > most)
                if begins:
                    at, n = a, n + 1
                firsts.append(begins)
                groups.append(n)
            kept = [batch.column(batch.schema.get_field_index(c)) for c in kept_names]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(firsts, pa.bool_()), pa.array(groups, pa.int64())], names=[*kept_names, starts, group])

    kept_names = [*rows.columns, "__range"]
    schema = StructType([*[placed.schema[c] for c in kept_names], StructField(starts, BooleanType()), StructField(group, LongType())])
    return ranged(placed).mapInArrow(run, schema)
