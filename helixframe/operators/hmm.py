"""Distance-aware hidden Markov model over the regions of a chromosome."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.functions.model import DISTANCE, DISTANCE_SCALE, STATES, mixing, prior, transitions


def viterbi(costs: np.ndarray, distances: np.ndarray, states: tuple = STATES) -> tuple[np.ndarray, float]:
    """The cheapest path of states and its cost, for negative log likelihoods (regions x states).

    ``distances`` are from the region before; the first is infinite, so only the prior holds there.
    Ties go to the first state.
    """
    n, k = costs.shape
    m, p = transitions(states), prior(states)
    total = -np.log(p) + costs[0]
    back = np.zeros((n, k), np.int64)
    for i in range(1, n):
        t = mixing(distances[i])
        step = total[:, None] - np.log(t * m + (1 - t) * p[None])
        back[i] = step.argmin(0)
        total = step[back[i], np.arange(k)] + costs[i]
    path = np.empty(n, np.int64)
    path[-1] = total.argmin()
    for i in range(n - 1, 0, -1):
        path[i - 1] = back[i, path[i]]
    return path, float(total.min())


#: Regions of whole chromosomes that are decoded together.
BATCH_REGIONS = 1 << 16


class Steps:
    """Chromosomes stepped together, region by region: states x states of all of them at once.

    ``costs`` are of all regions in a row, ``t`` how much of the transitions holds before each, and
    ``first`` where each chromosome's part begins. ``totals`` are the states' cheapest costs so far of
    those that go on from an earlier part, None for those that begin; the last ones are left in it.
    """

    def __init__(self, costs: np.ndarray, t: np.ndarray, first: np.ndarray, totals: list, states: tuple = STATES):
        self.costs, self.t, self.first, self.m, self.p = costs, t, first, transitions(states), prior(states)
        self.length = np.diff(np.append(first, len(costs)))
        self.order = np.argsort(-self.length, kind="stable")  # longest first, so those that go on are the first ones
        self.total = np.stack([np.full(len(self.p), np.nan) if x is None else x for x in totals]) if totals else np.empty((0, len(self.p)))
        self.begins = np.array([x is None for x in totals], bool)

    def _steps(self):
        """(chromosomes that have an i-th region, those regions) for each i."""
        lengths = -self.length[self.order]
        for i in range(int(self.length.max(initial=0))):
            on = self.order[: np.searchsorted(lengths, -i)]
            yield i, on, self.first[on] + i

    def forward(self, pointers: bool) -> np.ndarray | None:
        """Fill ``total``; the state before each region's states, if wanted."""
        back = np.zeros(self.costs.shape, np.int8) if pointers else None
        for i, on, at in self._steps():
            t = self.t[at][:, None, None]
            step = self.total[on][:, :, None] - np.log(t * self.m + (1 - t) * self.p)
            came = step.argmin(1)
            best = np.take_along_axis(step, came[:, None], 1)[:, 0]
            if i == 0:
                best = np.where(self.begins[on][:, None], -np.log(self.p), best)
            self.total[on] = best + self.costs[at]
            if pointers:
                back[at] = came
        return back

    def paths(self) -> np.ndarray:
        """The cheapest states of all regions."""
        back, path = self.forward(True), np.empty(len(self.costs), np.int64)
        path[self.first + self.length - 1] = self.total.argmin(1)
        for i, on, at in reversed(list(self._steps())):
            if i:
                path[at - 1] = back[at, path[at]]
        return path


def _mixed(gap: np.ndarray) -> np.ndarray:
    return 1 - 1 / (1 + np.exp(-(np.minimum(gap, 1e9) - DISTANCE) / DISTANCE_SCALE))


def _costs(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(regions x states, whether a region has all of its costs)."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    whole = np.array(pc.equal(pc.fill_null(pc.list_value_length(column), -1), k), bool)
    costs = np.full((len(column), k), np.nan)
    if whole.any():
        costs[whole] = column.filter(pa.array(whole)).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, k)
    return costs, ~np.isnan(costs).any(1)


def _named(batch) -> tuple[list, np.ndarray, np.ndarray, np.ndarray]:
    """((sample, chr) of each chromosome in a batch, where it begins, starts, ends)."""
    sample, chromosome = batch.column("sample").to_pylist(), batch.column("chr").to_pylist()
    keys = list(zip(sample, chromosome))
    first = [i for i in range(len(keys)) if i == 0 or keys[i] != keys[i - 1]]
    start, end = (batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in ("start", "end"))
    return [keys[i] for i in first], np.array(first, np.int64), start, end


def _along(likelihoods: DataFrame, *columns) -> DataFrame:
    """Regions of a sample's chromosome in one task, in order."""
    rows = likelihoods.select("sample", "chr", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), *columns)
    return rows.repartition("sample", "chr").sortWithinPartitions("sample", "chr", "start", "end")


def decode(likelihoods: DataFrame, states: tuple = STATES, isolate: bool = False) -> DataFrame:
    """(sample, chr, start, end, cov, cn_pred, chr_cost) from rows with an array ``nll`` of state costs.

    Chromosomes are independent, as nothing is carried over an infinite distance. A task reads its
    chromosomes in order and decodes as many whole ones at once as BATCH_REGIONS regions hold, all of
    them stepped together; what it holds is bounded by those and the longest chromosome. With
    ``isolate`` a chromosome without all of its costs gives one row with an ``error`` and no state,
    where it would end the job otherwise.
    """
    names = np.array(states, object)
    fields = [("sample", pa.string()), ("chr", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("cov", pa.float64()), ("cn_pred", pa.string()), ("chr_cost", pa.float64())]
    fields += [("error", pa.string())] if isolate else []

    def decoded(table: pa.Table) -> pa.RecordBatch:
        costs, sound = _costs(table.column("nll"), len(states))
        keys, first, start, end = _named(table)
        ends = np.append(first[1:], len(costs))
        fine = np.array([bool(sound[a:b].all()) for a, b in zip(first, ends)], bool)
        if not fine.all() and not isolate:
            raise ValueError("costs are missing")
        kept = np.concatenate([np.full(b - a, f) for a, b, f in zip(first, ends, fine)])
        gap = np.concatenate([[np.inf], start[1:] - end[:-1]])
        length = (ends - first)[fine]
        steps = Steps(costs[kept], _mixed(gap)[kept], np.cumsum(length) - length, [None] * int(fine.sum()), states)
        path, cost = steps.paths(), np.repeat(steps.total.min(1), length)
        rows = np.concatenate([np.flatnonzero(kept), first[~fine]])
        order = np.argsort(rows, kind="stable")
        predicted, costs_of = np.concatenate([names[path], np.full((~fine).sum(), None)])[order], np.concatenate([cost, np.full((~fine).sum(), np.nan)])[order]
        shown = table.take(pa.array(rows[order]))
        more = [pa.array(predicted, pa.string()), pa.array(costs_of)]
        if isolate:
            more.append(pa.array([None if kept[i] else "ValueError: costs are missing" for i in rows[order]], pa.string()))
        columns = [*(shown.column(c).combine_chunks() for c in ("sample", "chr", "start", "end", "cov")), *more]
        return pa.RecordBatch.from_arrays(columns, names=[n for n, _ in fields])

    def run(batches):
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n < BATCH_REGIONS:
                continue
            table = pa.Table.from_batches(held)
            last = int(_named(table)[1][-1])  # the last chromosome may go on
            if last:
                yield decoded(table.slice(0, last))
                table = table.slice(last)
            held, n = table.to_batches(), table.num_rows
        if n:
            yield decoded(pa.Table.from_batches(held))

    schema = "sample string, chr string, start long, end long, cov double, cn_pred string, chr_cost double" + (", error string" if isolate else "")
    return _along(likelihoods, F.col("cov").cast("double").alias("cov"), "nll").mapInArrow(run, schema)


def path_costs(likelihoods: DataFrame, states: tuple = STATES) -> DataFrame:
    """(sample, chr, chr_cost): the cost of each chromosome's cheapest path alone.

    No back pointers are kept, and a chromosome goes on from one batch to the next by its states' costs,
    so a task holds a batch. Costs that are missing are an error.
    """
    names = ["sample", "chr", "chr_cost"]

    def row(key, total):
        return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.string()), pa.array([key[1]], pa.string()), pa.array([float(total.min())])], names=names)

    def run(batches):
        key = total = ended = None
        for batch in batches:
            if not batch.num_rows:
                continue
            costs, sound = _costs(batch.column("nll"), len(states))
            if not sound.all():
                raise ValueError("costs are missing")
            keys, first, start, end = _named(batch)
            gap = np.concatenate([[start[0] - ended if ended is not None else np.inf], start[1:] - end[:-1]])
            goes_on = total is not None and keys[0] == key
            if total is not None and not goes_on:
                yield row(key, total)
            steps = Steps(costs, _mixed(gap), first, [total if goes_on else None, *[None] * (len(keys) - 1)], states)
            steps.forward(False)
            if len(keys) > 1:
                done = keys[:-1]
                yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in done], pa.string()), pa.array([c for _, c in done], pa.string()), pa.array(steps.total[:-1].min(1))], names=names)
            key, total, ended = keys[-1], steps.total[-1], end[-1]
        if total is not None:
            yield row(key, total)

    return _along(likelihoods, "nll").mapInArrow(run, "sample string, chr string, chr_cost double")


def without_failures(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of the samples of which every chromosome was decoded, (sample, chr, error) of the others)."""
    errors = decoded.where("error is not null").select("sample", "chr", "error")
    return decoded.join(errors.select("sample").distinct(), "sample", "left_anti").drop("error"), errors
