"""The decoder of many chromosomes at once against the one of a chromosome."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from helixframe.functions.model import STATES
from helixframe.operators import hmm, likelihood

ROWS = "sample string, chr string, start long, end long, cov double, nll array<double>"


def regions(seed, lengths):
    rng = np.random.default_rng(seed)
    rows = []
    for i, n in enumerate(lengths):
        start = np.cumsum(rng.integers(1, 200_000, n)) * 10
        for a in start.tolist():
            rows.append((f"s{i % 3}", f"c{i}", a, a + int(rng.integers(1, 90_000)), float(i), [float(x) for x in rng.exponential(4, len(STATES))]))
    return rows


def one_by_one(rows):
    want = {}
    for key in {r[:2] for r in rows}:
        own = sorted(r for r in rows if r[:2] == key)
        gap = np.array([np.inf] + [b[2] - a[3] for a, b in zip(own, own[1:])])
        path, cost = hmm.viterbi(np.array([r[5] for r in own]), gap)
        want[key] = ([STATES[k] for k in path], cost, [r[2] for r in own])
    return want


@pytest.mark.parametrize("most", [1, 40, 1 << 16])
def test_decoder_in_batches(spark, monkeypatch, most):
    monkeypatch.setattr(hmm, "BATCH_REGIONS", most)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = regions(1, [1, 30, 2, 17, 60, 1, 5])
        df = spark.createDataFrame(rows, ROWS)
        want = one_by_one(rows)
        got = {}
        for r in hmm.decode(df).collect():
            got.setdefault((r["sample"], r["chr"]), []).append((r["start"], r["cn_pred"], r["chr_cost"], r["cov"]))
        assert set(got) == set(want)
        for key, (path, cost, starts) in want.items():
            own = sorted(got[key])
            assert [x[0] for x in own] == starts and [x[1] for x in own] == path and all(x[2] == pytest.approx(cost, rel=1e-12) for x in own)
        costs = {(r["sample"], r["chr"]): r["chr_cost"] for r in hmm.path_costs(df).collect()}
        assert costs == {k: pytest.approx(v[1], rel=1e-12) for k, v in want.items()}
        total = {r["sample"]: r["cost"] for r in likelihood.path_cost(df).collect()}
        assert total == {s: pytest.approx(sum(v[1] for k, v in want.items() if k[0] == s)) for s in ("s0", "s1", "s2")}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_missing_costs_stay_with_their_chromosome(spark):
    rows = regions(2, [4, 6, 3, 5])
    rows[5] = (*rows[5][:5], None)
    rows[11] = (*rows[11][:5], [1.0, 2.0])
    rows[-1] = (*rows[-1][:5], [None, *rows[-1][5][1:]])
    df = spark.createDataFrame(rows, ROWS)
    found = hmm.decode(df, isolate=True).collect()
    bad = sorted((r["chr"], r["cn_pred"], r["error"]) for r in found if r["error"])
    assert bad == [(c, None, "ValueError: costs are missing") for c in ("c1", "c2", "c3")]
    assert len([r for r in found if not r["error"]]) == 4
    for broken in (hmm.decode, hmm.path_costs):
        with pytest.raises(Exception, match="costs are missing"):
            broken(df).collect()
    assert hmm.decode(df.where(F.lit(False))).collect() == [] and hmm.path_costs(df.where(F.lit(False))).collect() == []


def test_steps_of_several_parts():
    rng = np.random.default_rng(3)
    costs, t = rng.exponential(3, (50, 7)), rng.random(50)
    t[[0, 20]] = 0
    whole = hmm.Steps(costs, t, np.array([0, 20]), [None, None])
    whole.forward(False)
    left = hmm.Steps(costs[:35], t[:35], np.array([0, 20]), [None, None])
    left.forward(False)
    rest = hmm.Steps(costs[35:], t[35:], np.array([0]), [left.total[1]])
    rest.forward(False)
    assert np.allclose(whole.total, [left.total[0], rest.total[0]], rtol=1e-14)
