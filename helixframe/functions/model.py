"""States of the copy-number model: genotypes, priors, transitions. Fixed values of the domain."""

from __future__ import annotations

import numpy as np

STATES = ("0", "1", "2", "3", "4", "5", "LOH")
#: state, copies, copies of the variant allele, probability of the genotype within the state
GENOTYPES = (
    ("0", 0, 0, 1.0),
    ("1", 1, 0, 0.5),
    ("1", 1, 1, 0.5),
    ("2", 2, 1, 1.0),
    ("3", 3, 1, 0.5),
    ("3", 3, 2, 0.5),
    ("4", 4, 1, 0.25),
    ("4", 4, 2, 0.5),
    ("4", 4, 3, 0.25),
    ("5", 5, 1, 0.125),
    ("5", 5, 2, 0.375),
    ("5", 5, 3, 0.375),
    ("5", 5, 4, 0.125),
    ("LOH", 2, 0, 0.5),
    ("LOH", 2, 2, 0.5),
)
PRIOR_WEIGHTS = (1.0, 2.0, 500.0, 2.0, 1.0, 0.5, 2.0)
COPIES = {"0": 0.0, "1": 1.0, "2": 2.0, "3": 3.0, "4": 4.0, "5": 5.0, "LOH": 2.0}
DISTANCE, DISTANCE_SCALE = 50_000.0, 10_000.0


def prior(states: tuple = STATES) -> np.ndarray:
    weights = np.array([w for s, w in zip(STATES, PRIOR_WEIGHTS) if s in states])
    return weights / weights.sum()


def false_positive() -> float:
    """Floor added to each state's likelihood."""
    p = prior()
    return float((1 - p.max()) / 6)


def transitions(states: tuple = STATES) -> np.ndarray:
    """P(to | from), rows by state left: staying as likely as the normal state's prior, return to normal 1/K."""
    p, k = prior(states), len(states)
    normal = states.index("2")
    m = np.tile(p, (k, 1))
    m[:, normal] = 1.0 / k
    np.fill_diagonal(m, p.max())
    m[normal] = p
    return m / m.sum(1, keepdims=True)


def mixing(distance: float) -> float:
    """How much of the transition matrix holds over a distance; nothing over an infinite one."""
    return 1 - 1 / (1 + np.exp(-(min(distance, 1e9) - DISTANCE) / DISTANCE_SCALE))


def transition_costs(distance: float, states: tuple = STATES) -> np.ndarray:
    t = mixing(distance)
    return -np.log(t * transitions(states) + (1 - t) * prior(states)[None])
