"""Non-negative positive-unlabelled learning of a sparse linear classifier, in numpy.

With a class prior p, confirmed positives P and unlabelled rows U, the risk of a
decision function f under the logistic loss l is estimated without negatives as

    p * E_P[l(f, +1)]  +  max(0, E_U[l(f, -1)] - p * E_P[l(f, -1)])

When the second part falls below zero, which is a sign that unlabelled rows are being
learned by heart, the step goes up that part's slope until it is positive again.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Rows:
    """Rows of distinct feature numbers, one after the other."""

    features: np.ndarray
    starts: np.ndarray

    @classmethod
    def of(cls, blobs: list[bytes]) -> Rows:
        sizes = np.array([len(b) // 4 for b in blobs], np.int64)
        return cls(np.frombuffer(b"".join(blobs), np.int32), np.concatenate(([0], np.cumsum(sizes))))

    def __len__(self) -> int:
        return len(self.starts) - 1

    def kept(self, keep: np.ndarray) -> Rows:
        """Only the features marked in ``keep``, with their new numbers."""
        number = np.cumsum(keep) - 1
        which = keep[self.features]
        before = np.concatenate(([0], np.cumsum(which)))
        return Rows(number[self.features[which]].astype(np.int32), before[self.starts])

    def every_other(self, first: int) -> Rows:
        """Each second row, from row ``first`` on."""
        sizes = np.diff(self.starts)
        which = np.arange(len(self)) % 2 == first
        return Rows(self.features[np.repeat(which, sizes)], np.concatenate(([0], np.cumsum(sizes[which]))))

    def sums(self, weights: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0.0], np.cumsum(weights[self.features])))
        return total[self.starts[1:]] - total[self.starts[:-1]]

    def spread(self, per_row: np.ndarray, size: int) -> np.ndarray:
        """Transpose of ``sums``."""
        return np.bincount(self.features, np.repeat(per_row, np.diff(self.starts)), size)


def logistic(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def train(
    positive: Rows,
    unlabelled: Rows,
    prior: float,
    size: int,
    *,
    least_rows: int = 3,
    least_z: float = 4.0,
    steps: int = 300,
    rate: float = 0.05,
    decay: float = 1e-5,
) -> tuple[np.ndarray, float]:
    """Weights of the ``size`` features and the bias.

    Features in fewer than ``least_rows`` rows weigh nothing, nor do those whose share
    of the positives is within ``least_z`` standard errors of their share of the unlabelled.
    Without positives or without unlabelled rows the weights are zero and the bias is
    that of the prior.
    """
    prior = float(np.clip(prior, 1e-3, 1 - 1e-3))
    bias = float(np.log(prior / (1 - prior)))
    if not len(positive) or not len(unlabelled):
        return np.zeros(size, np.float32), bias
    in_pos = np.bincount(positive.features, minlength=size)
    in_unl = np.bincount(unlabelled.features, minlength=size)
    shares = in_pos / len(positive), in_unl / len(unlabelled)
    pooled = (in_pos + in_unl) / (len(positive) + len(unlabelled))
    error = np.sqrt(pooled * (1 - pooled) * (1 / len(positive) + 1 / len(unlabelled))) + 1e-12
    keep = (in_pos + in_unl >= least_rows) & (np.abs(shares[0] - shares[1]) >= least_z * error)
    count = int(keep.sum())
    pos, unl = positive.kept(keep), unlabelled.kept(keep)
    w = np.zeros(count + 1)
    w[-1] = bias
    mean, square = np.zeros(count + 1), np.zeros(count + 1)
    for step in range(1, steps + 1):
        on_pos, on_unl = logistic(pos.sums(w[:-1]) + w[-1]), logistic(unl.sums(w[:-1]) + w[-1])
        # Slopes of l(f, +1) and l(f, -1) are on - 1 and on; l(f, -1) is -log(1 - on).
        below = -np.log1p(-np.minimum(on_unl, 1 - 1e-12)).mean() + prior * np.log1p(-np.minimum(on_pos, 1 - 1e-12)).mean() < 0
        if below:
            slope_pos, slope_unl = prior * on_pos / len(pos), -on_unl / len(unl)
        else:
            slope_pos = prior * (on_pos - 1) / len(pos) - prior * on_pos / len(pos)
            slope_unl = on_unl / len(unl)
        slope = np.append(pos.spread(slope_pos, count) + unl.spread(slope_unl, count), slope_pos.sum() + slope_unl.sum())
        slope[:-1] += decay * w[:-1]
        mean = 0.9 * mean + 0.1 * slope
        square = 0.99 * square + 0.01 * slope**2
        w -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-6)
    weights = np.zeros(size, np.float32)
    weights[keep] = w[:-1]
    return weights, float(w[-1])


#: Least share of the held-back positives that a threshold must reach to tell about the prior.
LEAST_REACHED = 0.5
#: Prior of the classifier whose order of rows the estimate uses; only the order counts.
NO_PRIOR = 0.5


def class_prior(positive: Rows, unlabelled: Rows, size: int, **training) -> float:
    """Share of positives among the unlabelled rows, from these two samples alone.

    A classifier is fitted on one half of each and orders the other half. Above any
    threshold lie a share p of the positives and u of the unlabelled rows, and since the
    unlabelled rows above it hold at least all their positives there, u / p is at least the
    prior; it equals the prior where nothing else lies above. The smallest u / p is taken,
    at the threshold where it is smallest with the sampling error of both shares added,
    among those that reach half of the positives: trusted positives need not be spread like
    the others, and a narrower part of them tells less. Each half takes its turn; the
    smaller bound counts. Sums are rounded, or those of equal rows would differ by the order
    of adding. It is 0.5 when there are fewer than two rows of a kind.
    """
    if len(positive) < 2 or len(unlabelled) < 2:
        return NO_PRIOR
    found = []
    for half in (0, 1):
        weights, _ = train(positive.every_other(half), unlabelled.every_other(half), NO_PRIOR, size, **training)
        others = (x.every_other(1 - half).sums(weights.astype(np.float64)) for x in (positive, unlabelled))
        found.append(_least_ratio(*(np.sort(sums.round(6)) for sums in others)))
    return float(np.clip(min(found), 0.0, 1.0))


def _least_ratio(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """The smallest share of ``unlabelled`` by share of ``positive`` above a threshold; both are sorted."""
    at = np.unique(positive)
    reached = 1 - np.searchsorted(positive, at) / len(positive)
    share = 1 - np.searchsorted(unlabelled, at) / len(unlabelled)
    # Deviation that a share of n rows exceeds with a probability under a twentieth.
    error = sum(np.sqrt(np.log(40) / (2 * len(x))) for x in (positive, unlabelled))
    bound = np.where(reached >= LEAST_REACHED, (share + error) / reached, np.inf)
    best = int(np.argmin(bound))
    return float(share[best] / reached[best])
