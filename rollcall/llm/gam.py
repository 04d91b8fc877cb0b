"""A generalised additive model with pairwise interactions, fitted by cyclic boosting."""

from dataclasses import dataclass
from itertools import combinations

import numpy as np

#: Most bins of a feature, and of each side of a pair.
BINS, PAIR_BINS = 64, 16
#: Pairs the model keeps, rounds over single features and over pairs, shrinkage, leaf penalty.
PAIRS, ROUNDS, PAIR_ROUNDS, RATE, PENALTY = 10, 250, 100, 0.08, 4.0


@dataclass
class AdditiveModel:
    """Lookup tables: a row's score is the base plus one cell of each."""

    base: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_edges: list[np.ndarray]
    pair_tables: list[np.ndarray]

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Probabilities of label 1 for a matrix of features."""
        total = np.full(len(rows), self.base)
        for column, (edges, cells) in enumerate(zip(self.edges, self.tables, strict=True)):
            total += cells[np.searchsorted(edges, rows[:, column], side="right")]
        coarse = {
            f: np.searchsorted(self.pair_edges[f], rows[:, f], side="right")
            for f in {f for pair in self.pairs for f in pair}
        }
        for (a, b), cells in zip(self.pairs, self.pair_tables, strict=True):
            total += cells[coarse[a], coarse[b]]
        return _probability(total)


def _probability(total):
    return 1.0 / (1.0 + np.exp(-np.clip(total, -30, 30)))


def _edges(values, bins):
    """Cuts between quantiles; a value equal to a cut lies above it."""
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _gain(g, h):
    return g * g / (h + PENALTY)


def _split(g, h):
    """The best cut of a row of bins: its gain and the number of bins on the left."""
    if len(g) < 2:
        return 0.0, 0
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    total_g, total_h = g.sum(), h.sum()
    gains = _gain(left_g, left_h) + _gain(total_g - left_g, total_h - left_h)
    best = int(np.argmax(gains))
    return float(gains[best] - _gain(total_g, total_h)), best + 1


def _shallow_tree(g, h):
    """A tree of depth two over a feature's bins, as a step for each bin."""
    _, middle = _split(g, h)
    step = np.empty(len(g))
    for start, end in ((0, middle), (middle, len(g))):
        gain, cut = _split(g[start:end], h[start:end])
        cut = start + cut if gain > 0 else end
        for low, high in ((start, cut), (cut, end)):
            if high > low:
                step[low:high] = g[low:high].sum() / (h[low:high].sum() + PENALTY)
    return step


def _quadrants(g, h):
    """The best cut of a pair's grid, each half cut once across: gain and step per cell."""
    best, found = 0.0, np.zeros_like(g)
    for turned in (False, True):
        gg, hh = (g.T, h.T) if turned else (g, h)
        up_g, up_h = np.cumsum(gg, axis=0), np.cumsum(hh, axis=0)
        for cut in range(1, len(gg)):
            halves = ((up_g[cut - 1], up_h[cut - 1]), (up_g[-1] - up_g[cut - 1], up_h[-1] - up_h[cut - 1]))
            cuts = [_split(*half) for half in halves]
            gain = sum(c[0] + _gain(x.sum(), y.sum()) for c, (x, y) in zip(cuts, halves, strict=True))
            gain -= _gain(g.sum(), h.sum())
            if gain > best:
                best, step = gain, np.empty_like(gg)
                for rows, (_, across), (x, y) in zip((slice(0, cut), slice(cut, None)), cuts, halves, strict=True):
                    for cols in (slice(0, across), slice(across, None)):
                        step[rows, cols] = x[cols].sum() / (y[cols].sum() + PENALTY)
                found = step.T if turned else step
    return best, found


def _steps(labels, total):
    p = _probability(total)
    return labels - p, p * (1 - p)


def fit(rows: np.ndarray, labels: np.ndarray) -> AdditiveModel:
    """Fit to a bounded sample.  Without both labels the score is their share, or one half."""
    columns = rows.shape[1]
    share = float(np.clip(labels.mean(), 1e-3, 1 - 1e-3)) if len(labels) else 0.5
    base = float(np.log(share / (1 - share)))
    if len(np.unique(labels)) < 2:
        none = [np.array([]) for _ in range(columns)]
        return AdditiveModel(base, none, [np.zeros(1) for _ in none], [], none, [])
    edges = [_edges(rows[:, f], BINS) for f in range(columns)]
    bins = [np.searchsorted(edges[f], rows[:, f], side="right") for f in range(columns)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    total = np.full(len(rows), base)
    for _ in range(ROUNDS):
        for f in range(columns):
            g, h = _steps(labels, total)
            size = len(tables[f])
            step = RATE * _shallow_tree(
                np.bincount(bins[f], g, size), np.bincount(bins[f], h, size)
            )
            tables[f] += step
            total += step[bins[f]]
    pair_edges = [_edges(rows[:, f], PAIR_BINS) for f in range(columns)]
    coarse = [np.searchsorted(pair_edges[f], rows[:, f], side="right") for f in range(columns)]

    def grid(a, b, values):
        shape = len(pair_edges[a]) + 1, len(pair_edges[b]) + 1
        return np.bincount(coarse[a] * shape[1] + coarse[b], values, shape[0] * shape[1]).reshape(shape)

    g, h = _steps(labels, total)
    ranked = sorted(
        combinations(range(columns), 2),
        key=lambda pair: -_quadrants(grid(*pair, g), grid(*pair, h))[0],
    )
    pairs = ranked[:PAIRS]
    pair_tables = [np.zeros((len(pair_edges[a]) + 1, len(pair_edges[b]) + 1)) for a, b in pairs]
    for _ in range(PAIR_ROUNDS):
        for (a, b), cells in zip(pairs, pair_tables, strict=True):
            g, h = _steps(labels, total)
            step = RATE * _quadrants(grid(a, b, g), grid(a, b, h))[1]
            cells += step
            total += step[coarse[a], coarse[b]]
    return AdditiveModel(base, edges, tables, pairs, pair_edges, pair_tables)
