"""Quality classifier: a generalised additive model with pairwise interactions.

Each text gives a few surface features. On a bounded labelled sample (`max_train` rows) the
model cycles through the features, boosting shallow trees on their quantile bins into one
lookup table a feature; then it ranks the pairs of features by the residual they explain,
and boosts shallow two-way trees for the best into two-way tables. A score is the logistic of
the sum of the tables at a text's bins.

Defined cases: null text is empty and scored like any text; no labelled rows, or labels of one
class only, give one score for all texts, the smoothed share of label 1 (0.5 without labels);
rows with a null id or label are not learned from; repeated rows score alike; a null doc_id
counts as the empty text in the fold rule; extra columns are ignored by `quality_scores` and
kept by `keep_good`.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from millrace.llm.scoring import accepted, in_order, scored, training_rows

FEATURES = (
    "log_chars", "upper", "digit", "space", "newline", "stop_marks", "bang", "symbols", "bars", "brackets", "slashes", "quotes", "other_ascii", "non_ascii", "control",
    "word_length", "long_words", "short_words", "distinct_words", "top_word", "line_words", "distinct_lines", "top_line", "marked_ends", "upper_starts", "repeat_pairs",
)


def _mask(chars: str) -> np.ndarray:
    out = np.zeros(256)
    out[list(chars.encode())] = 1
    return out


_MASKS = np.array(
    [
        _mask("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _mask("0123456789"), _mask(" \t"), _mask("\n"), _mask(".,;:?"), _mask("!"), _mask("#$%&*@^~"), _mask("|"), _mask("<>[]{}()"),
        _mask("/\\_="), _mask("\"'`"), _mask("+-"), (np.arange(256) >= 128).astype(float), (np.arange(256) < 9).astype(float),
    ]
)
#: What a finished line ends in, blanks aside.
_ENDS = tuple(".!?:;\"')")


def features(text: str) -> np.ndarray:
    """One number for each of FEATURES, of the whole text."""
    raw = text.encode()
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) if raw else np.zeros(256)
    share = _MASKS @ counts / max(1, len(raw))
    words = text.split()
    n = max(1, len(words))
    sizes = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    seen = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    m = max(1, len(lines))
    same = Counter(lines)
    pairs = set(zip(words, words[1:], strict=False))
    return np.array(
        [
            np.log1p(len(text)), *share,
            sizes.mean(), (sizes > 14).mean(), (sizes <= 3).mean(), len(seen) / n, max(seen.values(), default=0) / n,
            len(words) / m, len(same) / m, max(same.values(), default=0) / m,
            sum(x.rstrip().endswith(_ENDS) for x in lines) / m, sum(w[0].isupper() for w in words) / n, len(pairs) / max(1, len(words) - 1),
        ]
    )


@dataclass
class Model:
    base: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    coarse: list[np.ndarray]
    pair_tables: list[np.ndarray]

    def score(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for j, (e, t) in enumerate(zip(self.edges, self.tables, strict=True)):
            out += t[np.searchsorted(e, x[:, j], "right")]
        for (a, b), t in zip(self.pairs, self.pair_tables, strict=True):
            out += t[np.searchsorted(self.coarse[a], x[:, a], "right"), np.searchsorted(self.coarse[b], x[:, b], "right")]
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1]))


def _leaf(g: np.ndarray, h: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    return g / (h + ridge)


def _gain(g: np.ndarray, h: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    return g * g / (h + ridge)


def _tree(g: np.ndarray, h: np.ndarray, depth: int) -> np.ndarray:
    """The leaf value at each bin of a tree of `depth` levels of cuts."""
    out = np.full(len(g), float(_leaf(g.sum(), h.sum())))
    if depth and len(g) > 1:
        cg, ch = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
        gain = _gain(cg, ch) + _gain(g.sum() - cg, h.sum() - ch)
        cut = int(np.argmax(gain)) + 1
        if gain[cut - 1] > _gain(g.sum(), h.sum()) + 1e-9:
            out[:cut], out[cut:] = _tree(g[:cut], h[:cut], depth - 1), _tree(g[cut:], h[cut:], depth - 1)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The best cut of both axes: its gain, and the leaf value at each cell."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    best, at = -1.0, (1, 1)
    for i in range(1, g.shape[0]):
        a, b = cg[i - 1, :-1], ch[i - 1, :-1]
        c, d = cg[-1, :-1] - a, ch[-1, :-1] - b
        e, f = cg[i - 1, -1] - a, ch[i - 1, -1] - b
        gain = _gain(a, b) + _gain(c, d) + _gain(e, f) + _gain(cg[-1, -1] - a - c - e, ch[-1, -1] - b - d - f)
        if len(gain) and gain.max() > best:
            best, at = float(gain.max()), (i, int(gain.argmax()) + 1)
    out = np.zeros(g.shape)
    for r in (slice(0, at[0]), slice(at[0], None)):
        for c in (slice(0, at[1]), slice(at[1], None)):
            if g[r, c].size:
                out[r, c] = _leaf(g[r, c].sum(), h[r, c].sum())
    return best, out


def fit(x: np.ndarray, y: np.ndarray, bins: int = 48, rounds: int = 120, rate: float = 0.1, pairs: int = 8, pair_rounds: int = 40, pair_bins: int = 8) -> Model:
    prior = float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))) if len(y) else 0.0
    if not len(y) or y.min() == y.max():
        return Model(prior, [], [], [], [], [])
    f = np.full(len(y), prior)
    edges = [_edges(x[:, j], bins) for j in range(x.shape[1])]
    coarse = [_edges(x[:, j], pair_bins) for j in range(x.shape[1])]
    at = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(edges)]
    cell = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(coarse)]
    tables = [np.zeros(len(e) + 1) for e in edges]

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-np.clip(f, -30, 30)))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for j, t in enumerate(tables):
            g, h = slopes()
            step = rate * _tree(np.bincount(at[j], g, len(t)), np.bincount(at[j], h, len(t)), 2)
            t += step
            f += step[at[j]]
    g, h = slopes()

    def grid(a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        shape = (len(coarse[a]) + 1, len(coarse[b]) + 1)
        flat = cell[a] * shape[1] + cell[b]
        return tuple(np.bincount(flat, v, shape[0] * shape[1]).reshape(shape) for v in (g, h))

    ranked = sorted(((_quadrants(*grid(a, b))[0], a, b) for a in range(x.shape[1]) for b in range(a)), reverse=True)
    chosen = [(a, b) for _, a, b in ranked[:pairs]]
    pair_tables = [np.zeros((len(coarse[a]) + 1, len(coarse[b]) + 1)) for a, b in chosen]
    for _ in range(pair_rounds):
        for (a, b), t in zip(chosen, pair_tables, strict=True):
            g, h = slopes()
            step = rate * _quadrants(*grid(a, b))[1]
            t += step
            f += step[cell[a], cell[b]]
    return Model(prior, edges, tables, chosen, coarse, pair_tables)


def train(docs: DataFrame, labels: DataFrame, max_train: int = 20_000, modulus: int = 5, held_out: int = 0) -> Model:
    rows = in_order(training_rows(docs, labels, "quality", modulus, held_out, max_train, features, "double"))  # a few numbers a row
    return fit(np.array([r.f for r in rows]).reshape(-1, len(FEATURES)), np.array([r.y for r in rows], float))


def _scorer(docs: DataFrame, model: Model):
    held = docs.sparkSession.sparkContext.broadcast(model)

    def score(texts: list[str]) -> np.ndarray:
        return held.value.score(np.array([features(t) for t in texts]).reshape(-1, len(FEATURES)))

    return score


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, max_train: int = 20_000) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    return scored(docs, _scorer(docs, train(docs, labels, max_train)), 5, 0, threshold)


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, max_train: int = 20_000) -> DataFrame:
    """docs without those that the classifier rejects."""
    return accepted(docs, _scorer(docs, train(docs, labels, max_train)), threshold)
