"""Operator 8: a sparse rule ensemble for text quality.

Statistics of a text are column expressions. On a bounded sample of labelled rows small boosted
trees are grown; every path from a root becomes a conjunctive rule over the statistics; a lasso
logistic regression keeps few of the rules. The kept rules are compiled back into one column
expression, so scoring is a single pass of built-in functions.

Only the text is an input of the score. Defined results: a null text counts as empty, and an empty
text has all statistics 0 and a score. Without labels of both kinds, or too few to
grow a tree, the score is the share of label 1 among them, or 0.5. Equal rows give equal scores, one row each. Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailfacts.llm.common import SPACED_WORD, fold, text_or_empty

FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.7
SAMPLE = 20_000

NAMES = (
    "words", "word_length", "symbols", "capitals", "digits", "stops", "shouts", "lines",
    "new_words", "new_triples", "new_lines",
)

Test = tuple[int, bool, float]  # statistic, whether above, bound


def _share(count: Column, of: Column) -> Column:
    return count.cast("double") / F.greatest(of, F.lit(1))


def statistics(text: Column) -> dict[str, Column]:
    """Statistics over three prepared columns: the text, its words ``w`` and its lines ``l``."""
    w, chars, n = F.col("w"), F.char_length(text), F.size("w")

    def count(pattern: str) -> Column:
        return F.regexp_count(text, F.lit(pattern))

    third = F.transform(w, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))
    values = (
        n.cast("double"),
        _share(chars - n + 1, n),
        _share(count(r"[#*$%&|<>]"), n),
        _share(count("[A-Z]"), chars),
        _share(count("[0-9]"), chars),
        _share(count("[.,;:?]"), n),
        _share(count("!"), n),
        _share(F.size("l"), n),
        _share(F.size(F.array_distinct(w)), n),
        _share(F.size(F.array_distinct(third)), n),
        _share(F.size(F.array_distinct("l")), F.size("l")),
    )
    return dict(zip(NAMES, values, strict=True))


def with_statistics(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns of ``docs`` and the statistics of its text."""
    prepared = docs.select(
        *keep,
        text_or_empty().alias("t"),
        F.regexp_extract_all(text_or_empty(), F.lit(SPACED_WORD), F.lit(0)).alias("w"),
        F.split(text_or_empty(), "\n").alias("l"),
    )
    # As the one row of an inline table: a filter on the score, which names each statistic many
    # times, then stays above, where they are values, and is not merged with what computes them.
    values = F.struct(*(c.alias(k) for k, c in statistics(F.col("t")).items()))
    return prepared.select(*keep, F.inline(F.array(values)))


@dataclass(frozen=True)
class RuleEnsemble:
    intercept: float
    rules: tuple[tuple[tuple[Test, ...], float], ...]

    def column(self) -> Column:
        """The score as an expression over the statistics."""
        total = F.lit(self.intercept)
        for tests, weight in self.rules:
            total = total + F.when(_all(tests), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))

    def score(self, x: np.ndarray) -> np.ndarray:
        """The same for an array of statistics."""
        total = np.full(len(x), self.intercept)
        for tests, weight in self.rules:
            total += weight * holds(tests, x)
        return 1 / (1 + np.exp(-total))


def _all(tests: tuple[Test, ...]) -> Column:
    out = F.lit(True)
    for i, above, bound in tests:
        out = out & (F.col(NAMES[i]) > bound if above else F.col(NAMES[i]) <= bound)
    return out


def holds(tests: tuple[Test, ...], x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for i, above, bound in tests:
        out &= (x[:, i] > bound) == above
    return out


def _split(x: np.ndarray, g: np.ndarray, h: np.ndarray, least: int) -> tuple[float, int, float]:
    """The best (gain, statistic, bound) of a node, over all cuts between distinct values."""
    best, base = (1e-6, -1, 0.0), g.sum() ** 2 / (h.sum() + 1)
    for i in range(x.shape[1]):
        order = np.argsort(x[:, i], kind="stable")
        v = x[order, i]
        cuts = np.flatnonzero(v[1:] > v[:-1]) + 1
        cuts = cuts[(cuts >= least) & (cuts <= len(v) - least)]
        if not len(cuts):
            continue
        gs, hs = np.cumsum(g[order]), np.cumsum(h[order])
        gl, hl = gs[cuts - 1], hs[cuts - 1]
        gain = gl**2 / (hl + 1) + (gs[-1] - gl) ** 2 / (hs[-1] - hl + 1) - base
        k = int(np.argmax(gain))
        if gain[k] > best[0]:
            best = (float(gain[k]), i, float((v[cuts[k] - 1] + v[cuts[k]]) / 2))
    return best


def grow_rules(x: np.ndarray, y: np.ndarray, trees: int = 24, depth: int = 3, rate: float = 0.3, seed: int = 7) -> list[tuple[Test, ...]]:
    """Paths of boosted trees; each tree sees a random half of the statistics and rows."""
    rng, f, rules = np.random.default_rng(seed), np.zeros(len(y)), {}
    least = max(5, len(y) // 500)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-f))
        g, h = y - p, p * (1 - p)
        use = np.sort(rng.permutation(x.shape[1])[: max(2, x.shape[1] // 2)])
        rows = np.sort(rng.permutation(len(y))[: max(2 * least, len(y) // 2)])
        todo = [((), rows)]
        while todo:
            tests, at = todo.pop()
            found = _split(x[np.ix_(at, use)], g[at], h[at], least) if len(tests) < depth and len(at) >= 2 * least else (0, -1, 0.0)
            if found[1] < 0:
                f[holds(tests, x)] += rate * g[at].sum() / (h[at].sum() + 1)
                continue
            i, bound = int(use[found[1]]), found[2]
            for above in (False, True):
                path = (*tests, (i, above, bound))
                rules.setdefault(tuple(sorted(path)), None)
                todo.append((path, at[(x[at, i] > bound) == above]))
    return list(rules)


def fit_lasso(z: np.ndarray, y: np.ndarray, penalty: float, steps: int = 400) -> tuple[float, np.ndarray]:
    """Logistic regression with an absolute penalty, by accelerated proximal gradient steps."""
    a = np.hstack([np.ones((len(y), 1)), z])
    size = 4 * len(y) / np.linalg.norm(a, 2) ** 2
    w = np.zeros(a.shape[1])
    w[0] = np.log(y.mean() / (1 - y.mean()))
    v, t = w.copy(), 1.0
    for _ in range(steps):
        step = v - size * (a.T @ (1 / (1 + np.exp(-np.clip(a @ v, -30, 30))) - y)) / len(y)
        new = np.sign(step) * np.maximum(np.abs(step) - size * penalty, 0)
        new[0] = step[0]
        t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        v, w = new + (before - 1) / t * (new - w), new
    return float(w[0]), w[1:]


def fit(x: np.ndarray, y: np.ndarray, penalty: float = 5e-4) -> RuleEnsemble:
    rules = grow_rules(x, y) if len(y) and y.min() < y.max() else []
    if not rules:
        share = float(np.clip(y.mean(), 0.01, 0.99)) if len(y) else 0.5
        return RuleEnsemble(float(np.log(share / (1 - share))), ())
    z = np.column_stack([holds(r, x) for r in rules]).astype(float)
    keep = (z.mean(0) > 0.002) & (z.mean(0) < 0.998)
    intercept, weights = fit_lasso(z[:, keep], y, penalty)
    kept = [r for r, k in zip(rules, keep, strict=True) if k]
    chosen = [(r, float(w)) for r, w in zip(kept, weights, strict=True) if abs(w) > 1e-4]
    return RuleEnsemble(intercept, tuple(chosen))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, training: Column, size: int) -> DataFrame:
    """(doc_id, text, y) of the documents of at most ``size`` labelled training ids, chosen by a
    hash of the id. The chosen ids are broadcast; ``size`` bounds them. A doubly labelled id takes
    the larger label. Whoever collects must bound the rows too, as ids may repeat."""
    chosen = (
        labels.where(training & F.col(label).isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max(label).cast("double").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(size)
    )
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> RuleEnsemble:
    """Fit on at most ``sample`` labelled rows outside the held-out fold."""
    rows = labelled_sample(docs, labels, "quality", fold("doc_id", FOLDS) != HELD_OUT, sample)
    # Bounded after the statistics: these are computed where the texts are, numbers travel.
    table = with_statistics(rows, "doc_id", "y").limit(sample).toPandas().sort_values("doc_id")
    return fit(table[list(NAMES)].to_numpy(float), table["y"].to_numpy(float))


def score_quality(docs: DataFrame, model: RuleEnsemble) -> DataFrame:
    """Fold, score and verdict of each row of ``docs`` (doc_id, text)."""
    score = model.column()
    return (
        with_statistics(docs, "doc_id")
        .select("doc_id", (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), score.alias("score"))
        .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
    )


def keep_good(docs: DataFrame, model: RuleEnsemble) -> DataFrame:
    """The rows of ``docs`` that score at least ``THRESHOLD``; all columns as they are."""
    inner = docs.select(F.struct(*docs.columns).alias("row"), F.col("text").alias("text"))
    scored = with_statistics(inner, "row").where(model.column() >= THRESHOLD)
    return scored.select("row.*")
