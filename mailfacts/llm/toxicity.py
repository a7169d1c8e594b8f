"""Operator 4: toxicity by a bidirectional gated recurrent network with attention pooling.

A word enters as the sum of what its hashed identity says (an embedding) and, beside it, the mean
of the embeddings of its letter triples, so that unseen forms of a known stem count. Two gated
recurrent layers read a window from either side, attention weighs their states, and the pooled
state gives a logit. A text's score is that of its most toxic window, calibrated; windows of
``WINDOW`` words start every ``STRIDE`` words and together cover the whole text.

Training runs in numpy on a bounded sample of labelled rows outside the held-out fold, with whole
texts: windows are chosen by the model itself (of each text the highest), at first by the log odds
of their words. Scoring is a map over documents with arrays of fixed size.

Only the text is an input of the score. Defined results: null and empty texts have one window
without words, whose logit is the output bias. Without labels of both kinds all scores are 0.
Equal rows give equal scores, one row each. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailfacts.llm.common import chunks, fold, text_or_empty
from mailfacts.llm.quality import labelled_sample
from mailfacts.llm.words import NOT_PLAIN, mix, words_of

FOLDS = 5
TOXIC_SAMPLE, CLEAN_SAMPLE = 1_000, 3_000
WINDOW, STRIDE = 20, 10
WORD_ROWS, TRIPLE_ROWS = 1 << 14, 1 << 13
EMBED, STATE, ATTEND = 8, 12, 8
ROUNDS, EPOCHS, BATCH, RATE = 3, 4, 256, 0.01
# Only words of so many sampled texts have an embedding of their own; it decays, as all weights do.
LEAST_TEXTS, DECAY = 5, 0.02
WINDOWS_AT_ONCE = 4_096

Params = dict[str, np.ndarray]


class Text:
    """The distinct words of some texts, their letter triples, and the windows over them."""

    def __init__(self, column: pa.Array) -> None:
        words = words_of(column, NOT_PLAIN, lower=True)
        hashes, first, self.ids = np.unique(words.hashes(), return_index=True, return_inverse=True)
        self.rows = (hashes % np.uint64(WORD_ROWS)).astype(np.int64)
        start, length = words.start[first], (words.end - words.start)[first]
        self.count = length
        at = np.repeat(np.cumsum(length) - length, length)
        where = np.repeat(start, length) + np.arange(length.sum()) - at
        # The triple around each byte, with a zero before and after the word.
        data = np.concatenate([words.data, [0]]).astype(np.uint64)
        inner = np.arange(length.sum()) - at
        before = np.where(inner > 0, data[where - 1], np.uint64(0))
        after = np.where(inner < np.repeat(length, length) - 1, data[where + 1], np.uint64(0))
        code = before << np.uint64(16) | data[where] << np.uint64(8) | after
        self.triples = (mix(code) % np.uint64(TRIPLE_ROWS)).astype(np.int64)
        self.owner = np.repeat(np.arange(len(hashes)), length)
        # Windows: word places, -1 beyond the text's end.
        n = words.counts
        per = np.maximum(1, -(-(n - (WINDOW - STRIDE)) // STRIDE))
        self.doc = np.repeat(np.arange(len(n)), per)
        self.first_window = np.cumsum(per) - per
        offset = (np.arange(per.sum()) - np.repeat(self.first_window, per)) * STRIDE
        place = offset[:, None] + np.arange(WINDOW)
        inside = place < n[self.doc][:, None]
        place = np.where(inside, place + words.bounds[self.doc][:, None], 0)
        distinct = np.append(self.ids, 0)
        self.windows = np.where(inside, distinct[np.minimum(place, len(self.ids))], -1)

    def inputs(self, p: Params, only: np.ndarray | None = None) -> np.ndarray:
        """The two embeddings of each distinct word."""
        rows, count, triples, owner = self.rows, self.count, self.triples, self.owner
        if only is not None:
            use = np.zeros(len(rows), bool)
            use[only] = True
            keep = use[owner]
            new = np.cumsum(use) - 1
            rows, count, triples, owner = rows[only], count[only], triples[keep], new[owner[keep]]
        total = np.empty((len(rows), EMBED), np.float32)
        if len(rows):
            at = np.searchsorted(owner, np.arange(len(rows)))
            total = np.add.reduceat(p["triple"][triples], at) / count[:, None]
        self.last = (rows, count, triples, owner)
        return np.hstack([p["word"][rows], total]).astype(np.float32)


def initial(seed: int = 3) -> Params:
    rng = np.random.default_rng(seed)

    def small(*shape: int) -> np.ndarray:
        return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

    p: Params = {
        "word": np.zeros((WORD_ROWS, EMBED), np.float32),
        "triple": 0.3 * rng.standard_normal((TRIPLE_ROWS, EMBED)).astype(np.float32),
    }
    for side in "fb":
        p |= {f"w{side}": small(2 * EMBED, 3 * STATE), f"u{side}": small(STATE, 3 * STATE), f"c{side}": np.zeros(3 * STATE, np.float32)}
    p |= {"wa": small(2 * STATE, ATTEND), "ca": np.zeros(ATTEND, np.float32), "va": small(ATTEND)}
    return p | {"wo": small(2 * STATE), "co": np.array([-1.0], np.float32)}


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def forward(p: Params, inputs: np.ndarray, windows: np.ndarray, keep: bool = False) -> tuple:
    """Logits of windows over rows of ``inputs`` (-1: no word), and what training needs."""
    size, cache = len(windows), {}
    mask = windows >= 0
    states = np.empty((size, WINDOW, 2 * STATE), np.float32)
    for side in "fb":
        drive = np.vstack([inputs @ p[f"w{side}"] + p[f"c{side}"], np.zeros((1, 3 * STATE), np.float32)])
        part = slice(0, STATE) if side == "f" else slice(STATE, 2 * STATE)
        h, steps, u = np.zeros((size, STATE), np.float32), [], p[f"u{side}"]
        for t in range(WINDOW) if side == "f" else reversed(range(WINDOW)):
            x, m = drive[windows[:, t]], mask[:, t, None]
            back = h @ u
            gates = sigmoid(x[:, : 2 * STATE] + back[:, : 2 * STATE])
            z, r = gates[:, :STATE], gates[:, STATE:]
            n = np.tanh(x[:, 2 * STATE :] + r * back[:, 2 * STATE :])
            new = np.where(m, n + z * (h - n), h)
            if keep:
                steps.append((t, h, z, r, n, back[:, 2 * STATE :]))
            h = new
            states[:, t, part] = h
        cache[side] = steps
    hidden = np.tanh(states @ p["wa"] + p["ca"])
    e = np.where(mask, hidden @ p["va"], -30.0)
    a = np.exp(e - e.max(1, keepdims=True)) * mask
    a /= np.maximum(a.sum(1, keepdims=True), 1e-9)
    pooled = np.einsum("bt,bts->bs", a, states)
    logit = pooled @ p["wo"] + p["co"][0]
    return (logit, (states, hidden, a, pooled, mask, cache)) if keep else (logit, None)


def backward(p: Params, text: Text, inputs: np.ndarray, windows: np.ndarray, cached: tuple, d: np.ndarray) -> Params:
    """Gradients of sum(d * logit)."""
    states, hidden, a, pooled, mask, cache = cached
    rows, count, triples, owner = text.last
    g: Params = {"wo": pooled.T @ d, "co": np.array([d.sum()])}
    d_pooled = d[:, None] * p["wo"]
    d_states = a[:, :, None] * d_pooled[:, None, :]
    d_a = np.einsum("bts,bs->bt", states, d_pooled)
    d_e = a * (d_a - (a * d_a).sum(1, keepdims=True))
    g["va"] = np.einsum("bt,bta->a", d_e, hidden)
    d_hidden = d_e[:, :, None] * p["va"] * (1 - hidden**2)
    g["wa"] = np.einsum("bts,bta->sa", states, d_hidden)
    g["ca"] = d_hidden.sum((0, 1))
    d_states = d_states + d_hidden @ p["wa"].T
    d_inputs = np.zeros_like(inputs)
    for side in "fb":
        part = slice(0, STATE) if side == "f" else slice(STATE, 2 * STATE)
        d_u, d_h = np.zeros_like(p[f"u{side}"]), np.zeros((len(windows), STATE), np.float32)
        d_drive = np.zeros((len(inputs) + 1, 3 * STATE))
        for t, h, z, r, n, back_n in reversed(cache[side]):
            m = mask[:, t, None]
            d_new = d_h + d_states[:, t, part]
            d_n = d_new * (1 - z) * (1 - n**2) * m
            d_z = d_new * (h - n) * z * (1 - z) * m
            d_r = d_n * back_n * r * (1 - r)
            d_back = np.hstack([d_z, d_r, d_n * r])
            d_x = np.hstack([d_z, d_r, d_n])
            d_u += h.T @ d_back
            d_h = np.where(m, d_new * z, d_new) + d_back @ p[f"u{side}"].T
            at = windows[:, t]
            for k in range(3 * STATE):
                d_drive[:, k] += np.bincount(at % len(d_drive), d_x[:, k], len(d_drive))
        d_drive = d_drive[:-1].astype(np.float32)
        g |= {f"u{side}": d_u, f"w{side}": inputs.T @ d_drive, f"c{side}": d_drive.sum(0)}
        d_inputs += d_drive @ p[f"w{side}"].T
    g["word"], g["triple"] = np.zeros_like(p["word"]), np.zeros_like(p["triple"])
    share = d_inputs[:, EMBED:] / np.maximum(count, 1)[:, None]
    for k in range(EMBED):
        g["word"][:, k] = np.bincount(rows, d_inputs[:, k], WORD_ROWS)
        g["triple"][:, k] = np.bincount(triples, share[owner, k], TRIPLE_ROWS)
    return g


def logits(p: Params, text: Text) -> np.ndarray:
    """Logits of all windows."""
    inputs = text.inputs(p)
    parts = [forward(p, inputs, text.windows[i : i + WINDOWS_AT_ONCE])[0] for i in range(0, len(text.windows), WINDOWS_AT_ONCE)]
    return np.concatenate(parts) if parts else np.zeros(0, np.float32)


def highest(values: np.ndarray, text: Text) -> np.ndarray:
    """Of each text the window with the highest value."""
    order = np.lexsort((values, text.doc))
    last = np.append(text.first_window[1:], len(values)) - 1
    return order[last]


def word_odds(text: Text, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """By distinct word: the texts that hold it, and their log odds of the label, smoothed so that
    a word of few texts says little."""
    held = np.repeat(text.doc, WINDOW), text.windows.ravel()
    pairs = np.unique(held[0][held[1] >= 0] * len(text.rows) + held[1][held[1] >= 0])
    doc, word = pairs // max(len(text.rows), 1), pairs % max(len(text.rows), 1)
    toxic, clean = (np.bincount(word[y[doc] == v], minlength=len(text.rows)) for v in (1, 0))
    share = y.mean()
    odds = np.log((toxic + 4 * share) / y.sum()) - np.log((clean + 4 * (1 - share)) / (1 - y).sum())
    return toxic + clean, odds


def train(texts: list[str], y: np.ndarray, weight: np.ndarray, seed: int = 5) -> Params:
    """Fit the network and its calibration ("cal": slope, offset)."""
    p, rng, text = initial(), np.random.default_rng(seed), Text(pa.array(texts, pa.string()))
    held, odds = word_odds(text, y)
    own = np.zeros(WORD_ROWS, bool)
    own[text.rows[held >= LEAST_TEXTS]] = True
    odds = np.append(odds, -9.0)
    chosen = highest(odds[text.windows].max(1), text)
    m, v = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))
    step, trust = 0, np.ones(len(y))
    for _ in range(ROUNDS):
        # Beside its highest window, a clean text gives one at random.
        spare = np.array([rng.integers(a, b) for a, b in zip(text.first_window, np.append(text.first_window[1:], len(text.doc)), strict=True)])
        use = np.concatenate([chosen, spare[y == 0]])
        target = y[text.doc[use]]
        w = np.where(target == 1, trust[text.doc[use]] * np.sqrt((target == 0).sum() / max((target == 1).sum(), 1)), 1.0)
        for _ in range(EPOCHS):
            order = rng.permutation(len(use))
            for i in range(0, len(order), BATCH):
                at = order[i : i + BATCH]
                windows = text.windows[use[at]]
                only = np.unique(windows[windows >= 0])
                local = np.where(windows >= 0, np.searchsorted(only, windows), -1)
                inputs = text.inputs(p, only)
                # Now and then a word is hidden, so that its letters learn as well.
                shown = rng.random(len(only)) < 0.5
                inputs[:, :EMBED] *= shown[:, None]
                z, cached = forward(p, inputs, local, keep=True)
                d = ((sigmoid(z) - target[at]) * w[at] / len(at)).astype(np.float32)
                g, step = backward(p, text, inputs, local, cached, d), step + 1
                hidden = np.zeros(WORD_ROWS, bool)
                hidden[text.rows[only[~shown]]] = True
                g["word"] *= (own & ~hidden)[:, None]
                for k in p:
                    p[k] *= 1 - RATE * DECAY
                    m[k] += 0.1 * (g[k] - m[k])
                    v[k] += 0.001 * (g[k] ** 2 - v[k])
                    p[k] -= RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-6)
        z = logits(p, text)
        chosen = highest(z, text)
        # A toxic text without a window like those of others is more likely a wrong label.
        trust = np.where(sigmoid(z[chosen]) < 0.3, 0.1, 1.0)
    p["cal"] = calibrate(z[chosen], y, weight)
    return p


def calibrate(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted logistic regression on the highest logits, slightly ridged, by Newton steps."""
    a, w = np.column_stack([z, np.ones(len(z))]), np.array([1.0, 0.0])
    for _ in range(50):
        q = sigmoid(a @ w)
        h = (a * (weight * q * (1 - q))[:, None]).T @ a + 0.1 * np.eye(2)
        w = w - np.linalg.solve(h, a.T @ (weight * (q - y)) + 0.1 * (w - [1.0, 0.0]))
    return w


def fit(docs: DataFrame, labels: DataFrame, toxic: int = TOXIC_SAMPLE, clean: int = CLEAN_SAMPLE) -> Params | None:
    """Train on at most ``toxic`` and ``clean`` labelled rows outside the held-out fold."""
    training = fold("doc_id", FOLDS) != 0
    parts = []
    for value, size in ((1, toxic), (0, clean)):
        of = labels.where(F.col("toxic") == value)
        rows = labelled_sample(docs, of, "toxic", training, size).limit(size).toPandas()
        rows = rows.sort_values(["doc_id", "text"])
        parts.append((rows["text"].fillna("").tolist(), of.where(training).count()))
    if not parts[0][0] or not parts[1][0]:
        return None
    texts = parts[0][0] + parts[1][0]
    y = np.concatenate([np.full(len(part[0]), value) for value, part in ((1, parts[0]), (0, parts[1]))])
    weight = np.concatenate([np.full(len(t), total / len(t)) for t, total in parts])
    return train(texts, y, weight / weight.mean())


def score_toxicity(docs: DataFrame, model: Params | None) -> DataFrame:
    """Fold, score and verdict of each row of ``docs`` (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "text"):
            text = Text(part.column("text"))
            z = logits(model, text)
            best = np.maximum.reduceat(z, text.first_window)
            score = sigmoid(best.astype(float) * model["cal"][0] + model["cal"][1])
            columns = [part.column("doc_id"), part.column("held_out"), pa.array(score), pa.array((score >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), (fold("doc_id", FOLDS) == 0).alias("held_out"), text_or_empty().alias("text")
    )
    if model is None:
        return rows.select("doc_id", "held_out", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
