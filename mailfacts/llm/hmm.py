"""Operator 1: a hidden Markov language model.

Latent states emit word classes, classes emit words: P(text) is the sum over state paths of
transition and emission probabilities (the forward recursion, scaled, over the whole sequence with
its end token), times each word's share of its class. The most frequent words are classes of their
own, all others fall into hashed classes, so the trained parameters have a fixed size while every
word keeps its own probability from its count in the whole training fold.

1. Texts are read once. Each run of texts ("chunk") becomes local word numbers and a dictionary
   with one row per distinct word and chunk. Words are 64-bit hashes.
2. Dictionaries are summed to corpus counts and joined back, one row per word and chunk, so a word
   that stands in every text is as many rows as there are chunks, not texts.
3. Documents meet the counts of their chunk and become class sequences.
4. Baum-Welch: every partition adds up expected counts over its training sequences (of at most
   ``SEGMENT`` tokens), Spark sums them, the driver normalises arrays of fixed size.
5. Scores are exact for whole texts of any length.

Defined results: null and empty texts consist of the end token. Rows without an id belong to the
held-out fold, as crc32 of nothing is taken as 0. Without training texts every token has
probability one in the base model. Equal rows give equal scores, one row each; each counts in
training. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailfacts.llm.common import chunks, fold, stored, text_or_empty
from mailfacts.llm.words import mix, words_of

FOLDS = 10
STATES = 8
OWN_CLASSES = 1023
HASHED_CLASSES = 3072
CLASSES = 1 + OWN_CLASSES + HASHED_CLASSES  # the end token is class 0
ROUNDS = 5
SEGMENT = 512
CHUNK_WORDS = 1_300_000
STEP_TOKENS = 250_000
PSEUDO = 0.1
END = int(mix(np.array([0x454E44], np.uint64)).view(np.int64)[0])


def pack(ids: np.ndarray) -> bytes:
    """Numbers by byte planes: small ones leave planes of zeros, which compress away."""
    return ids.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def unpack(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel()


def encode(docs: DataFrame) -> DataFrame:
    """Document rows (kind 0: chunk, doc_id, held_out, ids) and dictionary rows (kind 1: chunk,
    lid, h, n), n being the word's count in training texts."""

    def flush(chunk: int, parts: list) -> Iterator[pa.RecordBatch]:
        hashes = np.concatenate([h for h, _, _, _ in parts] + [np.array([END], np.int64)])
        train = np.concatenate([np.repeat(~held, counts) for _, counts, _, held in parts] + [[False]])
        words, first, inverse, total = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
        n = np.bincount(inverse, train, len(words)).astype(np.int64)
        order = np.argsort(-total, kind="stable")
        rank = np.empty(len(words), np.int64)
        rank[order] = np.arange(len(words))
        words, n = words[order], n[order]
        n[np.flatnonzero(words == END)[0]] = sum(int((~held).sum()) for _, _, _, held in parts)
        ids, at = rank[inverse], 0
        for _, counts, doc_ids, held in parts:
            ends = at + np.cumsum(counts)
            rows = [pack(ids[e - c : e]) for e, c in zip(ends, counts, strict=True)]
            at = int(ends[-1]) if len(ends) else at
            yield batch(0, chunk, len(rows), doc_id=doc_ids, held_out=pa.array(held), ids=pa.array(rows, pa.binary()))
        for a in range(0, len(words), 100_000):
            b = min(a + 100_000, len(words))
            yield batch(1, chunk, b - a, lid=pa.array(np.arange(a, b), pa.int32()), h=pa.array(words[a:b]), n=pa.array(n[a:b]))

    def batch(kind: int, chunk: int, rows: int, **given: pa.Array) -> pa.RecordBatch:
        given |= {"kind": pa.array(np.full(rows, kind), pa.int32()), "chunk": pa.array(np.full(rows, chunk), pa.int64())}
        return pa.RecordBatch.from_arrays([given.get(f.name, pa.nulls(rows, f.type)) for f in schema], schema=schema)

    schema = pa.schema(
        [
            ("kind", pa.int32()), ("chunk", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()),
            ("ids", pa.binary()), ("lid", pa.int32()), ("h", pa.int64()), ("n", pa.int64()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, parts, size = TaskContext.get().partitionId() << 24, [], 0
        for part in chunks(batches, "text"):
            words = words_of(part.column("text"), lower=True)
            held = np.array(part.column("held_out").to_pylist(), bool)
            parts.append((words.hashes().view(np.int64), words.counts, part.column("doc_id"), held))
            size += len(words.start)
            if size >= CHUNK_WORDS:
                yield from flush(chunk, parts)
                chunk, parts, size = chunk + 1, [], 0
        if parts:
            yield from flush(chunk, parts)

    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), (fold("doc_id", FOLDS) == 0).alias("held_out"), text_or_empty().alias("text")
    )
    return rows.mapInArrow(
        run, "kind int, chunk long, doc_id long, held_out boolean, ids binary, lid int, h long, n long"
    )


@dataclass(frozen=True)
class Counts:
    """What the driver keeps of the corpus: totals, own-class words, and totals by class."""

    tokens: int
    types: int
    own: np.ndarray
    class_tokens: np.ndarray
    class_types: np.ndarray

    def classes_of(self, hashes: np.ndarray) -> np.ndarray:
        order = np.argsort(self.own)
        at = np.minimum(np.searchsorted(self.own[order], hashes), max(len(self.own) - 1, 0))
        out = 1 + OWN_CLASSES + (hashes.view(np.uint64) % np.uint64(HASHED_CLASSES)).astype(np.int64)
        if len(self.own):
            known = self.own[order][at] == hashes
            out[known] = 1 + order[at[known]]
        out[hashes == END] = 0
        return out


def corpus_counts(vocabulary: DataFrame) -> Counts:
    """From (h, c). The own-class words are a top list of fixed length; class totals are sums by
    class, of which there is a fixed number."""
    known = vocabulary.where("c > 0")
    top = known.where(F.col("h") != END).orderBy(F.desc("c"), "h").select("h").limit(OWN_CLASSES)
    own = np.array([r.h for r in top.collect()], np.int64)
    spark = vocabulary.sparkSession
    names = spark.createDataFrame([(int(h), i + 1) for i, h in enumerate(own)], "h long, own int")
    hashed = 1 + OWN_CLASSES + F.expr(f"cast(pmod(cast(h as decimal(20)) + if(h < 0, {2**64}BD, 0BD), {HASHED_CLASSES}BD) as int)")
    label = F.when(F.col("h") == END, 0).otherwise(F.coalesce("own", hashed))
    sums = (
        known.join(F.broadcast(names), "h", "left").groupBy(label.alias("label"))
        .agg(F.sum("c").alias("c"), F.count("*").alias("v")).collect()
    )
    tokens, types = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in sums:
        tokens[r.label], types[r.label] = r.c, r.v
    return Counts(int(tokens.sum()), int(types.sum()), own, tokens, types)


def annotate(encoded: DataFrame, vocabulary: DataFrame, counts: Counts) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, base, inner, classes): base score, the log share of
    words in their classes, and the class sequence with its end."""
    entries = encoded.where("kind = 1").select("chunk", "lid", "h").join(vocabulary, "h")
    rows = encoded.where("kind = 0").select("chunk", "doc_id", "held_out", "ids")

    def join(docs: pa.Table, entries: pa.Table) -> pa.Table:
        lid = entries.column("lid").to_numpy()
        h, c = np.empty(len(lid), np.int64), np.empty(len(lid))
        h[lid], c[lid] = entries.column("h").to_numpy(), entries.column("c").to_numpy()
        label = counts.classes_of(h)
        base = np.log10((c + 0.1) / (counts.tokens + 0.1 * (counts.types + 1)))
        inner = np.log10((c + 0.1) / (counts.class_tokens[label] + 0.1 * (counts.class_types[label] + 1)))
        last = int(np.flatnonzero(h == END)[0])
        out = {k: [] for k in ("n_tokens", "n_known", "base", "inner", "classes")}
        for raw in docs.column("ids"):
            ids = np.append(unpack(raw.as_py()), last)
            out["n_tokens"].append(len(ids))
            out["n_known"].append(int((c[ids] > 0).sum()))
            out["base"].append(float(base[ids].sum()))
            out["inner"].append(float(inner[ids].sum()))
            out["classes"].append(pack(label[ids]))
        kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary())
        return pa.table(
            [docs.column("doc_id"), docs.column("held_out"), *(pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True))],
            names=["doc_id", "held_out", *out],
        )

    return (
        rows.groupBy("chunk")
        .cogroup(entries.select(F.col("chunk").alias("of"), "lid", "h", "c").groupBy("of"))
        .applyInArrow(
            join,
            "doc_id long, held_out boolean, n_tokens long, n_known long, base double, inner double, classes binary",
        )
    )


@dataclass(frozen=True)
class Model:
    start: np.ndarray  # states
    move: np.ndarray  # states x states
    emit: np.ndarray  # classes x states


def first_model(counts: Counts, seed: int = 11) -> Model:
    """Class frequencies, disturbed differently for each state, and states that mostly last: what
    lasts in texts (their language, their manner) is what states come to stand for."""
    rng = np.random.default_rng(seed)
    prior = (counts.class_tokens + PSEUDO) / (counts.class_tokens + PSEUDO).sum()
    emit = prior[:, None] * np.exp(rng.standard_normal((CLASSES, STATES)))
    move = rng.uniform(0.5, 1.5, (STATES, STATES)) + 10 * STATES * np.eye(STATES)
    return Model(np.full(STATES, 1 / STATES), move / move.sum(1, keepdims=True), emit / emit.sum(0))


class Lattice:
    """Sequences side by side, longest first, by time: the tokens of time t are
    ``at[t]:at[t + 1]``, those of one sequence at the same place of each."""

    def __init__(self, sequences: list[np.ndarray]) -> None:
        lengths = np.array([len(s) for s in sequences])
        self.order = np.argsort(-lengths, kind="stable")
        lengths = lengths[self.order]
        width = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")
        self.at = np.concatenate([[0], np.cumsum(width)])
        self.lengths = lengths
        self.tokens = np.empty(self.at[-1], np.int64)
        for i, j in enumerate(self.order):
            self.tokens[self.at[: lengths[i]] + i] = sequences[j]

    def forward(self, model: Model, keep: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
        """Scales of all tokens (their product is the likelihood) and, if kept, the scaled alphas."""
        scales = np.empty(self.at[-1])
        alphas = np.empty((self.at[-1], STATES)) if keep else None
        alpha = None
        for a, b in zip(self.at[:-1], self.at[1:], strict=True):
            ahead = model.start if alpha is None else alpha[: b - a] @ model.move
            alpha = ahead * model.emit[self.tokens[a:b]]
            scale = alpha.sum(1)
            alpha /= scale[:, None]
            scales[a:b] = scale
            if keep:
                alphas[a:b] = alpha
        return scales, alphas

    def log10_likelihoods(self, model: Model) -> np.ndarray:
        logs = np.log10(self.forward(model)[0])
        owner = np.concatenate([np.arange(b - a) for a, b in zip(self.at[:-1], self.at[1:], strict=True)])
        out = np.empty(len(self.order))
        out[self.order] = np.bincount(owner, logs, len(self.order))
        return out

    def expected_counts(self, model: Model) -> np.ndarray:
        """Expected starts, moves and emissions, in one array."""
        scales, alphas = self.forward(model, keep=True)
        betas = np.ones((self.at[-1], STATES))
        onward = model.emit[self.tokens] / scales[:, None]
        for t in range(len(self.at) - 2, 0, -1):
            a, b = self.at[t], self.at[t + 1]
            betas[self.at[t - 1] : self.at[t - 1] + b - a] = (betas[a:b] * onward[a:b]) @ model.move.T
        gamma = alphas * betas
        first = self.at[1]
        width = np.diff(self.at)
        before = np.arange(first, self.at[-1]) - np.repeat(width[:-1], width[1:])
        moves = model.move * (alphas[before].T @ (betas[first:] * onward[first:]))
        emits = [np.bincount(self.tokens, gamma[:, k], CLASSES) for k in range(STATES)]
        return np.concatenate([gamma[:first].sum(0), moves.ravel(), np.array(emits).T.ravel()])


def grouped(sequences: Iterator[np.ndarray]) -> Iterator[list[np.ndarray]]:
    out, size = [], 0
    for s in sequences:
        out.append(s)
        size += len(s)
        if size >= STEP_TOKENS:
            yield out
            out, size = [], 0
    if out:
        yield out


def baum_welch(sequences: DataFrame, model: Model) -> Model:
    """One round over all training sequences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts() -> Iterator[np.ndarray]:
            for batch in batches:
                for raw in batch.column("classes"):
                    whole = unpack(raw.as_py())
                    for i in range(0, len(whole), SEGMENT):
                        yield whole[i : i + SEGMENT]

        total = None
        for group in grouped(parts()):
            new = Lattice(group).expected_counts(model)
            total = new if total is None else total + new
        if total is not None:
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], names=["i", "x"])

    sums = (
        sequences.where("not held_out").select("classes").mapInArrow(run, "i long, x double")
        .groupBy("i").agg(F.sum("x").alias("x")).orderBy("i").toPandas()
    )
    total = np.zeros(STATES + STATES**2 + CLASSES * STATES)
    total[sums["i"].to_numpy(np.int64)] = sums["x"].to_numpy(float)
    start = total[:STATES] + PSEUDO
    move = total[STATES : STATES + STATES**2].reshape(STATES, STATES) + PSEUDO
    emit = total[STATES + STATES**2 :].reshape(CLASSES, STATES) + PSEUDO
    return Model(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))


def score_texts(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Base and model scores of each row of ``docs`` (doc_id, text), learnt from its training fold."""
    encoded = stored(encode(docs), "op1-encoded")
    vocabulary = stored(
        encoded.where("kind = 1").groupBy("h").agg(F.sum("n").alias("c")), "op1-vocabulary"
    )
    counts = corpus_counts(vocabulary)
    sequences = stored(annotate(encoded, vocabulary, counts), "op1-sequences")
    model = first_model(counts)
    for _ in range(rounds if counts.tokens else 0):
        model = baum_welch(sequences, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                lattice = Lattice([unpack(raw.as_py()) for raw in batch.column("classes")])
                inner = batch.column("inner").to_numpy()
                score = pa.array(inner + lattice.log10_likelihoods(model))
                names = ["doc_id", "held_out", "n_tokens", "n_known", "base_score"]
                kept = [batch.column(c) for c in ("doc_id", "held_out", "n_tokens", "n_known", "base")]
                yield pa.RecordBatch.from_arrays([*kept, score], names=[*names, "score"])

    scored = sequences.select("doc_id", "held_out", "n_tokens", "n_known", "base", "inner", "classes").mapInArrow(
        run, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    )
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known",
        F.lit(counts.tokens).cast("long").alias("train_tokens"), "base_score", "score",
    )
