"""Trained operators: their parts against plain definitions, their results on held-out rows."""

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from mailfacts.llm import quality, toxicity

FOLDER = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def tables(spark):
    return [spark.read.parquet(f"{FOLDER}/{n}.parquet") for n in ("documents", "labels")]


def plain_statistics(text):
    t = text or ""
    w, lines, chars = WORD.findall(t), t.split("\n"), len(t)
    n, c = max(len(w), 1), max(chars, 1)
    return [
        float(len(w)),
        (chars - len(w) + 1) / n,
        len(re.findall(r"[#*$%&|<>]", t)) / n,
        len(re.findall("[A-Z]", t)) / c,
        len(re.findall("[0-9]", t)) / c,
        len(re.findall("[.,;:?]", t)) / n,
        t.count("!") / n,
        len(lines) / n,
        len(set(w)) / n,
        len({tuple(w[i : i + 3]) for i in range(len(w))}) / n,
        len(set(lines)) / max(len(lines), 1),
    ]


def test_statistics(edge):
    rows = quality.with_statistics(edge, "doc_id", "text").collect()
    assert len(rows) == 11
    for r in rows:
        assert [r[n] for n in quality.NAMES] == pytest.approx(plain_statistics(r.text))


def test_rules_are_paths_and_columns_score_alike(spark):
    rng = np.random.default_rng(1)
    x = rng.random((3000, len(quality.NAMES)))
    y = ((x[:, 2] > 0.7) | ((x[:, 9] < 0.3) & (x[:, 0] > 0.5))).astype(float)
    model = quality.fit(x, y)
    assert 0 < len(model.rules) < len(quality.grow_rules(x, y))
    assert ((model.score(x) >= 0.5) == y).mean() > 0.97
    df = spark.createDataFrame(x[:200].tolist(), list(quality.NAMES)).select(model.column().alias("s"))
    assert [r.s for r in df.collect()] == pytest.approx(model.score(x[:200]).tolist())


def test_quality_on_held_out_rows(tables):
    docs, labels = tables
    scored = quality.score_quality(docs, quality.train(docs, labels))
    rows = scored.join(labels, "doc_id").where("held_out").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in rows)
    assert sum(r.predicted == r.quality for r in rows) > 0.95 * len(rows)
    assert scored.count() == docs.count()


def test_quality_edges(edge, clashing, spark):
    labels = spark.createDataFrame([(4, 1, 0), (4, 0, 0), (6, 0, 0), (None, 1, 1), (9, None, None)], "doc_id long, quality int, toxic int")
    for given in (labels, labels.limit(0), labels.where("quality = 1")):
        model = quality.train(clashing, given)
        got = quality.score_quality(clashing, model).collect()
        assert len(got) == 11 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    kept = quality.keep_good(clashing, quality.RuleEnsemble(2.0, ((((0, True, 20_000.0),), -9.0),)))
    assert kept.columns == clashing.columns and Counter(r.doc_id for r in kept.collect()) == Counter({1: 1, 2: 1, 3: 1, 4: 1, 5: 2, None: 1, 7: 1, 8: 1, 9: 1})
    assert quality.score_quality(edge.limit(0), model).count() == 0


# --- Toxicity -----------------------------------------------------------------------------------


def test_windows_cover_every_text():
    text = toxicity.Text(pa.array(["", "a", " ".join(f"w{i}" for i in range(20)), " ".join(f"v{i}" for i in range(47))]))
    assert np.bincount(text.doc).tolist() == [1, 1, 1, 4]
    inside = [set(text.windows[text.doc == d].ravel().tolist()) - {-1} for d in range(4)]
    assert [len(s) for s in inside] == [0, 1, 20, 47]
    last = text.windows[-1]
    assert (last >= 0).sum() == 17


def test_gradients_equal_differences():
    text = toxicity.Text(pa.array(["you are a fool and a clown today my friend", "what a fine day", ""]))
    p = {k: v.astype(np.float64) for k, v in toxicity.initial().items()}
    p["word"] += 0.3 * np.random.default_rng(0).standard_normal(p["word"].shape)
    d = np.array([0.7, -0.4, 0.2])

    def value():
        inputs = np.hstack([p["word"][text.rows], np.add.reduceat(p["triple"][text.triples], np.searchsorted(text.owner, np.arange(len(text.rows)))) / text.count[:, None]])
        return (d * toxicity.forward(p, inputs, text.windows)[0]).sum(), inputs

    text.inputs(p)
    _, inputs = value()
    _, cached = toxicity.forward(p, inputs, text.windows, keep=True)
    g = toxicity.backward(p, text, inputs, text.windows, cached, d)
    rng = np.random.default_rng(1)
    for k in p:
        at = np.flatnonzero(g[k].ravel()) if k in ("word", "triple") else np.arange(p[k].size)
        for i in rng.choice(at, min(4, len(at)), replace=False):
            index = np.unravel_index(i, p[k].shape)
            old = p[k][index]
            p[k][index] = old + 1e-3
            up = value()[0]
            p[k][index] = old - 1e-3
            down = value()[0]
            p[k][index] = old
            assert g[k][index] == pytest.approx((up - down) / 2e-3, rel=0.02, abs=2e-4), k


@pytest.fixture(scope="module")
def toxic_model():
    rng = np.random.default_rng(2)
    texts, y = [], []
    for i in range(400):
        words = [f"w{k}" for k in rng.integers(0, 300, rng.integers(15, 120))]
        if i % 4 == 0:
            for _ in range(3):
                words[rng.integers(len(words))] = f"grub{rng.choice(['ling', 'bert', 'ard', 'est'])}"
        texts.append(" ".join(words))
        y.append(int(i % 4 == 0))
    return toxicity.train(texts, np.array(y), np.ones(len(y)))


def test_network_finds_words_and_unseen_forms(documents, toxic_model):
    clean = " ".join(f"w{k}" for k in range(200))
    rows = [(1, clean), (2, clean + " grubling grubard " + clean), (3, clean + " grubbish grubish grubber " + clean), (4, "w1")]
    got = {r.doc_id: r for r in toxicity.score_toxicity(documents(rows), toxic_model).collect()}
    assert got[2].predicted == 1 and got[1].predicted == 0 and got[4].predicted == 0
    assert got[3].score > got[1].score


def test_toxicity_edges(edge, clashing, spark, toxic_model):
    got = toxicity.score_toxicity(clashing, toxic_model).collect()
    assert len(got) == 11 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 2, 3)}) == 1
    assert toxicity.score_toxicity(edge.limit(0), toxic_model).count() == 0
    labels = spark.createDataFrame([(4, 1, 0)], "doc_id long, quality int, toxic int")
    for given in (labels, labels.limit(0)):
        assert toxicity.fit(edge, given) is None
    assert {r.score for r in toxicity.score_toxicity(edge, None).collect()} == {0.0}


def test_toxicity_trains_outside_the_held_out_fold(tables):
    docs, labels = tables
    chosen = quality.labelled_sample(docs, labels, "toxic", toxicity.fold("doc_id", 5) != 0, 50)
    ids = [r.doc_id for r in chosen.select("doc_id").collect()]
    assert len(ids) == 50 and all(zlib.crc32(str(i).encode()) % 5 for i in ids)
    assert chosen.agg(F.countDistinct("doc_id")).first()[0] == 50
