"""Operators over many texts, against plain definitions on small tables."""

import itertools
import random
import re
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from mailfacts.llm import contamination, hmm, mixing, neardup
from mailfacts.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


# --- Near duplicates ----------------------------------------------------------------------------


def shingles(text):
    ws = WORD.findall(lowered(text))
    return {tuple(ws[i : i + 5]) for i in range(max(1, len(ws) - 4))} if ws else set()


def plain_near(rows):
    """(doc_id, n_shingles, component) of rows with distinct ids."""
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= 75 * len(x | y):
            ra, rb = sorted((root(a), root(b)))
            parent[rb] = ra
    return Counter((i, len(s), root(i), i == root(i)) for i, s in sets.items())


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates_equal_all_pairs(documents, prose, seed):
    rows = list(enumerate(prose(250, seed, length=(1, 90))))
    got = neardup.near_duplicates(documents(rows)).collect()
    assert Counter(tuple(r) for r in got) == plain_near(rows)


def test_near_copies_of_one_text_around_the_threshold(documents):
    """A text and copies with one to twelve changed words, many of them linked with few others."""
    rng = random.Random(5)
    base = [f"b{i}" for i in range(150)]
    rows = [(1000, " ".join(base))]
    for i in range(150):
        copy = list(base)
        for _ in range(rng.randint(1, 12)):
            copy[rng.randrange(150)] = f"x{rng.randrange(400)}"
        if rng.random() < 0.2:
            copy = copy[: rng.randint(90, 149)]
        rows.append((i, " ".join(copy)))
    got = neardup.near_duplicates(documents(rows)).collect()
    assert Counter(tuple(r) for r in got) == plain_near(rows)


def test_near_duplicates_edge(edge, clashing):
    got = Counter(tuple(r) for r in neardup.near_duplicates(edge).collect())
    plain = plain_near([(r.doc_id, r.text) for r in edge.where("doc_id is not null").dropDuplicates(["doc_id"]).collect()])
    assert {k for k in got if k[0] is not None} == set(plain) and sum(got.values()) == 11
    assert [(k[2], k[3]) for k in got if k[0] is None] == [(None, True)]
    kept = neardup.drop_near_duplicates(clashing)
    assert kept.columns == clashing.columns
    assert neardup.near_duplicates(edge.limit(0)).count() == 0


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 5001 + i) for i in range(50)]
    parent = {}

    def root(i):
        parent.setdefault(i, i)
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        ra, rb = sorted((root(a), root(b)))
        parent[rb] = ra
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    loops = {a for a, b in edges if a == b} - {x for a, b in edges if a != b for x in (a, b)}
    assert got == {i: root(i) for i in parent if i not in loops}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- Contamination ------------------------------------------------------------------------------


def plain_contamination(docs, items, window=10):
    windows = {}
    for item, text in items:
        ws = tuple(PLAIN.findall(lowered(text)))
        k = min(len(ws), window)
        for i in range(len(ws) - k + 1) if ws else ():
            windows.setdefault(ws[i : i + k], set()).add(item)
    out = Counter()
    for doc, text in docs:
        ws = PLAIN.findall(lowered(text))
        hit, found = set(), set()
        for i in range(len(ws)):
            for k in range(1, window + 1):
                if tuple(ws[i : i + k]) in windows and i + k <= len(ws):
                    hit |= set(range(i, i + k))
                    found |= windows[tuple(ws[i : i + k])]
        names = sorted(str(x) for x in found if x is not None)
        out[(doc, len(ws), len(hit), len(names), sha256(",".join(names).encode()).hexdigest(), bool(hit))] += 1
    return out


def test_contamination_equals_definition(spark, documents, prose, edge):
    rng = random.Random(2)
    items = [(i, t) for i, t in enumerate(prose(25, 4, 60, (1, 40)))]
    items += [(90, "A b, c!"), (91, "one"), (92, None), (93, "--"), (90, "a b c d e f g h i j k"), (None, "w1 w2 w3"), (94, items[0][1])]
    docs = []
    for i, t in enumerate(prose(60, 9, 60, (0, 80))):
        ws = t.split()
        if rng.random() < 0.5:
            source = (rng.choice(items)[1] or "").split()
            ws[len(ws) // 2 : len(ws) // 2] = source[rng.randrange(len(source) + 1) // 3 :]
        docs.append((i, " ".join(ws)))
    docs += [tuple(r) for r in edge.select("doc_id", "text").collect()]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = Counter(tuple(r) for r in contamination.find_contamination(documents(docs), benchmark).collect())
    assert got == plain_contamination(docs, items)


def test_contamination_filter(spark, clashing):
    benchmark = spark.createDataFrame([(1, "b c d e f g h i j k l")], "item_id long, text string")
    kept = contamination.drop_contaminated(clashing, benchmark)
    assert kept.columns == clashing.columns
    assert {r.doc_id for r in kept.collect()} == {1, 2, 3, 4, None, 6, 7, 8}
    assert contamination.find_contamination(clashing.limit(0), benchmark).count() == 0
    assert contamination.drop_contaminated(clashing, benchmark.limit(0)).count() == 11


def test_contamination_stays_in_dataframe_operations(spark, edge):
    benchmark = spark.createDataFrame([(1, "b c d e f g h i j k l")], "item_id long, text string")
    plan = contamination.find_contamination(edge, benchmark)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# --- Mixing -------------------------------------------------------------------------------------


def plain_targets(words_by_source):
    """Sources by code point, null last; weights 5, 2, 1 in turn; at most three times the size."""
    order = sorted(words_by_source, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, free, left = {}, set(order), float(sum(words_by_source.values()))
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 3 * words_by_source[s]}
        if not over:
            target |= {s: level * weight[s] for s in free}
            break
        for s in over:
            target[s] = 3.0 * words_by_source[s]
            left -= target[s]
        free -= over
    return target


def test_mix(documents, prose, edge):
    rng = random.Random(1)
    sources = ["hot"] * 6 + ["a", "b", "c", "É", "\U0001f600", None, "tiny"]
    rows = [(i, t, None, rng.choice(sources[:-1])) for i, t in enumerate(prose(600, 3))] + [(9000, "three words here", None, "tiny")]
    rows += [tuple(r)[:4] for r in edge.collect() if r.doc_id != 6]
    df = documents(rows).repartition(7)
    got = mixing.mix(df).collect()
    size = {s: sum(len(WORD.findall(r[1] or "")) for r in rows if r[3] == s) for s in {r[3] for r in rows}}
    target = plain_targets(size)
    assert Counter((r.doc_id, r.size, r.source) for r in got) == Counter((r[0], len(WORD.findall(r[1] or "")), r[3]) for r in rows)
    taken = Counter()
    for r in got:
        assert r.source_size == size[r.source] and r.target == pytest.approx(target[r.source])
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    for s, t in target.items():
        assert abs(taken[s] - t) <= max(5, 0.02 * t)
    again = mixing.mix(documents(rows[::-1]).repartition(3)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))
    pieces = mixing.mixture(df).groupBy("doc_id", "source").agg(F.sum("words").alias("n")).collect()
    by_doc = Counter()
    for r in got:
        by_doc[(r.doc_id, r.source)] += r.taken
    assert {(r.doc_id, r.source): r.n for r in pieces} == {k: v for k, v in by_doc.items() if v}


def test_schedule_is_even_at_every_length(spark):
    """After any number of slots each source has about its share: low discrepancy."""
    sizes = spark.createDataFrame([(i, s, f"s{s}", n) for i, (s, n) in enumerate([("a", 9000), ("b", 4000), ("c", 2000)])], "doc_id long, source string, key string, size long")
    sources = mixing.source_targets(sizes)
    share = {r.key: r.share for r in sources.collect()}
    total, seen = sum(share.values()), Counter()
    for n, r in enumerate(mixing.schedule(sources).orderBy("slot").collect(), 1):
        seen[r.key] += 1
        assert r["rank"] == seen[r.key] - 1
        assert all(abs(seen[k] - n * v / total) < 6 for k, v in share.items())


@pytest.mark.parametrize("rows", [[], [(1, None, None, "a")], [(1, "", None, None), (2, " ", None, "b")]])
def test_mix_without_words(documents, rows):
    assert [(r.size, r.target, r.taken) for r in mixing.mix(documents(rows)).collect()] == [(0, 0.0, 0)] * len(rows)


# --- Language model -----------------------------------------------------------------------------


def small_model(seed=0):
    rng = np.random.default_rng(seed)
    k, c = hmm.STATES, hmm.CLASSES
    move, emit, start = rng.random((k, k)), rng.random((c, k)), rng.random(k)
    return hmm.Model(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))


def test_forward_and_counts_equal_path_sums(monkeypatch):
    monkeypatch.setattr(hmm, "STATES", 3)
    monkeypatch.setattr(hmm, "CLASSES", 4)
    model, sequences = small_model(), [np.array(s) for s in ([0], [1, 2, 0], [3, 3, 1, 2, 0], [2, 0])]
    lattice = hmm.Lattice(sequences)
    starts, moves, emits, logs = np.zeros(3), np.zeros((3, 3)), np.zeros((4, 3)), []
    for s in sequences:
        paths = list(itertools.product(range(3), repeat=len(s)))
        p = [model.start[z[0]] * np.prod([model.emit[x, k] for x, k in zip(s, z)]) * np.prod([model.move[a, b] for a, b in itertools.pairwise(z)]) for z in paths]
        logs.append(np.log10(sum(p)))
        for z, w in zip(paths, np.array(p) / sum(p)):
            starts[z[0]] += w
            for a, b in itertools.pairwise(z):
                moves[a, b] += w
            for x, k in zip(s, z):
                emits[x, k] += w
    assert np.allclose(lattice.log10_likelihoods(model), logs)
    assert np.allclose(lattice.expected_counts(model), np.concatenate([starts, moves.ravel(), emits.ravel()]))


def test_pack():
    for ids in ([], [0], [1, 70_000, 2**31]):
        assert hmm.unpack(hmm.pack(np.array(ids, np.int64))).tolist() == ids


def test_base_scores_and_model(documents, prose, edge):
    import zlib

    rows = [tuple(r)[:2] for r in edge.collect()] + [(100 + i, t.upper() if i % 2 else t) for i, t in enumerate(prose(120, 8, 30))]
    got = hmm.score_texts(documents(rows)).collect()
    held = {i: i is None or zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows}
    tokens = {(i, t): [*WORD.findall(lowered(t)), None] for i, t in rows}
    counts = Counter(x for i, t in rows if not held[i] for x in tokens[(i, t)])
    n, v = sum(counts.values()), len(counts)
    expected = Counter()
    for i, t in rows:
        base = sum(np.log10((counts[x] + 0.1) / (n + 0.1 * (v + 1))) for x in tokens[(i, t)])
        known = sum(counts[x] > 0 for x in tokens[(i, t)])
        expected[(i, held[i], len(tokens[(i, t)]), known, n, round(base, 6))] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == expected
    assert all(np.isfinite(r.score) and r.score <= 0 for r in got)
    assert hmm.score_texts(documents([])).count() == 0


def test_training_raises_the_likelihood(documents):
    """Two manners of writing that do not mix: states tell them apart."""
    rng = random.Random(4)
    manners = [[f"a{i}" for i in range(20)], [f"b{i}" for i in range(20)]]
    rows = [(i, " ".join(rng.choices(manners[i % 2], k=40))) for i in range(120)]
    got = hmm.score_texts(documents(rows)).where("held_out").collect()
    assert sum(r.score for r in got) > 0.9 * sum(r.base_score for r in got)
    assert sum(r.score for r in got) > sum(r.base_score for r in got)
