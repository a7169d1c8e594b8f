"""Periodic runs, spelling variants and byte pairs against plain definitions."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from mailfacts.llm import bpe, queries, runs, spelling

FOLDER = "/root/testdata/sf0.001"
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
EMPTY = "doc_id long, text string"


# --- Periodic runs ------------------------------------------------------------------------------


def plain_runs(words):
    """For every period the stretches of words equal to those a period on, smallest period first."""
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            length = i + q - start
            if i > start and length >= max(6, 4 * q):
                found.setdefault((start, length), q)
            i = max(i, start + 1)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_collapsed(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def periodic_texts(count, seed):
    rng = random.Random(seed)
    for _ in range(count):
        letters = rng.choice([1, 2, 3, 40])
        words = [f"w{rng.randrange(letters)}" for _ in range(rng.randint(0, 70))]
        for _ in range(rng.randint(0, 3)):
            if words:
                at, period = rng.randrange(len(words)), rng.randint(1, 7)
                words[at:at] = words[at : at + period] * rng.randint(2, 6)
        yield " ".join(words)


def test_runs_equal_plain_ones():
    texts = list(periodic_texts(1500, 3))
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["doc_id", "text"]
    )
    total = 0
    for text, row in zip(texts, runs.scan(batch).to_pylist(), strict=True):
        expected = plain_runs(text.split())
        assert [tuple(r.values()) for r in row["runs"]] == expected
        assert row["collapsed"] == plain_collapsed(text.split(), expected)
        total += len(expected)
    assert total > 1000


def test_runs_of_hostile_texts():
    """Long texts of one word, of one phrase in ever new contexts, and random ones stay fast."""
    rng = random.Random(1)
    texts = [
        "a " * 100_000,
        " ".join(f"n{i} v w x y z" for i in range(20_000)),
        " ".join(rng.choice("ab") for _ in range(50_000)),
    ]
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3]), pa.array(texts)], names=["doc_id", "text"])
    one, phrase, _ = runs.scan(batch).to_pylist()
    assert [tuple(r.values()) for r in one["runs"]] == [(0, 100_000, 1)]
    assert phrase["runs"] == []


def test_runs_edges(edge, clashing, spark):
    found = runs.periodic_runs(edge)
    rows = Counter((r.doc_id, r.n_words, len(r.runs), r.collapsed) for r in found.collect())
    assert rows[(1, 0, 0, "")] == rows[(2, 0, 0, "")] == rows[(3, 0, 0, "")] == 1
    assert rows[(5, 16, 0, "A b C d e F g h i j k l m n o p")] == 2
    assert rows[(6, 30_000, 1, "word")] == 1
    assert rows[(9, 32, 0, " ".join("abcdefghijklmnop" * 2))] == 1
    again = runs.periodic_runs(clashing)
    assert Counter(map(str, again.collect())) == Counter(map(str, found.collect()))
    assert runs.periodic_runs(spark.createDataFrame([], EMPTY)).count() == 0


def test_op11_query(spark):
    got = {r.doc_id: tuple(r) for r in queries.op11_periodic_runs(spark, FOLDER).collect()}
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    assert len(got) == len(docs)
    for doc in docs:
        words, h = SPACED.findall(doc.text or ""), zlib.crc32(str(doc.doc_id).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
        found = plain_runs(words)
        best = (None,) * 4
        if found:
            s, length, q = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))
            best = (s, length, q, 1000 * length // q)
        listed = "".join(f"{s},{length},{q}\n" for s, length, q in found)
        digests = (hashlib.sha256(t.encode()).hexdigest() for t in (listed, plain_collapsed(words, found)))
        assert got[doc.doc_id] == (doc.doc_id, len(found), *best, *digests)


# --- Spelling variants --------------------------------------------------------------------------


def plain_variants(texts):
    """Forms by trying out all deletions: (form, root, n, n_near, form_n) by word."""
    counts = Counter()
    for doc_id, text in texts:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{doc_id}:{word}".encode())
            if doc_id is not None and h % 31 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    known = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    near, holes = defaultdict(set), defaultdict(set)
    for w in known:
        for i in range(len(w)):
            shorter = w[:i] + w[i + 1 :]
            holes[i, shorter].add(w)
            if shorter in known:
                near[w].add(shorter)
                near[shorter].add(w)
    for group in holes.values():
        for w in group:
            near[w] |= group - {w}
    form = {}
    for w, n in known.items():
        best = min(near[w], key=lambda x: (-known[x], x), default=None)
        form[w] = best if best and known[best] >= 10 * n else None
    out = {}
    for w, n in known.items():
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), known.get(form[w]))
    return out


def variants(words):
    return {
        r.word: (r.form, r.root, r.n, r.n_near, r.form_n)
        for r in spelling.spelling_variants(words).collect()
    }


def misspelt(count, seed):
    """Texts of few words with one or two random edits each, in an alphabet that makes many meet."""
    rng = random.Random(seed)
    letters = "abcdefghé"
    base = ["".join(rng.choices(letters, k=rng.randint(6, 10))) for _ in range(40)]
    for i in range(count):
        words = []
        for _ in range(60):
            w = base[min(int(rng.expovariate(0.12)), 39)]
            for _ in range(rng.choice([0, 0, 0, 0, 1, 1, 2])):
                at = rng.randrange(len(w))
                w = w[:at] + rng.choice(["", rng.choice(letters), w[at] + rng.choice(letters)]) + w[at + 1 :]
            words.append(w.title() if rng.random() < 0.1 else w)
        yield (i, " ".join(words))


@pytest.mark.parametrize("block", [5, 2_000])
def test_variants_equal_plain_ones(documents, monkeypatch, block):
    """Also where nearly every group is cut into blocks."""
    monkeypatch.setattr(spelling, "BLOCK", block)
    chain = "quietword " * 300 + "quietwore " * 25 + "quietwoe " * 2
    texts = [*misspelt(120, 7), (1000, chain)]
    expected = plain_variants(texts)
    assert sum(v[3] for v in expected.values()) > 500
    assert any(v[1] not in (w, v[0]) for w, v in expected.items()), "a chain of forms"
    assert variants(spelling.words_with_typos(documents(texts), 31)) == expected


def test_equally_frequent_near_words(spark):
    counts = {"zzabcdefg": 20, "abcdefgzz": 1, "abcdefga": 30, "abcdefgb": 30, "abcdefgc": 2, "éabcdefgc": 3}
    rows = [(w,) for w, n in counts.items() for _ in range(n)]
    found = variants(spark.createDataFrame(rows, "word string"))
    assert found["abcdefgc"] == ("abcdefga", "abcdefga", 2, 3, 30)
    assert found["abcdefga"] == (None, "abcdefga", 30, 2, None)
    assert found["éabcdefgc"] == (None, "éabcdefgc", 3, 1, None)
    assert "abcdefgzz" not in found


def test_variants_edges(edge, clashing, spark):
    rows = [(1, "Exämples exämples"), (None, "exämples éXÄMPLES"), (2, None), (3, "")]
    rows = spark.createDataFrame(rows, EMPTY)
    found = variants(spelling.words_with_typos(rows, 31))
    assert found == plain_variants([tuple(r) for r in rows.collect()])
    texts = [(r.doc_id, r.text) for r in edge.collect()]
    assert variants(spelling.words_with_typos(edge, 31)) == plain_variants(texts)
    assert variants(spelling.words_with_typos(clashing, 31)) == plain_variants(texts)
    assert variants(spelling.words_with_typos(spark.createDataFrame([], EMPTY), 31)) == {}


def test_op12_query(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    expected = plain_variants([(r.doc_id, r.text) for r in docs.collect()])
    found = queries.op12_spelling_variants(spark, FOLDER)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert {r.word: tuple(r)[1:] for r in found.collect()} == expected


# --- Byte pairs ---------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    import tiktoken

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    vocabulary = bpe.Vocabulary.read(path, public_tokenizers.PATTERN)
    plain = tiktoken.Encoding(
        "plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={}
    )
    return vocabulary, plain


def coded(df, vocabulary, frequent):
    ids = F.col("ids")
    return bpe.encode(df, vocabulary, frequent).select(
        "doc_id", "ids", bpe.decode(ids, vocabulary).alias("back"), bpe.packed(ids, vocabulary).alias("packed")
    )


@pytest.mark.parametrize("frequent", [0, 20])
def test_byte_pairs_equal_tiktoken(spark, tokenizer, monkeypatch, frequent):
    """Random texts of several scripts, long words by both kinds of steps, and the way back."""
    vocabulary, plain = tokenizer
    monkeypatch.setattr(bpe, "LONG_WORD", 40)
    rng = random.Random(2)
    alphabets = ["abcdefghij", "théeandoinre", "  \n\t  x1٣", "漢字かな😀ß'sll", "!?.,#$ a", "ab"]
    texts = [
        "", "x" * 2_000, " " * 700 + "a", "the " * 300, "it's they'll 123 45a\u0085b\u001cz  y",
        "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(300)),
    ]
    for _ in range(250):
        letters = rng.choice(alphabets) + rng.choice(["", *alphabets])
        texts.append("".join(rng.choices(letters, k=rng.randint(0, 110))))
    df = spark.createDataFrame(list(enumerate(texts)), EMPTY).repartition(8)
    for row in coded(df, vocabulary, frequent).collect():
        text = texts[row.doc_id]
        assert row.ids == plain.encode_ordinary(text)
        assert bytes(row.back) == text.encode()
        assert bytes(row.packed) == b"".join(i.to_bytes(4, "little") for i in row.ids)


def test_merges_that_bring_up_a_lower_rank(spark):
    """Merging all places of a rank at once would pass over a pair that comes up in between."""
    ranks = {bytes([i]): 300 + i for i in range(256)}
    ranks |= {b"ab": 20, b"abab": 5, b"aba": 4, b"bab": 30}
    import tiktoken

    vocabulary = bpe.Vocabulary(ranks, r"\S+|\s+")
    plain = tiktoken.Encoding("p", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={})
    for text in ("ab" * 700, "abb" * 400 + "abab" * 100, "bab" * 500):
        df = spark.createDataFrame([(1, text)], EMPTY)
        (row,) = bpe.encode(df, vocabulary, 0).collect()
        assert row.ids == plain.encode_ordinary(text)


def test_large_constants_are_not_spelled_out(spark, tokenizer):
    """The driver keeps the plans of all queries: one must not hold a map's entries, nor rows a map."""
    vocabulary, _ = tokenizer
    df = bpe.encode(spark.createDataFrame([(1, "a text"), (2, "a text")], EMPTY), vocabulary)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert len(plan) < 100_000
    assert not any(f"AS {name}#" in plan for name in ("words", "ranks", "starts"))


def test_frequent_words_are_bounded(spark):
    counted = spark.createDataFrame([("a", 5), ("b", 4), ("c", 4), ("d" * 100, 2)], "word string, count long")
    assert [bpe.least_count(counted, n) for n in (1, 2, 3, 4)] == [5, 5, 4, 2]
    assert bpe.least_count(counted.where("count = 4"), 1) is None
    assert bpe.least_count(counted.where("count = 2"), 1) is None


def test_frequent_words_are_bounded_together(spark, monkeypatch):
    counted = spark.createDataFrame([("a" * 9, 5), ("b" * 9, 4), ("c" * 9, 3)], "word string, count long")
    assert bpe.least_count(counted, 3) == 3
    monkeypatch.setattr(bpe, "FREQUENT_TOTAL", 20)
    assert bpe.least_count(counted, 3) == 4


def test_words_are_put_together_in_tasks(spark, monkeypatch):
    """The constant of words holds each of them, over many groups, and comes from rows that Spark holds."""
    monkeypatch.setattr(bpe, "PER_GROUP", 16)
    ids = F.array(F.col("id").cast("int")).alias("ids")
    entries = spark.range(2_000).select(F.concat(F.lit("w"), "id").alias("word"), ids)
    ready = bpe.Words(entries)
    rows = spark.range(2_500).select(F.concat(F.lit("w"), "id").alias("word"), ready.table.alias("words"))
    found = rows.select("word", bpe._let(F.col("words"), lambda t: ready.within(t)(F.col("word"))).alias("ids"))
    assert {r.word: r.ids for r in found.collect()} == {f"w{i}": [i] if i < 2_000 else None for i in range(2_500)}


def test_byte_pairs_edges(spark, tokenizer, clashing):
    vocabulary, plain = tokenizer
    texts = [(r.doc_id, r.text) for r in clashing.where("doc_id is null or doc_id not in (6, 8)").collect()]
    rows = clashing.where("doc_id is null or doc_id not in (6, 8)")
    found = Counter((r.doc_id, tuple(r.ids)) for r in bpe.encode(rows, vocabulary, 5).collect())
    assert found == Counter((i, tuple(plain.encode_ordinary(t or ""))) for i, t in texts)
    assert bpe.encode(spark.createDataFrame([], EMPTY), vocabulary, 5).count() == 0


def test_op13_query(spark, tokenizer):
    _, plain = tokenizer
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = queries.op13_byte_pairs(spark, FOLDER).collect()
    assert len(rows) == len(docs)
    for row in rows:
        ids = plain.encode_ordinary(docs[row.doc_id])
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(packed).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(docs[row.doc_id].encode()).hexdigest()
