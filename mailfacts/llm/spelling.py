"""Operator 12: spelling variants by Gram matrices of letter counts.

Words that differ by one inserted, deleted or replaced character have letter counts at a squared distance of
at most two: one for a length apart, two for equal lengths. Products of blocks of count vectors give
the squared distances of all pairs of two blocks; pairs of at most two, in the same or the next length, are
verified character by character.

Which blocks meet: the letters are dealt into ``SEGMENTS`` segments. An edit changes at most two
letters, so at least ``SEGMENTS - 2`` segments have equal counts in both words. Each word goes to one
group for every choice of so many segments, named by its counts in them, and two near words
share a group. Of the groups they share only the first reports them. A group of more than
``BLOCK`` words is cut into blocks by a hash of the words, and every pair of blocks is a task's unit of
its own, so memory is bounded whatever the group.

Words travel as Latin-1 bytes in numpy; the counts of words, the groups and what is gathered about each
word are Spark aggregates. Only verified pairs leave a task.

Defined results: null and empty texts have no words; an empty table gives none. Repeated rows count
again. A row without an id keeps its words as they are. Very long texts are taken whole; a word of any
length is compared whole. Of equally frequent near words the smallest in code-point order is the form.
Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailfacts.llm.common import lower_ascii, small_side, stored
from mailfacts.llm.words import mix

MIN_LENGTH, MIN_COUNT, RATIO = 7, 2, 10
SEGMENTS, EQUAL = 5, 3
BLOCK = 2_000
# Letters by falling frequency, dealt to the segments in turn and back.
COMMON = "etaoinshrdlcumwfgypbvkjxqz"
# Groups of up to so many words are one product; larger ones go length by length.
SMALL = 96

_CHOICES = list(combinations(range(SEGMENTS), EQUAL))
_SEGMENT = np.arange(256) % SEGMENTS
for _i, _letter in enumerate(COMMON):
    _turn, _step = divmod(_i, SEGMENTS)
    _SEGMENT[ord(_letter)] = SEGMENTS - 1 - _step if _turn % 2 else _step
_WEIGHT = mix(np.arange(256, dtype=np.uint64))
# The first choice of which all segments are equal, by the set of equal segments.
_FIRST = np.array(
    [
        next((k for k, c in enumerate(_CHOICES) if all(equal >> s & 1 for s in c)), len(_CHOICES))
        for equal in range(1 << SEGMENTS)
    ]
)


def letter_runs(text: Column) -> Column:
    """Runs of letters long enough to be words; shorter ones cannot become so."""
    return F.regexp_extract_all(text, F.lit(f"[A-Za-zÀ-ÿ]{{{MIN_LENGTH},}}"), F.lit(0))


def count_words(words: DataFrame) -> DataFrame:
    """(word, n) of the rows of ``words`` that are long and frequent enough."""
    long = words.where(F.char_length("word") >= MIN_LENGTH)
    return long.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_COUNT)


def _bytes_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The Latin-1 bytes of all words and their lengths."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8), lengths


def _segment_sums(data: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A hash of the counts of each word in each segment."""
    sums = np.zeros((len(lengths), SEGMENTS), np.uint64)
    np.add.at(sums, (np.repeat(np.arange(len(lengths)), lengths), _SEGMENT[data]), _WEIGHT[data])
    return sums


def grouped(words: DataFrame) -> DataFrame:
    """(key, word, n): every word in each of its groups. The last four bits of a key are its choice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, lengths = _bytes_of(batch.column("word").to_pylist())
            sums = _segment_sums(data, lengths)
            for k, choice in enumerate(_CHOICES):
                key = np.full(len(lengths), k, np.uint64)
                for s in choice:
                    key = mix(key ^ sums[:, s])
                key = (key & ~np.uint64(15)) | np.uint64(k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), batch.column("word"), batch.column("n")], names=["key", "word", "n"]
                )

    return words.mapInArrow(run, "key long, word string, n long")


def units(rows: DataFrame) -> DataFrame:
    """(unit, choice, side, word, n): groups as they are (side 0), large ones as pairs of blocks: a block with
    itself (side 0), or two blocks (sides 1 and 2)."""
    large = rows.groupBy("key").agg(F.count("*").alias("size")).where(F.col("size") > BLOCK)
    large = small_side(stored(large, "op12-large"))
    placed = rows.join(large, "key", "left").withColumn("blocks", F.coalesce(F.ceil(F.col("size") / BLOCK), F.lit(1)))
    block = F.pmod(F.xxhash64("word"), "blocks")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    met = placed.withColumn("block", block).withColumn("other", other)
    low, high = F.least("block", "other"), F.greatest("block", "other")
    return met.select(
        F.when(F.col("blocks") == 1, F.col("key")).otherwise(F.xxhash64("key", low, high)).alias("unit"),
        F.col("key").bitwiseAND(F.lit(15)).cast("int").alias("choice"),
        F.when(low == high, 0).when(F.col("block") == low, 1).otherwise(2).alias("side"),
        "word",
        "n",
    )


def _near(chars: np.ndarray, lengths: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether words a and b (b as long, or one longer) differ by one edit."""
    x, y = chars[a], chars[b]
    differ = x != y
    same_length = lengths[a] == lengths[b]
    out = same_length & (differ.sum(1) == 1)
    rest = np.flatnonzero(~same_length)
    if len(rest):
        # Equal up to the first difference, and from there on with the longer word moved by one.
        x, y, differ = x[rest], y[rest], differ[rest]
        moved = np.zeros_like(y)
        moved[:, :-1] = y[:, 1:]
        tail = x != moved
        after = np.arange(x.shape[1]) >= differ.argmax(1)[:, None]
        out[rest] = ~(tail & after).any(1)
    return out


def near_pairs(words: list[str], choice: int, side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the near words of one unit that its choice of segments has to report, each pair once."""
    data, lengths = _bytes_of(words)
    order = np.argsort(lengths, kind="stable")
    row = np.repeat(np.arange(len(words)), lengths)
    column = np.arange(len(data)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    chars = np.zeros((len(words), lengths.max() + 1), np.uint8)
    chars[row, column] = data
    letters, place = np.unique(data, return_inverse=True)
    counts = np.zeros((len(words), len(letters)), np.float32)
    np.add.at(counts, (row, place), 1)
    norms = (counts * counts).sum(1)
    # Ranges of rows (in order of length) that are multiplied with ranges of the same or the next length.
    if len(words) <= SMALL:
        products = [(order, order)]
    else:
        bounds = np.append(np.flatnonzero(np.diff(lengths[order], prepend=-1)), len(order))
        products = []
        for i in range(len(bounds) - 1):
            low = order[bounds[i] : bounds[i + 1]]
            products.append((low, low))
            if i + 2 < len(bounds) and lengths[order[bounds[i + 1]]] == lengths[low[0]] + 1:
                products.append((low, order[bounds[i + 1] : bounds[i + 2]]))
    found_a, found_b = [], []
    for p, q in products:
        for first in range(0, len(p), BLOCK):
            part = p[first : first + BLOCK]
            squared = norms[part][:, None] + norms[q][None, :] - 2 * (counts[part] @ counts[q].T)
            i, j = np.nonzero(squared <= 2.5)
            a, b = part[i], q[j]
            apart = lengths[b] - lengths[a]
            # Each pair once: from the shorter word, or the earlier of two equally long ones.
            keep = ((apart == 1) | ((apart == 0) & (a < b))) & ((side[a] == 0) | (side[a] != side[b]))
            found_a.append(a[keep])
            found_b.append(b[keep])
    a, b = np.concatenate(found_a), np.concatenate(found_b)
    keep = _near(chars, lengths, a, b)
    a, b = a[keep], b[keep]
    if len(a):
        sums = _segment_sums(data, lengths)
        equal = ((sums[a] == sums[b]) << np.arange(SEGMENTS)).sum(1)
        keep = _FIRST[equal] == choice
        a, b = a[keep], b[keep]
    return a, b


def find_pairs(rows: DataFrame) -> DataFrame:
    """(word, n, other, other_n) of near words, in both directions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.Table] = []

        def solve(table: pa.Table) -> pa.RecordBatch:
            unit = table.column("unit").to_numpy()
            words, n = table.column("word").to_pylist(), table.column("n").to_numpy()
            choice, side = table.column("choice").to_numpy(), table.column("side").to_numpy()
            starts = np.append(np.flatnonzero(np.diff(unit, prepend=unit[0] - 1)), len(unit))
            left, right = [], []
            for s, e in zip(starts[:-1], starts[1:], strict=True):
                if e - s > 1:
                    a, b = near_pairs(words[s:e], int(choice[s]), side[s:e])
                    left.append(a + s)
                    right.append(b + s)
            a = np.concatenate([*left, *right]) if left else np.zeros(0, np.int64)
            b = np.concatenate([*right, *left]) if left else np.zeros(0, np.int64)
            texts = table.column("word").combine_chunks()
            return pa.RecordBatch.from_arrays(
                [texts.take(pa.array(a)), pa.array(n[a]), texts.take(pa.array(b)), pa.array(n[b])],
                names=["word", "n", "other", "other_n"],
            )

        # A unit may go on in the next batch: solve what is complete, keep the last unit.
        for batch in batches:
            if not batch.num_rows:
                continue
            waiting.append(pa.Table.from_batches([batch]))
            unit = batch.column("unit").to_numpy()
            if unit[0] == unit[-1] and sum(t.num_rows for t in waiting) < 2 * BLOCK:
                continue
            whole = pa.concat_tables(waiting)
            unit = whole.column("unit").to_numpy()
            last = int(np.flatnonzero(np.diff(unit, prepend=unit[0] - 1))[-1])
            if last:
                yield solve(whole.slice(0, last))
            waiting = [whole.slice(last)]
        if waiting:
            yield solve(pa.concat_tables(waiting))

    ordered = rows.repartition("unit").sortWithinPartitions("unit", "word")
    return ordered.mapInArrow(run, "word string, n long, other string, other_n long")


def _follow(forms: DataFrame) -> DataFrame:
    """(word, root): the last word that is reached from each word over its form, by doubling of steps.
    Each form is at least ``RATIO`` times as frequent, so a few rounds do."""
    current = stored(forms.select("word", F.col("form").alias("root")), "op12-roots")
    while True:
        ahead = current.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = stored(
            current.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
            "op12-roots",
        )
        current = step.select("word", "root")
        if step.where("moved").isEmpty():
            return current


def spelling_variants(words: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the distinct words of the rows of ``words`` (word)."""
    counted = stored(count_words(words), "op12-words")
    pairs = find_pairs(units(stored(grouped(counted), "op12-grouped")))
    none = counted.select("word", "n", F.lit(None).cast("string").alias("other"), F.lit(None).cast("long").alias("other_n"))
    best = F.min(F.when(F.col("other").isNotNull(), F.struct(-F.col("other_n"), F.col("other").alias("other"))))
    likely = F.when(F.max("other_n") >= RATIO * F.max("n"), best["other"])
    found = stored(
        pairs.unionAll(none)
        .groupBy("word")
        .agg(F.max("n").alias("n"), F.count("other").alias("n_near"), likely.alias("form"), F.max("other_n").alias("best_n")),
        "op12-found",
    )
    roots = small_side(_follow(found.where("form is not null")))
    return found.join(roots, "word", "left").select(
        "word",
        "form",
        F.coalesce("root", "word").alias("root"),
        "n",
        "n_near",
        F.when(F.col("form").isNotNull(), F.col("best_n")).alias("form_n"),
    )


def words_with_typos(docs: DataFrame, rate: int) -> DataFrame:
    """(word): the lower-cased words of ``docs`` (doc_id, text), of which a hash of id and word picks one
    in ``rate`` to lose a character."""
    runs = docs.select(docs["doc_id"].cast("string").alias("doc_id"), F.explode(letter_runs(F.col("text"))).alias("run"))
    runs = runs.select("doc_id", lower_ascii(F.col("run")).alias("run"))
    picked = runs.select("run", F.crc32(F.concat("doc_id", F.lit(":"), "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.char_length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    return picked.select(F.when(F.col("h") % rate == 0, cut).otherwise(F.col("run")).alias("word"))
