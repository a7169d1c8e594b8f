"""Operator 13: byte-level BPE encoding and decoding with Spark's higher-order functions.

1. The rank map is a constant of the plan: of each pair of tokens that together are a token, the
   rank of that token, which is its id. It is an array of short buckets, for a large map would be
   searched from end to end.
2. A word (a match of the tokenizer's pattern) becomes the array of its bytes' ids. A fold merges, step by
   step, the neighbours of lowest rank, the leftmost first. A part is one number: the rank of its pair with
   the next part, its place and its id, so that the least number is the pair to merge. In words of
   more than ``LONG_WORD`` bytes all places of the lowest rank merge in one step where they are many,
   unless one of these merges would bring up a pair of still lower rank. So both do what single merges
   in order of rank do, and a long run of equal characters takes few steps.
3. The most frequent distinct words of all texts, ``FREQUENT`` at most, are folded once, in tasks, unless they
   are tokens. With the tokens they become a second constant, which tasks put together too: it reaches the driver
   as one block. Every other word is folded where it stands. The number bounds memory
   only; the ids are the same with any.
4. Decoding looks up the bytes of each id in a literal array and concatenates the pieces.

All of it is one map over the texts, apart from counting words: no text is shuffled.

Defined results: a null or empty text has no ids and decodes to no bytes. Equal rows give equal results,
one row each; an empty table gives none. Rows without an id are encoded like others. Very long
texts and words are encoded whole. Equally frequent words are all taken or none. An id that
is no token decodes to nothing. Extra columns are ignored. A vocabulary must contain every byte and
fewer than two million tokens. Letters and digits are those of the JVM's Unicode version; white space
is Unicode's.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mailfacts.llm.common import stored, text_or_empty

FREQUENT = 500_000
# Bytes that frequent words have on average at most; with more there are fewer of them.
FREQUENT_BYTES = 40
# Bytes that they have together at most, so that the driver's memory is bounded with long words too.
FREQUENT_TOTAL = 6_000_000
# At most 1,000, for a place must fit into its bits.
LONG_WORD = 1_000
# In long words, parts for each place of the lowest rank from which on all places merge at once.
SPARSE = 32
# Entries of a constant's bucket, on average, and buckets of the words that are collected at once.
PER_BUCKET = 2
PER_GROUP = 4_096
# A pair of tokens is one number. NONE is the rank of a pair that is no token.
WIDTH = 1 << 21
NONE = (1 << 31) - 1
# Bits of a part of a short word: 31 of its rank, 10 of its place, 21 of its token's number.
PLACE_AT, RANK_AT = 21, 31
NUMBER_BITS, BELOW_RANK = (1 << PLACE_AT) - 1, (1 << RANK_AT) - 1
LAST_PLACE = (1 << RANK_AT - PLACE_AT) - 1
NO_PAIR = NONE << RANK_AT


@dataclass(frozen=True)
class Vocabulary:
    """Tokens and their ranks, which are their ids, and the pattern that splits texts."""

    ranks: dict[bytes, int]
    pattern: str

    @classmethod
    def read(cls, path: str, pattern: str) -> Vocabulary:
        """From a rank file: a token in base64 and its rank on each line."""
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        return cls({base64.b64decode(token): int(rank) for token, rank in pairs}, pattern)

    @cached_property
    def pairs(self) -> dict[tuple[int, int], int]:
        """The rank of each pair of tokens that is a token."""
        ranks = self.ranks
        return {
            (ranks[token[:i]], ranks[token[i:]]): rank
            for token, rank in ranks.items()
            for i in range(1, len(token))
            if token[:i] in ranks and token[i:] in ranks
        }

    @cached_property
    def whole_words(self) -> dict[str, list[int]]:
        """Tokens that are text by themselves, with their ids."""
        found = {}
        for token, rank in self.ranks.items():
            try:
                found[token.decode()] = [rank]
            except UnicodeDecodeError:
                continue
        return found


def _literal(value: object, kind: str) -> Column:
    """A constant of a nested type: folded once, when Spark optimizes the plan."""
    return F.from_json(F.lit(json.dumps(value, separators=(",", ":"))), kind)


def _large(value: object, kind: str) -> Column:
    """A large constant: a subquery that is run once before the query. Unlike a literal's, its value is one
    block of memory, which is not spelled out in plans; the driver keeps those of every query, and tasks
    would build the value's objects one by one. Subqueries must not stand in higher-order functions:
    they are selected beside the text, each used once, and Spark puts them in place."""
    text = json.dumps(value, separators=(",", ":"))
    row = SparkSession.getActiveSession().createDataFrame([(text,)], "value string")
    return row.select(F.from_json("value", kind)).scalar()


class Words:
    """A constant map from words to ids, from stored ``entries`` (word, ids) of different words. ``table`` is to be
    bound once by ``_let``: a plan that held it at every use would be compared for minutes."""

    def __init__(self, entries: DataFrame):
        self.count = max(1, entries.count() // PER_BUCKET)
        entry = F.struct("word", "ids")
        kind = entries.select(entry.alias("entry")).schema["entry"].dataType
        every = entries.sparkSession.range(self.count).select(
            F.col("id").cast("int").alias("bucket"), F.lit(None).cast(kind).alias("entry")
        )
        buckets = (
            entries.select(self._bucket(F.col("word")).alias("bucket"), entry.alias("entry")).unionByName(every)
            .groupBy("bucket").agg(F.collect_list("entry").alias("entries"))
        )
        groups = buckets.groupBy(F.floor(F.col("bucket") / PER_GROUP).alias("group")).agg(
            F.sort_array(F.collect_list(F.struct("bucket", "entries"))).alias("buckets")
        )
        ordered = F.flatten(F.sort_array(F.collect_list(F.struct("group", "buckets")))["buckets"])
        self.table = groups.agg(F.transform(ordered, lambda b: F.map_from_entries(b["entries"]))).scalar()

    def _bucket(self, word: Column) -> Column:
        return F.pmod(F.hash(word), F.lit(self.count))

    def within(self, table: Column) -> Callable[[Column], Column]:
        """A function of a word: its ids, or null."""
        return lambda word: F.get(table, self._bucket(word))[word]


class Ranks:
    """The constant rank map, with the numbers of the single bytes. A token's number is its id and one, which
    is also the rank of the pair that it is made of. Buckets are the rank NONE and then keys, each followed
    by its rank, all ranks in their place within a part; no key equals one of those, as no number is 0."""

    def __init__(self, vocabulary: Vocabulary):
        self.count = max(1, len(vocabulary.pairs) // PER_BUCKET)
        buckets: list[list[int]] = [[NO_PAIR] for _ in range(self.count)]
        for (a, b), rank in vocabulary.pairs.items():
            key = (a + 1) * WIDTH + b + 1
            buckets[key % self.count] += (key, rank + 1 << RANK_AT)
        self.table = _large(buckets, "array<array<bigint>>")
        single = [vocabulary.ranks[bytes([i])] + 1 for i in range(256)]
        self.bytes = _literal(single, "array<bigint>")
        # Of each two bytes, the part that the first is at place 0, and of each last byte.
        pairs = [vocabulary.ranks.get(bytes([a, b])) for a in range(256) for b in range(256)]
        ranks = [NO_PAIR if rank is None else rank + 1 << RANK_AT for rank in pairs]
        starts = [rank | single[i >> 8] for i, rank in enumerate(ranks)]
        self.starts = _large(starts + [NO_PAIR | i for i in single], "array<bigint>")
        self.edge = max(vocabulary.ranks.values()) + 2

    def within(self, table: Column) -> Callable[[Column, Column], Column]:
        """A function of two numbers: the rank of their pair, in its place within a part."""

        def rank(a: Column, b: Column) -> Column:
            def found(key: Column) -> Column:
                bucket = F.get(table, key % self.count)
                return F.get(bucket, F.array_position(bucket, key))

            return _let(a * WIDTH + b, found)

        return rank


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.aggregate(F.array().cast("array<int>"), value, lambda v, _: v, body)


def words_of(text: Column, pattern: str) -> Column:
    """The matches of the pattern, in order, with Unicode's white space."""
    return F.regexp_extract_all(text, F.lit("(?U)" + pattern), F.lit(0))


Rank = Callable[[Column, Column], Column]


def _state(parts: Column, rank: Rank) -> Column:
    """Parts with an edge at both ends, and the rank of every part with the next."""
    n = F.size(parts)
    ranks = F.zip_with(F.slice(parts, 1, n - 1), F.slice(parts, 2, n - 1), rank)
    return F.struct(parts.alias("parts"), ranks.alias("ranks"))


def merge_first(state: Column, lowest: Column, rank: Rank) -> Column:
    """The leftmost pair of lowest rank becomes one part; only its neighbours' ranks are new."""
    parts, ranks = state["parts"], state["ranks"]

    def merged(i: Column) -> Column:  # i: from 1; an edge precedes and follows
        n = F.size(parts)
        beside = F.array(rank(F.get(parts, i - 2), lowest), rank(lowest, F.get(parts, i + 1)))
        return F.struct(
            F.concat(F.slice(parts, 1, i - 1), F.array(lowest), F.slice(parts, i + 2, n)).alias("parts"),
            F.concat(F.slice(ranks, 1, i - 2), beside, F.slice(ranks, i + 2, n)).alias("ranks"),
        )

    return _let(F.array_position(ranks, lowest).cast("int"), merged)


def merge_all(state: Column, lowest: Column, rank: Rank) -> Column:
    """All places of the lowest rank, left to right, unless that would pass over a lower rank."""
    parts, ranks = state["parts"], state["ranks"]
    # '1' where a part merges with the next; of overlapping places every other one.
    marks = F.array_join(F.transform(ranks, lambda r: F.when(r == lowest, "1").otherwise("0")), "")
    chosen = F.split(F.regexp_replace(marks, "11", "10"), "")

    def passes_over(flags: Column) -> Column:
        def lower(i: Column) -> Column:
            left = F.when(F.get(flags, i - 2) == "1", lowest).otherwise(F.get(parts, i - 1))
            return (rank(left, lowest) < lowest) | (rank(lowest, F.get(parts, i + 2)) < lowest)

        return F.exists(F.transform(flags, lambda f, i: (f == "1") & lower(i)), lambda x: x)

    def merged(flags: Column) -> Column:
        new = F.transform(
            parts,
            lambda p, i: F.when(F.get(flags, i) == "1", lowest)
            .when(F.get(flags, i - 1) == "1", F.lit(None))
            .otherwise(p),
        )
        return _let(F.filter(new, lambda p: p.isNotNull()), lambda p: _state(p, rank))

    return _let(
        chosen,
        lambda flags: F.when(passes_over(flags), merge_first(state, lowest, rank)).otherwise(merged(flags)),
    )


def merge_many(state: Column, lowest: Column, rank: Rank) -> Column:
    """``merge_all`` where it saves many steps, ``merge_first`` elsewhere."""
    ranks = state["ranks"]
    places = F.size(F.filter(ranks, lambda r: r == lowest))
    one = merge_first(state, lowest, rank)
    return F.when(places * SPARSE >= F.size(ranks), merge_all(state, lowest, rank)).otherwise(one)


def _single(word: Column) -> Column:
    """Each byte as a character of the same code; of an empty word, one empty string."""
    return F.split(F.decode(word.cast("binary"), "iso-8859-1"), "")


def _steps(word: Column) -> Column:
    return F.sequence(F.lit(2), F.greatest(F.octet_length(word), F.lit(2)))


def merge_least(parts: Column, least: Column, rank: Rank) -> Column:
    """The part of least number becomes one with the next; only its rank and that before are new. What is
    computed here is written for few expressions, each of which costs a call."""

    def merged(i: Column, number: Column) -> Column:  # i: from 1; an edge precedes and follows
        before, following, after = F.get(parts, i - 2), F.get(parts, i), F.get(parts, i + 1)
        rest = F.array_remove(F.array_remove(F.array_remove(parts, following), least), before)
        left = rank(before.bitwiseAND(NUMBER_BITS), number).bitwiseOR(before.bitwiseAND(BELOW_RANK))
        place = least.bitwiseAND(LAST_PLACE << PLACE_AT)
        new = rank(number, after.bitwiseAND(NUMBER_BITS)).bitwiseOR(place).bitwiseOR(number)
        return F.array_insert(F.array_insert(rest, i - 1, left), i, new)

    return _let(
        F.array_position(parts, least).cast("int"),
        lambda i: _let(F.shiftright(least, RANK_AT), lambda number: merged(i, number)),
    )


def fold_short(word: Column, starts: Column, edge: int, rank: Rank) -> Column:
    """The ids of a word of ``LONG_WORD`` bytes at most."""
    ends = [F.array(F.lit(NO_PAIR | place << PLACE_AT | edge)) for place in (0, LAST_PLACE)]
    places = F.array(*(F.lit(i + 1 << PLACE_AT) for i in range(LONG_WORD)))

    def parts(codes: Column) -> Column:
        def part(code: Column, i: Column) -> Column:
            following = F.coalesce(code * 256 + F.get(codes, i + 1), code + 65_536)
            return F.get(starts, following).bitwiseOR(F.get(places, i))

        return F.concat(ends[0], F.transform(codes, part), ends[1])

    return F.aggregate(
        _steps(word),
        _let(F.transform(_single(word), F.ascii), parts),
        lambda s, _: _let(F.array_min(s), lambda x: F.when(x < NO_PAIR, merge_least(s, x, rank)).otherwise(s)),
        lambda s: F.transform(F.slice(s, 2, F.size(s) - 2), lambda x: (x.bitwiseAND(NUMBER_BITS) - 1).cast("int")),
    )


def fold_long(word: Column, bytes_: Column, edge: int, rank: Rank) -> Column:
    """The ids of a longer word. Its parts are numbers of tokens only, its ranks stand beside them."""

    def plain_rank(a: Column, b: Column) -> Column:
        return F.shiftright(rank(a, b), RANK_AT)

    numbers = F.transform(_single(word), lambda c: F.get(bytes_, F.ascii(c)))
    ends = F.array(F.lit(edge).cast("bigint"))
    none = F.array().cast("array<bigint>")

    def one_step(s: Column, lowest: Column) -> Column:
        return F.when(lowest < NONE, merge_many(s, lowest, plain_rank)).otherwise(
            F.struct(s["parts"].alias("parts"), none.alias("ranks"))
        )

    return F.aggregate(
        _steps(word),
        _let(F.concat(ends, numbers, ends), lambda p: _state(p, plain_rank)),
        lambda s, _: _let(
            F.coalesce(F.array_min(s["ranks"]), F.lit(NONE).cast("bigint")), lambda lowest: one_step(s, lowest)
        ),
        lambda s: F.transform(F.slice(s["parts"], 2, F.size(s["parts"]) - 2), lambda part: (part - 1).cast("int")),
    )


def _folding(ranks: Ranks, body: Callable[[Callable[[Column], Column]], Column]) -> Column:
    """``body`` of the function that gives the ids of a word by merging its bytes, over rows that hold the
    constants of ``ranks`` beside them."""

    def bound(table: Column, starts: Column, bytes_: Column) -> Column:
        rank = ranks.within(table)

        def fold(word: Column) -> Column:
            short = fold_short(word, starts, ranks.edge, rank)
            long = fold_long(word, bytes_, ranks.edge, rank)
            none = F.array().cast("array<int>")
            return F.when(word == "", none).when(F.octet_length(word) <= LONG_WORD, short).otherwise(long)

        return body(fold)

    table, starts = F.col("ranks"), F.col("starts")
    return _let(table, lambda t: _let(starts, lambda s: _let(ranks.bytes, lambda b: bound(t, s, b))))


def counted_words(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(word, count): the distinct words that occur more than once."""
    words = docs.select(F.explode(words_of(text_or_empty(), vocabulary.pattern)).alias("word"))
    return words.groupBy("word").count().where("count > 1")


def least_count(counted: DataFrame, frequent: int) -> int | None:
    """The least count from which on words are frequent, or None if none are."""
    sizes = (
        counted.groupBy("count")
        .agg(F.count("*").alias("words"), F.sum(F.octet_length("word")).alias("bytes"))
        .orderBy(F.desc("count")).limit(frequent)
    )
    least, words, size = None, 0, 0
    for row in sizes.collect():
        words, size = words + row["words"], size + row["bytes"]
        if words > frequent or size > min(frequent * FREQUENT_BYTES, FREQUENT_TOTAL):
            break
        least = row["count"]
    return least


def frequent_words(
    docs: DataFrame, vocabulary: Vocabulary, ranks: Ranks, frequent: int, tokens: DataFrame
) -> DataFrame:
    """(word, ids): the most frequent distinct words of ``docs`` that are not among ``tokens``, stored."""
    counted = stored(counted_words(docs, vocabulary), "words")
    least = least_count(counted, frequent)
    chosen = counted.where(F.col("count") >= least) if least is not None else counted.limit(0)
    folded = (
        chosen.join(tokens, "word", "left_anti")
        .select("word", ranks.table.alias("ranks"), ranks.starts.alias("starts"))
        .select("word", _folding(ranks, lambda fold: fold(F.col("word"))).alias("ids"))
    )
    return stored(folded, "folded")


def encode(docs: DataFrame, vocabulary: Vocabulary, frequent: int = FREQUENT) -> DataFrame:
    """(doc_id, ids): the token ids of each text of ``docs`` (doc_id, text)."""
    ranks = Ranks(vocabulary)
    tokens = docs.sparkSession.createDataFrame(list(vocabulary.whole_words.items()), "word string, ids array<int>")
    known = stored(tokens, "tokens")
    if frequent:
        known = known.unionByName(frequent_words(docs, vocabulary, ranks, frequent, known.select("word")))
    ready = Words(known)
    words = words_of(F.col("text"), vocabulary.pattern)
    ids = _let(
        F.col("words"),
        lambda t: _folding(
            ranks,
            lambda fold: F.transform(words, lambda w: F.coalesce(ready.within(t)(w), fold(w))),
        ),
    )
    return docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        text_or_empty().alias("text"),
        ready.table.alias("words"),
        ranks.table.alias("ranks"),
        ranks.starts.alias("starts"),
    ).select("doc_id", F.flatten(ids).alias("ids"))


def _by_id(vocabulary: Vocabulary, piece: Callable[[int, bytes], str]) -> Column:
    size = max(vocabulary.ranks.values(), default=-1) + 1
    pieces = [""] * size
    for token, rank in vocabulary.ranks.items():
        pieces[rank] = piece(rank, token)
    return _literal(pieces, "array<string>")


def _joined(ids: Column, pieces: Column) -> Column:
    return F.unhex(F.array_join(F.transform(ids, lambda i: F.get(pieces, i)), ""))


def decode(ids: Column, vocabulary: Vocabulary) -> Column:
    """The bytes that token ids stand for."""
    return _joined(ids, _by_id(vocabulary, lambda _, token: token.hex()))


def packed(ids: Column, vocabulary: Vocabulary) -> Column:
    """Ids as little-endian unsigned 32-bit integers, one after the other."""
    return _joined(ids, _by_id(vocabulary, lambda rank, _: rank.to_bytes(4, "little").hex()))
