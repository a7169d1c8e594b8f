"""Operator 10: repetition coverage.

Rolling hashes of several n-gram lengths find, in each text, the characters inside n-grams that
occur more than once and inside lines that occur before. All words of a run of texts are hashed
and sorted together in numpy; a row's measures depend on that row only, so there is no shuffle.

Defined results: a null or empty text has no words, fails the base rule (fewer than 50 words)
and is not kept. Equal rows give equal results, one row each. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from mailfacts.llm.common import chunks, text_or_empty
from mailfacts.llm.words import Words, mix, ngrams, words_of

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Limits:
    """Largest shares of a text's word characters inside repeated n-grams (first occurrence
    included) and inside repeated lines (first occurrence left out), and smallest word count. The
    shares are the usual published ones of filters of this kind."""

    ngram_share: dict[int, float] = field(default_factory=lambda: {5: 0.15, 8: 0.12, 10: 0.10})
    line_share: float = 0.20
    min_words: int = 50


SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, base_failed boolean, kept boolean, line_share double, "
    "ngram_shares map<int, double>"
)


def covered(words: Words, hashes: np.ndarray, n: int) -> np.ndarray:
    """Whether each word lies in an ``n``-word window found twice or more in its text."""
    mask = np.zeros(len(hashes) + 1, np.int64)
    if len(hashes) >= n:
        whole = words.doc[: len(hashes) - n + 1] == words.doc[n - 1 :]
        at = np.flatnonzero(whole)
        keys = mix(ngrams(hashes, n)[at] + mix(words.doc[at].astype(np.uint64)))
        order = np.argsort(keys, kind="stable")
        same = keys[order][1:] == keys[order][:-1]
        twice = np.zeros(len(at), bool)
        twice[order[1:]] |= same
        twice[order[:-1]] |= same
        hits = at[twice]
        np.add.at(mask, hits, 1)
        np.add.at(mask, hits + n, -1)
    return np.cumsum(mask)[:-1] > 0


def repeated_lines(text: str) -> tuple[int, int]:
    """Lines with a word that equal an earlier line, and the word characters in them."""
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    if len(set(lines)) == len(lines):
        return 0, 0
    seen: set[str] = set()
    count = chars = 0
    for line in lines:
        if line in seen:
            count += 1
            chars += len(line) - sum(map(line.count, SPACES))
        seen.add(line)
    return count, chars


def measure(batch: pa.RecordBatch, limits: Limits) -> pa.RecordBatch:
    column = batch.column("text")
    words = words_of(column)
    hashes, points, n = words.hashes(), words.code_points(), batch.num_rows

    def per_row(values: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(values)])
        return sums[words.bounds[1:]] - sums[words.bounds[:-1]]

    n_words, word_chars = words.counts, per_row(points)
    repeats = per_row(covered(words, hashes, 3))
    texts = column.to_pylist()
    symbols = [sum(map(text.count, SYMBOLS)) for text in texts]
    lines = np.array([repeated_lines(text) for text in texts], np.int64).reshape(n, 2)
    whole = np.maximum(word_chars, 1)
    line_share = lines[:, 1] / whole
    shares = {k: per_row(points * covered(words, hashes, k)) / whole for k in limits.ngram_share}
    failed = (n_words < limits.min_words) | (100 * repeats > 50 * n_words)
    bad = line_share > limits.line_share
    for k, most in limits.ngram_share.items():
        bad |= shares[k] > most
    return pa.RecordBatch.from_arrays(
        [
            batch.column("doc_id"),
            *(pa.array(x, pa.int64()) for x in (n_words, word_chars, symbols, lines[:, 0], repeats)),
            pa.array(failed),
            pa.array(~failed & ~bad),
            pa.array(line_share),
            pa.array(
                [[(k, float(shares[k][i])) for k in shares] for i in range(n)],
                pa.map_(pa.int32(), pa.float64()),
            ),
        ],
        names=[
            "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "base_failed", "kept", "line_share", "ngram_shares",
        ],
    )


def repetition_coverage(docs: DataFrame, limits: Limits | None = None) -> DataFrame:
    """Repetition measures and verdict of each row of ``docs`` (doc_id, text)."""
    limits = limits or Limits()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "text"):
            yield measure(part, limits)

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, SCHEMA)


def _covered_sql(n: int) -> str:
    """CTEs: the words of each text that lie in an n-word window found twice or more in it."""
    return f"""
grams_{n} AS (
    SELECT doc_id, unnest(list_transform(range(1, len(ws) - {n} + 2), lambda i: array_to_string(ws[i:i + {n} - 1], ' '))) AS gram,
        unnest(range(1, len(ws) - {n} + 2)) AS pos
    FROM texts WHERE len(ws) >= {n}),
covered_{n} AS (
    SELECT doc_id, count(*) AS n_words, sum(chars) AS chars
    FROM (SELECT DISTINCT doc_id, unnest(range(pos, pos + {n})) AS i
        FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, gram) AS times FROM grams_{n}) WHERE times > 1)
        JOIN words USING (doc_id, i)
    GROUP BY doc_id)"""


def sql(limits: Limits | None = None) -> str:
    """The query in DuckDB's SQL, for ids that do not repeat."""
    limits = limits or Limits()
    sizes = sorted({3, *limits.ngram_share})
    shares = " AND ".join(
        f"coalesce(c{n}.chars, 0) / greatest(word_chars, 1) <= {most}" for n, most in limits.ngram_share.items()
    )
    return f"""
WITH texts AS (
    SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
    FROM documents),
words AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS i, length(unnest(ws)) AS chars FROM texts),
{",".join(map(_covered_sql, sizes))},
lines AS (
    SELECT doc_id, sum(times - 1) AS again, sum((times - 1) * chars) AS chars
    FROM (SELECT doc_id, line, count(*) AS times, length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) AS chars
        FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM texts) GROUP BY ALL)
    WHERE chars > 0 GROUP BY doc_id),
measured AS (
    SELECT doc_id, len(ws) AS n_words, CAST(coalesce((SELECT sum(chars) FROM words w WHERE w.doc_id = t.doc_id), 0) AS BIGINT) AS word_chars,
        CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols
    FROM texts t)
SELECT doc_id, m.n_words, word_chars, n_symbols, CAST(coalesce(l.again, 0) AS BIGINT) AS n_dup_lines,
    coalesce(c3.n_words, 0) AS n_repeat_words,
    m.n_words < {limits.min_words} OR 100 * coalesce(c3.n_words, 0) > 50 * m.n_words AS base_failed,
    NOT (m.n_words < {limits.min_words} OR 100 * coalesce(c3.n_words, 0) > 50 * m.n_words)
        AND coalesce(l.chars, 0) / greatest(word_chars, 1) <= {limits.line_share} AND {shares} AS kept
FROM measured m LEFT JOIN lines l USING (doc_id)
{" ".join(f"LEFT JOIN covered_{n} c{n} USING (doc_id)" for n in sizes)}"""
