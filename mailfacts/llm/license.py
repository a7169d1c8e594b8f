"""Operator 7: licence notices by template markup.

A template is the wording of a notice, in which ``[...]`` marks optional words and ``{a,b}`` a
replaceable stretch of a to b words; all other words are mandatory. Templates are compiled into
token automata. A place in a text is accepted if its words run through the whole automaton, so
mandatory wording matches exactly while optional and replaceable regions may differ.

Defined results: null and empty texts have no words, no labels and score 0. Equal rows give equal
results, one row each. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from mailfacts.llm.common import plain_words, text_or_empty

# Phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Share of its mandatory words from which a notice that breaks off counts. Fewer words, like "under the
# terms", stand in any text.
LEAST_SHARE = 0.6

# Label and template.
TEMPLATES = (
    ("mit", "[released | licensed | distributed] under the [terms of the] mit license"),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this "
        "software {0,6} to deal in the software without restriction",
    ),
    ("apache-2.0", "licensed under the apache license version 2 0 [the license]"),
    ("apache-2.0", "apache license [version] 2 0"),
    ("gpl", "[this {1,4} is] licensed under the [gnu] general public license [version {1,1}]"),
    ("gpl", "under the terms of the gnu {0,1} general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("cc-by-nc", "[this work is] licensed under [a | the] [creative commons] cc by nc [sa | nd] {0,2} [license]"),
    ("cc-by", "[this work is] licensed under [a | the] [creative commons] cc by {0,2} [license]"),
    ("reserved", "copyright [c] {1,8} all rights reserved"),
    ("reserved", "all rights reserved"),
)

@dataclass(frozen=True)
class Automaton:
    """States 0..n; ``moves[s]`` are (word or None for any, next state), ``skips[s]`` states
    reached without a word, ``done[s]`` mandatory words passed before ``s``."""

    label: str
    moves: tuple[tuple[tuple[bytes | None, int], ...], ...]
    skips: tuple[tuple[int, ...], ...]
    done: tuple[int, ...]
    needed: frozenset[bytes]

    @property
    def final(self) -> int:
        return len(self.moves) - 1

    def close(self, states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for s in self.skips[todo.pop()]:
                if s not in states:
                    states.add(s)
                    todo.append(s)
        return states

    def run(self, words: Sequence[bytes], at: int) -> tuple[int | None, float]:
        """Where the longest acceptance from ``at`` ends, and the share of mandatory words passed."""
        states, end, most = self.close({0}), None, 0
        while states:
            most = max(most, max(self.done[s] for s in states))
            if self.final in states:
                end = at
            if at == len(words):
                break
            word = words[at]
            states = self.close({t for s in states for w, t in self.moves[s] if w is None or w == word})
            at += 1
        return end, 1.0 if end is not None else most / max(self.done[self.final], 1)


def compile_template(label: str, template: str) -> Automaton:
    for sign in "[]|":
        template = template.replace(sign, f" {sign} ")
    moves: list[list] = [[]]
    skips: list[list[int]] = [[]]
    done, needed, optional = [0], set(), None
    tails: list[int] = []

    def state() -> int:
        moves.append([])
        skips.append([])
        done.append(done[-1])
        return len(moves) - 1

    for token in template.split():
        here = len(moves) - 1
        if token == "[":
            optional, tails = here, []
            skips[here].append(state())
        elif token == "|":
            tails.append(here)
            skips[optional].append(state())
        elif token == "]":
            end = state()
            for s in (optional, here, *tails):
                skips[s].append(end)
            optional = None
        elif token[0] == "{":
            low, high = map(int, token.strip("{}").split(","))
            stops = []
            for i in range(high):
                here = len(moves) - 1
                if i >= low:
                    stops.append(here)
                moves[here].append((None, state()))
            for s in stops:
                skips[s].append(len(moves) - 1)
        else:
            word = token.encode()
            moves[here].append((word, state()))
            if optional is None:
                needed.add(word)
                done[-1] += 1
    return Automaton(
        label, tuple(map(tuple, moves)), tuple(map(tuple, skips)), tuple(done), frozenset(needed)
    )


class Scanner:
    """All automata with the words they may begin with."""

    def __init__(self, templates: Sequence[tuple[str, str]] = TEMPLATES) -> None:
        self.automata = [compile_template(*t) for t in templates]
        self.first = [
            {w for s in a.close({0}) for w, _ in a.moves[s]} for a in self.automata
        ]  # a template never begins with a replaceable stretch

    def scan(self, words: list[bytes]) -> tuple[list[tuple[str, int, int]], float]:
        """Accepted (label, start, end) places, and the best share of a template's mandatory wording that
        stands in a row from its beginning, if that is ``LEAST_SHARE`` or more."""
        places, best = [], 0.0
        present = set(words)
        index: dict[bytes, list[int]] = {}
        starts = set().union(*self.first)
        for i, w in enumerate(words):
            if w in starts:
                index.setdefault(w, []).append(i)
        for a, first in zip(self.automata, self.first, strict=True):
            if not a.needed & present:
                continue
            at_end = -1
            for i in sorted(i for w in first for i in index.get(w, ())):
                end, share = a.run(words, i)
                best = max(best, share)
                if end is not None and i >= at_end:
                    places.append((a.label, i, end))
                    at_end = end
        return places, best if best >= LEAST_SHARE else 0.0


def base_places(joined: bytes, phrase: bytes) -> list[int]:
    """Word indexes at which ``phrase`` stands in blank-separated, blank-enclosed words."""
    out, needle = [], b" " + phrase + b" "
    at, counted, words = joined.find(needle), 0, 0
    while at >= 0:
        words += joined.count(b" ", counted, at)
        counted = at
        out.append(words)
        at = joined.find(needle, at + 1)
    return out


def describe(scanner: Scanner, text: str) -> tuple:
    words = plain_words(text)
    joined = b" " + b" ".join(words) + b" "
    base = {p: base_places(joined, p.encode()) for p in PHRASES}
    at = sorted(i for places in base.values() for i in places)
    base_labels = {PHRASES[p] for p, places in base.items() if places}
    places, share = scanner.scan(words)
    labels = base_labels | {label for label, _, _ in places}
    score = 1.0 if places else max(share, 0.5 if base_labels else 0.0)
    return (
        len(words),
        len(at),
        at[0] if at else None,
        at[-1] if at else None,
        ",".join(sorted(base_labels)),
        ",".join(sorted(labels)),
        score,
        [{"label": label, "first": a, "end": b} for label, a, b in places],
    )


SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, "
    "base_labels string, labels string, score double, "
    "places array<struct<label: string, first: long, end: long>>"
)


def scan_licenses(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """Labels, places (in words) and score of each row of ``docs`` (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates)
        place = pa.struct([("label", pa.string()), ("first", pa.int64()), ("end", pa.int64())])
        kinds = [*[pa.int64()] * 4, pa.string(), pa.string(), pa.float64(), pa.list_(place)]
        names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "places"]
        for batch in batches:
            rows = [describe(scanner, text) for text in batch.column("text").to_pylist()]
            columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True))],
                names=names,
            )

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, SCHEMA)
