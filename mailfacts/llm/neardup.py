"""Operator 5: near duplicates by a MinHash LSH forest.

1. Texts become sets of distinct five-word shingles (64-bit hashes); documents with equal sets
   are one class, represented by its smallest id.
2. Each class has ``HASHES`` MinHash values. Every tree of the forest orders them differently; its
   sorted order brings classes with a long common prefix together. A region is a shared prefix of
   ``DEPTHS[0]`` values. Where a region holds several classes it is split at the next depth, so the
   depth adapts to how crowded a region is. The hub of a region is the class that shares most
   regions with others: in a group of near copies, their original.
3. First round: each class proposes the hub of the deepest region it is not alone in and the hub
   of its widest region, those that most trees name. Proposals are confirmed on full sets.
4. Second round, for the regions that still hold several components: all members are compared
   with the hub of the region's largest component. What several of them add in common makes one of
   them a hub for the others, as long as that joins components. By what members lack of the hub and
   add to it, in bitmaps and then in full, it is decided which members of components still apart can
   be linked at all (``candidates``). Those are confirmed on full sets. So every pair that shares a
   region is either in one component already or confirmed or refuted, and no group is expanded into
   all its pairs.

A pair at the threshold shares no region with probability (1 - 0.75**4)**32, about 5e-6; one
at 0.85 with 3e-11. Nothing is capped: hot regions and classes are rows of ordinary joins.

Defined results: null texts and texts without words have empty sets and are linked with nothing.
Rows with the same id are one document, linked through each of its texts. Rows without an id
take no part: their component is null and they are kept. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailfacts.llm.common import LOWER, UPPER, chunks, stored, text_or_empty
from mailfacts.llm.components import components
from mailfacts.llm.words import mix, ngrams, words_of

SHINGLE = 5
HASHES = 128
TREES = 32
DEPTHS = (4, 8, 16)
# Pairs below this share of equal MinHash values are not confirmed: more than five standard
# deviations under the threshold.
LEAST_ESTIMATE = 0.55
# New hubs are given again as long as one in so many holders of passages was linked by them.
WORTH_A_ROUND = 50
# Length of the bitmaps of what a member lacks and adds, in words of 64 bits.
MARK_WORDS = 4
_LACK_MARKS = tuple(f"lacks_{i}" for i in range(MARK_WORDS))
_ADD_MARKS = tuple(f"adds_{i}" for i in range(MARK_WORDS))

_MULTIPLIERS = mix(np.arange(1, HASHES + 1, dtype=np.uint64)) | np.uint64(1)
_ORDERS = np.array([np.roll(np.arange(HASHES), -t * DEPTHS[0]) for t in range(TREES)])


def shingle_sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingles of all rows, one after the other, and their bounds by row."""
    words = words_of(column, lower=True)
    hashes, n = words.hashes(), len(column)
    values, docs = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if len(hashes) >= SHINGLE:
        whole = words.doc[: len(hashes) - SHINGLE + 1] == words.doc[SHINGLE - 1 :]
        values = ngrams(hashes, SHINGLE)[whole]
        docs = words.doc[: len(hashes) - SHINGLE + 1][whole]
    short = np.flatnonzero((words.counts > 0) & (words.counts < SHINGLE))
    if len(short):
        # The whole sequence, set apart by its length from those of other lengths.
        whole_hash = [ngrams(hashes[words.bounds[i] : words.bounds[i + 1]], words.counts[i])[0] for i in short]
        values = np.concatenate([values, mix(np.array(whole_hash, np.uint64) + words.counts[short].astype(np.uint64))])
        docs = np.concatenate([docs, short])
    order = np.lexsort((values, docs))
    values, docs = values[order], docs[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (docs[1:] != docs[:-1])
    values, docs = values[new], docs[new]
    return values, np.searchsorted(docs, np.arange(n + 1))


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, n, s1, s2, sig): set size, two sums that identify the set, MinHash values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "text"):
            values, bounds = shingle_sets(part.column("text"))
            sizes = np.diff(bounds)
            full = np.flatnonzero(sizes)
            s1, s2 = np.zeros(len(sizes), np.uint64), np.zeros(len(sizes), np.uint64)
            sig = np.zeros((len(sizes), HASHES), np.uint32)
            if len(full):
                at = bounds[full]
                s1[full] = np.add.reduceat(mix(values), at)
                s2[full] = np.bitwise_xor.reduceat(mix(~values), at)
                for k in range(HASHES):
                    hashed = ((values * _MULTIPLIERS[k]) >> np.uint64(32)).astype(np.uint32)
                    sig[full, k] = np.minimum.reduceat(hashed, at)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(s1.view(np.int64)),
                    pa.array(s2.view(np.int64)),
                    pa.array([row.tobytes() if n else None for row, n in zip(sig, sizes, strict=True)], pa.binary()),
                ],
                names=["doc_id", "n", "s1", "s2", "sig"],
            )

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, "doc_id long, n long, s1 long, s2 long, sig binary")


def forest(classes: DataFrame) -> DataFrame:
    """(rep, n, l0, l1, l2): of each class and tree the hashes of its prefixes at each depth."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            raw = b"".join(batch.column("sig").to_pylist())
            sig = np.frombuffer(raw, np.uint32).reshape(-1, HASHES).astype(np.uint64)
            label = np.repeat(mix(np.arange(TREES, dtype=np.uint64))[:, None], len(sig), 1)
            levels, depth = [], 0
            for d in DEPTHS:
                while depth < d:
                    label = mix(label ^ sig[:, _ORDERS[:, depth]].T)
                    depth += 1
                levels.append(pa.array(label.ravel().view(np.int64)))
            take = pa.array(np.tile(np.arange(len(sig)), TREES))
            yield pa.RecordBatch.from_arrays(
                [batch.column("rep").take(take), batch.column("n").take(take), *levels],
                names=["rep", "n", "l0", "l1", "l2"],
            )

    return classes.select("rep", "n", "sig").mapInArrow(run, "rep long, n long, l0 long, l1 long, l2 long")


def crowded_regions(rows: DataFrame) -> DataFrame:
    """The forest's rows in regions of several classes, with ``degree``: how many classes a class
    meets in all its regions."""
    sizes = (
        rows.groupBy("l0").agg(F.count("*").alias("size"), F.min("rep").alias("low"), F.max("rep").alias("high"))
        .where("low <> high").select("l0", "size")
    )
    regions = stored(rows.join(stored(sizes, "op5-crowded"), "l0"), "op5-regions")
    degrees = stored(regions.groupBy("rep").agg(F.sum("size").alias("degree")), "op5-degrees")
    return stored(regions.drop("size").join(degrees, "rep"), "op5-placed")


def _hub(*first: str):
    """Of the rows of a group the class that meets most others."""
    return F.max_by("rep", F.struct(*first, "degree", -F.col("rep")))


def _may_link(a: str, b: str):
    """Sizes at which two sets can reach the threshold at all."""
    return 100 * F.least(a, b) >= 75 * F.greatest(a, b)


def proposals(regions: DataFrame) -> DataFrame:
    """(a, b): each class with the hubs that most of its trees have as its deepest and as its
    widest neighbour."""
    out = regions.select("rep", *(f"l{i}" for i in range(len(DEPTHS))))
    for i in range(len(DEPTHS)):
        hubs = (
            regions.groupBy(f"l{i}").agg(_hub().alias(f"h{i}"), F.min("rep").alias("low"), F.max("rep").alias("high"))
            .where("low <> high").select(f"l{i}", f"h{i}")
        )
        out = out.join(stored(hubs, f"op5-hubs{i}"), f"l{i}", "left")
    deepest = F.coalesce(*(f"h{i}" for i in reversed(range(len(DEPTHS)))))
    named = out.select(
        F.col("rep").alias("b"),
        F.explode(F.array(F.struct(F.lit(0).alias("way"), deepest.alias("a")), F.struct(F.lit(1).alias("way"), F.col("h0").alias("a")))).alias("x"),
    ).select("b", "x.*")
    return (
        named.where("a <> b")
        .groupBy("b", "way", "a").agg(F.count("*").alias("votes"))
        .groupBy("b", "way").agg(F.max_by("a", F.struct("votes", -F.col("a"))).alias("a"))
        .select("a", "b").distinct()
    )


def unresolved(regions: DataFrame, found: DataFrame) -> DataFrame:
    """(hub, m, c, hub_c): the members of regions of several components, with the hub of the
    region's largest component, and the components of both."""
    rows = regions.join(found, regions["rep"] == found["node"], "left").select(
        "l0", "rep", "degree", F.coalesce("component", "rep").alias("c")
    )
    rows = stored(rows, "op5-members")
    mixed = (
        rows.groupBy("l0", "c").agg(F.count("*").alias("k"), _hub().alias("hub"))
        .groupBy("l0").agg(F.max(F.struct("k", "c", "hub")).alias("main"), F.count("*").alias("parts"))
        .where("parts > 1").select("l0", F.col("main.hub").alias("hub"), F.col("main.c").alias("hub_c"))
    )
    return (
        rows.join(stored(mixed, "op5-mixed"), "l0").select("hub", F.col("rep").alias("m"), "c", "hub_c").distinct()
    )


def deltas(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Members with ``n``, ``hub_n``, ``lacks`` (elements of the hub that the member has not), ``adds``
    (those it has beyond), the added elements, and a bitmap of each of both kinds (``marks``)."""

    def marks(elements: np.ndarray) -> np.ndarray:
        words = np.zeros(MARK_WORDS, np.uint64)
        bit = elements % np.uint64(64 * MARK_WORDS)
        np.bitwise_or.at(words, (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63)))
        return words.view(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, hub_n, lacks, added, maps = [], [], [], [], []
            for x, h in zip(batch.column("s"), batch.column("s_hub"), strict=True):
                x, h = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(h.as_py(), np.uint64)
                known = h[np.minimum(np.searchsorted(h, x), len(h) - 1)] == x
                n.append(len(x))
                hub_n.append(len(h))
                at = np.searchsorted(x, h)
                lacked = h[x[np.minimum(at, len(x) - 1)] != h]
                lacks.append(len(lacked))
                added.append(x[~known].view(np.int64))
                maps.append(np.concatenate([marks(lacked), marks(x[~known])]))
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("hub", "m", "c", "hub_c")),
                    *(pa.array(v, pa.int64()) for v in (n, hub_n, lacks, list(map(len, added)))),
                    pa.array(added, pa.list_(pa.int64())),
                    *(pa.array(column) for column in np.array(maps, np.int64).reshape(-1, 2 * MARK_WORDS).T),
                ],
                names=["hub", "m", "c", "hub_c", "n", "hub_n", "lacks", "adds", "added", *_LACK_MARKS, *_ADD_MARKS],
            )

    return (
        members.join(sets.toDF("m", "s"), "m")
        .join(sets.toDF("hub", "s_hub"), "hub")
        .select("hub", "m", "c", "hub_c", "s", "s_hub")
        .mapInArrow(
            run,
            "hub long, m long, c long, hub_c long, n long, hub_n long, lacks long, adds long, added array<long>, "
            + ", ".join(f"{name} long" for name in (*_LACK_MARKS, *_ADD_MARKS)),
        )
    )


def recoloured(known: DataFrame, found: DataFrame) -> DataFrame:
    """Compared members with the components of member and hub as they are now. Members linked with their
    hub count to its component already."""
    rows = known.drop("c", "hub_c")
    for node, name in (("m", "c"), ("hub", "hub_c")):
        now = found.select(F.col("node").alias(node), F.col("component").alias(name))
        rows = rows.join(now, node, "left").withColumn(name, F.coalesce(name, node))
    rows = rows.withColumn("cost", 4 * F.col("lacks") + 3 * F.col("adds"))
    rows = rows.withColumn("c", F.when(F.col("cost") <= F.col("hub_n"), F.col("hub_c")).otherwise(F.col("c")))
    return rows.withColumn("apart", F.col("c") != F.col("hub_c"))


def passages(rows: DataFrame) -> DataFrame:
    """(hub, e, weight, and the columns of its holders): what members of one hub add in common, as far as it
    can link different components.

    Elements that the same members add are one passage, named by its smallest element ``e``, with
    their number as ``weight``: a passage of many words is one row of a member, not one for each of its
    shingles. The members are told by their number and two exclusive ors of hashes of them.
    """
    held = rows.withColumn("e", F.explode("added")).drop("added")
    holders = (
        held.groupBy("hub", "e")
        .agg(
            F.count("*").alias("k"),
            F.bit_xor(F.xxhash64("m")).alias("f1"),
            F.bit_xor(F.xxhash64(F.lit(1), "m")).alias("f2"),
            F.min("c").alias("low"),
            F.max("c").alias("high"),
            F.bool_or("apart").alias("any_apart"),
        )
        .where("low <> high and any_apart")
    )
    named = holders.groupBy("hub", "k", "f1", "f2").agg(F.min("e").alias("e"), F.count("*").alias("weight"))
    return held.join(stored(named.select("hub", "e", "weight"), "op5-passages"), ["hub", "e"])


def _in_common(kind: str, names: tuple[str, ...]) -> Column:
    """At most so many of the elements that two members lack, or add, can be the same: those that share
    a bit, and as many of the rest as the member with fewer elements beside their bits has."""

    def bits(mark: Callable[[str], Column]) -> Column:
        return sum((F.bit_count(mark(name)) for name in names[1:]), F.bit_count(mark(names[0]))).cast("long")

    shared = bits(lambda name: F.col(f"x_{name}").bitwiseAND(F.col(name)))
    beside = F.least(F.col(f"x_{kind}") - bits(lambda name: F.col(f"x_{name}")), F.col(kind) - bits(F.col))
    return F.least(shared + beside, F.col(f"x_{kind}"), F.col(kind))


def _needed() -> Column:
    """How many added elements two members (x_... and the other) must share, at least, to be linked."""
    return F.ceil((F.col("x_cost") + F.col("cost") - F.col("hub_n")) / 7) - _in_common("lacks", _LACK_MARKS)


def _possible() -> Column:
    """Whether two members of different components can be linked, as far as sizes and bitmaps tell."""
    apart = F.col("x_apart") | F.col("apart")
    return (
        (F.col("x_c") != F.col("c")) & apart & _may_link("x_n", "n") & (_needed() <= _in_common("adds", _ADD_MARKS))
    )


_MEMBER = ("cost", "m", "c", "n", "lacks", "adds", "apart", *_LACK_MARKS, *_ADD_MARKS)


def _other(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.select(*keys, *(F.col(k).alias(f"x_{k}") for k in _MEMBER))


def _pair() -> list[Column]:
    return [F.least("x_m", "m").alias("a"), F.greatest("x_m", "m").alias("b")]


def new_hub_pairs(held: DataFrame) -> DataFrame:
    """(a, b): of each passage one member of the component most of its holders are in, with the holders in
    other components that it can be linked with. As many pairs as holders at most."""
    by_component = held.groupBy("hub", "e", "c").agg(F.count("*").alias("k"), F.min(F.struct(*_MEMBER)).alias("best"))
    first = by_component.groupBy("hub", "e").agg(F.max_by("best", F.struct("k", -F.col("c"))).alias("best"))
    chosen = stored(first.select("hub", "e", *(F.col(f"best.{k}").alias(f"x_{k}") for k in _MEMBER)), "op5-new-hubs")
    return held.join(chosen, ["hub", "e"]).where(_possible()).select(*_pair()).distinct()


def candidates(rows: DataFrame, held: DataFrame) -> DataFrame:
    """(a, b): members of one hub in different components that can be linked.

    With ``cost = 4 * lacks + 3 * adds``, members x and y reach the threshold exactly if
    ``cost(x) + cost(y) <= hub_n + 7 * s``, where s counts what both lack and what both add. A
    member is linked with the hub itself if its cost is at most ``hub_n``. Of a pair with different
    components at least one, x, is not. The bitmaps bound what both can lack, so the pair must either
    add ``needed`` common elements, of which the bitmaps bound the number too, or meet the bound
    without any. In a group of near copies with edits of their own hardly any pair does either.
    """
    once = F.col("x_apart") & (~F.col("apart") | (F.col("x_m") < F.col("m"))) & _possible()
    # Only a member smaller than the hub can lack enough of what x lacks.
    smaller = rows.where("n < hub_n").drop("added")
    bare = _other(rows.where("apart"), "hub").join(smaller, "hub").where(once & (_needed() <= 0)).select(*_pair())
    shared = (
        _other(held.where("apart"), "hub", "e")
        .join(held, ["hub", "e"])
        .where(once & (_needed() > 0))
        .groupBy("hub", *_pair(), _needed().alias("needed")).agg(F.sum("weight").alias("seen"))
        .where("seen >= needed").select("a", "b")
    )
    return bare.unionAll(shared).distinct()


def direct_links(known: DataFrame) -> DataFrame:
    """(a, b): members that are linked with their hub."""
    return known.where("m <> hub and 4 * lacks + 3 * adds <= hub_n").select(F.col("hub").alias("a"), F.col("m").alias("b"))


def _likely(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs whose sizes and MinHash values leave the threshold possible."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(-1, HASHES)
                for c in ("sig_a", "sig_b")
            )
            near = (x == y).mean(1) >= LEAST_ESTIMATE
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(near))

    sig = classes.select("rep", "n", "sig")
    return (
        pairs.join(sig.toDF("b", "n_b", "sig_b"), "b")
        .join(sig.toDF("a", "n_a", "sig_a"), "a")
        .where(_may_link("n_a", "n_b"))
        .select("a", "b", "sig_a", "sig_b")
        .mapInArrow(run, "a long, b long")
    )


def sets_of(ids: DataFrame, docs: DataFrame) -> DataFrame:
    """(id, s): the full shingle sets of some documents, from their texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "text"):
            values, bounds = shingle_sets(part.column("text"))
            rows = [values[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(rows, pa.binary())], names=["id", "s"])

    wanted = stored(ids.distinct(), "op5-wanted")
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_or_empty().alias("text"))
    texts = texts.join(wanted, texts["doc_id"] == wanted["id"], "left_semi")
    return stored(texts.mapInArrow(run, "id long, s binary").distinct(), "op5-sets")


def confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs with 100 * intersection >= 75 * union of their full shingle sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column("s_a"), batch.column("s_b"), strict=True):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                at = np.searchsorted(y, x)
                shared = int((y[np.minimum(at, len(y) - 1)] == x).sum()) if len(y) else 0
                linked.append(bool(shared) and 100 * shared >= 75 * (len(x) + len(y) - shared))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(
                pa.array(linked, pa.bool_())
            )

    return (
        pairs.join(sets.toDF("b", "s_b"), "b")
        .join(sets.toDF("a", "s_a"), "a")
        .select("a", "b", "s_a", "s_b")
        .mapInArrow(run, "a long, b long")
    )


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("id"))


def _joined(found: DataFrame, links: DataFrame) -> DataFrame:
    """The components after more links: components of components, and what they are called now."""
    edges = links
    for end in ("a", "b"):
        now = found.select(F.col("node").alias(end), F.col("component").alias(f"c_{end}"))
        edges = edges.join(now, end, "left").withColumn(f"c_{end}", F.coalesce(f"c_{end}", end))
    linked = components(stored(edges.select(F.col("c_a").alias("a"), F.col("c_b").alias("b")), "op5-links"))
    now = linked.select(F.col("node").alias("component"), F.col("component").alias("smallest"))
    known = found.select("node", "component").unionAll(linked.select("node", F.col("node").alias("component")))
    joined = known.distinct().join(now, "component", "left")
    return stored(joined.select("node", F.coalesce("smallest", "component").alias("component")).distinct(), "op5-joined")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Set size, component and verdict of each row of ``docs`` (doc_id, text)."""
    signed = stored(signatures(docs), "op5-signatures")
    classes = stored(
        signed.where("n > 0 and doc_id is not null")
        .groupBy("s1", "s2", "n")
        .agg(F.min("doc_id").alias("rep"), F.min("sig").alias("sig")),
        "op5-classes",
    )
    regions = crowded_regions(forest(classes))
    proposed = stored(_likely(proposals(regions), classes), "op5-proposals")
    first = components(stored(confirm(proposed, sets_of(_ends(proposed), docs)), "op5-links1"))
    members = stored(unresolved(regions, first), "op5-unresolved")
    sets = sets_of(members.select(F.explode(F.array("hub", "m")).alias("id")), docs)
    compared = stored(deltas(members, sets), "op5-deltas")
    links, found = direct_links(compared), first
    # Passages that members add in common get hubs of their own, as long as that joins many of them.
    while True:
        rows = stored(recoloured(compared, found), "op5-coloured")
        held = stored(passages(rows), "op5-held")
        likely = stored(_likely(new_hub_pairs(held), classes), "op5-candidates")
        new = stored(confirm(likely, sets), "op5-new-links")
        links = links.unionAll(new)
        if new.count() * WORTH_A_ROUND < held.count():
            break
        found, links = _joined(found, links), new.limit(0)
    likely = stored(_likely(candidates(rows, held), classes), "op5-candidates")
    found = _joined(found, links.unionAll(confirm(likely, sets)))
    known = stored(
        classes.join(found, classes["rep"] == found["node"], "left").select(
            "s1", "s2", "n", F.coalesce("component", "rep").alias("component")
        ),
        "op5-components",
    )
    joined = signed.join(known, ["s1", "s2", "n"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return joined.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stand for their group; all columns as they are."""
    gone = stored(near_duplicates(docs).where("not kept").select("doc_id").distinct(), "op5-dropped")
    return docs.join(gone, docs["doc_id"] == gone["doc_id"], "left_anti")


# The query in DuckDB's SQL, for ids that do not repeat: all pairs with a common shingle, and all that is
# reachable from each document.
SQL = f"""
WITH RECURSIVE texts AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+') AS ws
    FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) < {SHINGLE} THEN [array_to_string(ws, ' ')] ELSE list_transform(
        range(1, len(ws) - {SHINGLE} + 2), lambda i: array_to_string(ws[i:i + {SHINGLE} - 1], ' ')) END) AS shingle
    FROM texts WHERE len(ws) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
    SELECT a, b FROM (
        SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
        FROM shingles x JOIN shingles y USING (shingle) WHERE x.doc_id <> y.doc_id GROUP BY ALL)
        JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
    WHERE 100 * common >= 75 * (p.n + q.n - common)),
reached AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION
    SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a),
smallest AS (SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM smallest LEFT JOIN sizes USING (doc_id)"""
