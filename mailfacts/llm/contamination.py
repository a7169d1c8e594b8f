"""Operator 9: benchmark decontamination by a prefix-filtered set join, in DataFrame operations.

A window is 10 consecutive words of an item (all words of a shorter item). Windows and documents
are compared by their shingles of up to five words. A window that occurs in a document has all its
shingles there, so its rarest one, by occurrences in the documents, is a sufficient prefix: only
documents holding it can hold the window. Its place in the window gives the only possible start
(positional bound), which must leave room for the window on both sides (length bound). Candidates
are verified over the whole window: the shingles at its start and at its end, which together are
all its words, must stand there. Shingles are compared as text, so what is found is exact.

Texts are read once. Exploded rows hold an id and a shingle, never the text. The item shingles
are broadcast up to ``BROADCAST_BYTES`` measured bytes and joined by shuffle beyond. Documents are
identified by id and a hash of their text, so repeated ids do no harm.

Defined results: null and empty texts have no words and are clean; so is everything if the
benchmark has no words. Items with a null id hit words but have no name in ``items_sha256`` and
count in ``n_items`` not at all. Equal items, windows and rows give each row its result once.
Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailfacts.llm.common import LOWER, PLAIN_WORD, UPPER, small_side, stored, text_or_empty

WINDOW = 10
SHINGLE = 5
KEY = ["id", "text_hash"]
NO_ID = -(2**63)


def words(text: Column) -> Column:
    """Words of a text, A-Z lowered. Texts of ASCII only take the faster built-in."""
    lowered = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER)
    )
    return F.regexp_extract_all(lowered, F.lit(PLAIN_WORD), F.lit(0))


def shingles_at(w: Column, size: int) -> Column:
    """The words from each word on, ``size`` of them or what is left."""
    return F.transform(w, lambda x, i: F.concat_ws(" ", x, *(F.get(w, i + j) for j in range(1, size))))


def item_windows(benchmark: DataFrame, window: int) -> DataFrame:
    """(item, text, size): the windows of every item, once each."""
    w = F.col("w")
    last = F.size(w) - F.col("size")
    return (
        benchmark.select(F.col("item_id").cast("string").alias("item"), words(text_or_empty()).alias("w"))
        .where(F.size(w) > 0)
        .select("item", "w", F.least(F.size(w), F.lit(window)).alias("size"))
        .select("item", "size", "w", F.explode(F.sequence(F.lit(0), last)).alias("at"))
        .select("item", "size", F.array_join(F.slice(w, F.col("at") + 1, F.col("size")), " ").alias("text"))
        .distinct()
    )


def window_shingles(windows: DataFrame, sizes: list[int]) -> DataFrame:
    """(wid, size, offset, s): every shingle of every window; ``s`` has ``least(size, 5)`` words."""
    out = None
    for k in sizes:
        of = windows.where(F.least("size", F.lit(SHINGLE)) == k).select("wid", "size", F.split("text", " ").alias("w"))
        one = of.select("wid", "size", F.posexplode(shingles_at(F.col("w"), k)).alias("offset", "s"))
        one = one.where(F.col("offset") <= F.col("size") - k)
        out = one if out is None else out.unionAll(one)
    return out


def places(docs: DataFrame, keys: DataFrame, sizes: list[int]) -> DataFrame:
    """(doc_id, id, text_hash, n_words, pos, sid): every place of an item shingle in a document, and one row
    with ``sid`` -1 for every document, which an empty shingle at its end brings through the join."""
    split = docs.select("doc_id", "id", "text_hash", words(F.col("text")).alias("w"))
    out = None
    for k in sizes:
        found = shingles_at(F.col("w"), k)
        if out is None:
            found = F.concat(found, F.array(F.lit("")))
        one = split.select("doc_id", "id", "text_hash", F.size("w").alias("n_words"), F.posexplode(found).alias("pos", "s"))
        out = one if out is None else out.unionAll(one)
    return out.join(small_side(keys), "s").drop("s")


def prefixes(shingles: DataFrame, found: DataFrame) -> DataFrame:
    """Of each window its rarest shingle; windows with a shingle found nowhere are dropped."""
    counts = found.groupBy("sid").agg(F.count("*").alias("n"))
    rarest = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "offset", "sid")).alias("rarest")
    return (
        shingles.join(counts, "sid", "left")
        .groupBy("wid", "size").agg(rarest).where("rarest.n > 0")
        .select("wid", "size", "rarest.offset", "rarest.sid")
    )


def verified(found: DataFrame, prefix: DataFrame, shingles: DataFrame) -> DataFrame:
    """(id, text_hash, start, size, wid): occurrences of windows, checked from end to end."""
    start = F.col("pos") - F.col("offset")
    candidates = (
        found.join(small_side(prefix), "sid")
        .where((start >= 0) & (start + F.col("size") <= F.col("n_words")))
        .select(*KEY, start.alias("start"), "size", "wid")
    )
    ends = shingles.where((F.col("offset") == 0) | (F.col("offset") == F.col("size") - F.least("size", F.lit(SHINGLE))))
    ends = ends.withColumn("needed", F.count("*").over(Window.partitionBy("wid"))).select("wid", "offset", "sid", "needed")
    asked = candidates.join(small_side(stored(ends, "op9-ends")), "wid").withColumn("pos", F.col("start") + F.col("offset"))
    return (
        asked.join(found.select(*KEY, "pos", "sid"), [*KEY, "pos", "sid"])
        .groupBy(*KEY, "start", "size", "wid").agg(F.count("*").alias("seen"), F.first("needed").alias("needed"))
        .where("seen = needed").drop("seen", "needed")
    )


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Words and hits of each row of ``docs`` (doc_id, text) against ``benchmark`` (item_id, text)."""
    return _find(docs, benchmark, window).drop("text_hash")


def _find(docs: DataFrame, benchmark: DataFrame, window: int) -> DataFrame:
    base = docs.select(docs["doc_id"].alias("doc_id"), text_or_empty().alias("text"))
    base = base.withColumn("id", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))).withColumn("text_hash", F.xxhash64("text"))
    windows = stored(item_windows(benchmark, window), "op9-item-windows")
    texts = windows.select("text", "size").distinct().withColumn("wid", F.monotonically_increasing_id())
    texts = stored(texts, "op9-windows")
    sizes = sorted(r.k for r in texts.select(F.least("size", F.lit(SHINGLE)).alias("k")).distinct().collect())
    sizes = sizes or [SHINGLE]  # at most five
    shingles = stored(window_shingles(texts, sizes), "op9-shingles")
    keys = stored(shingles.select("s").distinct().withColumn("sid", F.monotonically_increasing_id()), "op9-keys")
    shingles = stored(shingles.join(keys, "s").drop("s"), "op9-shingle-ids")
    every = docs.sparkSession.range(1).select(F.lit("").alias("s"), F.lit(-1).cast("long").alias("sid"))
    met = stored(places(base, stored(keys.unionAll(every), "op9-all-keys"), sizes), "op9-places")
    found = stored(met.where("sid >= 0").select(*KEY, "n_words", "pos", "sid").distinct(), "op9-found")
    hits = stored(verified(found, stored(prefixes(shingles, found), "op9-prefixes"), shingles), "op9-hits")
    # Words covered by overlapping occurrences: each adds what reaches beyond all before it.
    end = F.col("start") + F.col("size")
    before = F.max(end).over(Window.partitionBy(*KEY).orderBy("start", "size").rowsBetween(Window.unboundedPreceding, -1))
    covered = (
        hits.select(*KEY, "start", "size").distinct()
        .select(*KEY, F.greatest(F.lit(0), end - F.greatest("start", F.coalesce(before, F.lit(0)))).alias("new"))
        .groupBy(*KEY).agg(F.sum("new").cast("long").alias("n_hit"))
    )
    named = windows.join(texts, ["text", "size"]).select("wid", "item")
    items = (
        hits.select(*KEY, "wid").distinct().join(named, "wid")
        .groupBy(*KEY).agg(F.sort_array(F.collect_set("item")).alias("items"))
    )
    per_text = covered.join(items, KEY, "left")
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    return (
        met.where("sid < 0").join(per_text, KEY, "left")
        .select(
            "doc_id",
            "text_hash",
            F.col("n_words").cast("long").alias("n_words"),
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
            F.coalesce(F.sha2(F.array_join("items", ",").cast("binary"), 256), nothing).alias("items_sha256"),
            (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        )
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` in which no window of an item occurs; all columns as they are."""
    hit = _find(docs, benchmark, window).where("contaminated").select("doc_id", "text_hash").distinct()
    hit = stored(hit, "op9-hit-texts")
    text = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    same = docs["doc_id"].eqNullSafe(hit["doc_id"]) & (text == hit["text_hash"])
    return docs.join(hit, same, "left_anti")


_SQL_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{PLAIN_WORD}')"
SQL = f"""
WITH d AS (SELECT doc_id, {_SQL_WORDS} AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item, {_SQL_WORDS} AS w FROM benchmark),
places AS (
    SELECT item, w, least(len(w), {WINDOW}) AS k, unnest(range(1, len(w) - least(len(w), {WINDOW}) + 2)) AS s
    FROM i WHERE len(w) > 0
),
windows AS (SELECT DISTINCT item, k, array_to_string(w[s:s + k - 1], ' ') AS win FROM places),
sizes AS (SELECT DISTINCT k FROM windows),
starts AS (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM d, sizes WHERE len(w) >= k),
hits AS (
    SELECT doc_id, s, t.k, item
    FROM (SELECT doc_id, s, k, array_to_string(w[s:s + k - 1], ' ') AS win FROM starts) t
    JOIN windows USING (k, win)
),
places_hit AS (SELECT DISTINCT doc_id, unnest(range(s, s + k)) AS p FROM hits),
n AS (SELECT doc_id, count(*) AS n_hit FROM places_hit GROUP BY doc_id),
its AS (
    SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
    FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
    coalesce(n_items, 0) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN its USING (doc_id)
"""
