"""Benchmark decontamination: broadcast hash set of normalised test n-grams.

Words are what lies between ASCII characters that are neither letters nor
digits, A-Z lower-cased.  A benchmark item gives every run of ``n`` consecutive
words; an item of fewer words gives its whole sequence.  The 64-bit hashes of
these grams form a broadcast set; every window of every document is hashed in
generated code and looked up, and each hit is verified on the words themselves.

Everything is DataFrame code.  The gram table is broadcast only up to
``BROADCAST_BYTES`` of words; beyond that the same join runs shuffled, and a
window carries its own words only.  Which items hold a gram is joined to the
hits afterwards.

Defined results: a null or empty text has no words; very long texts are read
whole, a window at a time; a null item_id counts for
hits but not as an item; rows that share a doc_id are told apart by a hash of
their text, and equal rows get equal results; an empty benchmark hits nothing;
empty documents give an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window

from .common import stage

N_WORDS = 10
#: Bytes of grams that are sent to all tasks: the words, and some 100 bytes a gram besides.
BROADCAST_BYTES = 150 * 1024 * 1024

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all else as it is; plain lower() does that for pure ASCII, and fast."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), _BETWEEN), "")


def gram_items(benchmark: DataFrame, n: int = N_WORDS) -> DataFrame:
    """(gram, item_id): each gram with each item that holds it."""
    w = benchmark.select("item_id", words(F.col("text")).alias("w")).where(F.size("w") > 0)
    size = F.least(F.size("w"), F.lit(n))
    starts = F.sequence(F.lit(1), F.size("w") - size + 1)
    return (w.select("item_id", "w", size.alias("len"), F.explode(starts).alias("at"))
            .select(F.slice("w", F.col("at"), F.col("len")).alias("gram"), "item_id").distinct())


def grams_of(benchmark: DataFrame, n: int = N_WORDS) -> tuple[DataFrame, DataFrame]:
    """The grams (g, h, gram, len), numbered as they are written, and (g, item_id)."""
    held = stage(gram_items(benchmark, n), "gram-items")
    grams = stage(held.select("gram").distinct().select(
        F.monotonically_increasing_id().alias("g"), F.xxhash64("gram").alias("h"), "gram", F.size("gram").alias("len")), "grams")
    items = held.join(grams.select("g", F.col("gram").alias("_gram")), F.col("gram") == F.col("_gram")).select("g", "item_id")
    return grams, items


def hits(docs: DataFrame, grams: DataFrame, n: int = N_WORDS) -> DataFrame:
    """(doc_id, th, at, len, g): verified window hits, ``at`` counted from 0, th the hash of the text."""
    known = grams.agg(F.collect_set("len").alias("lengths"), F.sum(F.octet_length(F.array_join("gram", " ")) + 100).alias("bytes")).first()
    lengths = sorted(known.lengths) or [n]  # at most n values
    few = (known.bytes or 0) <= BROADCAST_BYTES
    at = docs.select("doc_id", F.xxhash64("text").alias("th"), words(F.col("text")).alias("w"))
    # The outer form: the plain one makes Catalyst filter on size(w) first and split every text twice.
    at = at.select("doc_id", "th", "w", F.posexplode_outer("w").alias("at", "_word")).drop("_word")
    if len(lengths) == 1:
        at = at.withColumn("n", F.lit(lengths[0]))
    else:
        at = at.withColumn("n", F.explode(F.array(*[F.lit(x) for x in lengths])))
    at = at.where(F.col("at") + F.col("n") <= F.size("w"))
    window = F.slice("w", F.col("at") + 1, F.col("n"))
    if few:
        scan = at.select("doc_id", "th", "at", "n", "w", F.xxhash64(window).alias("wh"))
        found = scan.join(F.broadcast(grams), F.col("wh") == F.col("h"))
    else:
        scan = at.select("doc_id", "th", "at", "n", window.alias("own"), F.xxhash64(window).alias("wh"))
        found = scan.join(grams, F.col("wh") == F.col("h"))
        window = F.col("own")
    # Verified as two inequalities: an equality would become a join key, and every window be copied to probe with.
    same = (window <= F.col("gram")) & (window >= F.col("gram"))
    return found.where(same & (F.col("n") == F.col("len"))).select("doc_id", "th", "at", "len", "g")


def report(docs: DataFrame, benchmark: DataFrame, n: int = N_WORDS) -> DataFrame:
    """One row per document: words, hit words, items found and the contamination flag."""
    grams, held = grams_of(benchmark, n)
    found = stage(hits(docs, grams, n), "hits").distinct()
    key = ("doc_id", "th")
    order = Window.partitionBy(*key).orderBy("at", "len").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("at") + F.col("len")
    fresh = F.greatest(F.lit(0), end - F.greatest(F.col("at"), F.coalesce(F.max(end).over(order), F.lit(0))))
    covered = found.select(*key, fresh.alias("fresh")).groupBy(*key).agg(F.sum("fresh").cast("long").alias("n_hit"))
    items = (found.select(*key, "g").distinct().join(held, "g")
             .where("item_id IS NOT NULL").select(*key, F.col("item_id").cast("string").alias("item")).distinct()
             .groupBy(*key).agg(F.array_sort(F.collect_list("item")).alias("items")))
    per_doc = (covered.join(items, [covered.doc_id.eqNullSafe(items.doc_id), covered.th == items.th], "left")
               .select(covered.doc_id.alias("_id"), covered.th.alias("_th"), "n_hit", "items"))
    base = docs.select("doc_id", F.xxhash64("text").alias("th"), F.size(words(F.col("text"))).cast("long").alias("n_words"))
    none = F.array().cast("array<string>")
    return (base.join(per_doc, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th")), "left")
            .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
                    F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
                    F.sha2(F.array_join(F.coalesce("items", none), ",").cast("binary"), 256).alias("items_sha256"),
                    (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, n: int = N_WORDS) -> DataFrame:
    """``docs`` without the rows that hold a benchmark window; all columns stay."""
    bad = hits(docs, grams_of(benchmark, n)[0], n).select(F.col("doc_id").alias("_id"), F.col("th").alias("_th")).distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["_id"]) & (F.xxhash64(docs["text"]) == bad["_th"]), "left_anti")


def remove_spans(docs: DataFrame, benchmark: DataFrame, n: int = N_WORDS) -> DataFrame:
    """(doc_id, text, kept_words): each document's normalised words without the hit ones, as an array."""
    found = hits(docs, grams_of(benchmark, n)[0], n).groupBy("doc_id", "th").agg(
        F.array_distinct(F.flatten(F.collect_set(F.sequence(F.col("at"), F.col("at") + F.col("len") - 1)))).alias("gone"))
    found = found.select(F.col("doc_id").alias("_id"), F.col("th").alias("_th"), "gone")
    w = docs.select("doc_id", "text", words(F.col("text")).alias("w"))
    w = w.join(found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_th")), "left")
    kept = F.filter("w", lambda x, i: ~F.array_contains(F.coalesce("gone", F.array().cast("array<int>")), i))
    return w.select("doc_id", "text", kept.alias("kept_words"))


ORACLE = r"""
WITH item_words AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
grams AS (
  SELECT DISTINCT item_id, w[i:i + least(len(w), 10) - 1] AS gram
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM item_words WHERE len(w) > 0)),
doc_words AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
lens AS (SELECT DISTINCT len(gram) AS n FROM grams),
scan AS (
  SELECT doc_id, n, i, w[i:i + n - 1] AS gram
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc_words, lens WHERE len(w) >= n)),
found AS (SELECT s.doc_id, s.i, s.n, g.item_id FROM scan s JOIN grams g ON s.gram = g.gram),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hit h ON d.doc_id = h.doc_id LEFT JOIN items t ON d.doc_id = t.doc_id
"""
