"""Benchmark decontamination by size-partitioned MinHash containment search.

Items (short test texts) are looked for inside documents of any length:
an item is contained where ``100 * |item & document| >= threshold * |item|``
over distinct 5-word shingles of normalised words (lower case, letters and
digits only).

Search.  Jaccard similarity of a short item and a long document is near zero,
so the sketch is taken of the item alone.  Items are partitioned by size
(powers of two).  In a partition with sizes up to u, a contained item misses
at most u * (100 - threshold) / 100 of its shingles, so of its k least shingle
hashes, k being one more than that, at least one stands in the document.  The
k-MinHash tables of all partitions are joined to the documents' shingles: a
hit makes the (document, item) pair a candidate, and no contained item is
missed.  Verification joins the whole shingle sets of the candidate pairs, by
the shingles themselves, not their hashes.

The items' sketches are joined as a broadcast only below ``broadcast_rows``
(counted first); beyond, the join is left to Spark.

All of it is DataFrame functions.  Edge cases: null or empty texts contain and
are contained in nothing; an item or document of fewer than five words has its
whole word sequence as one shingle; equal items are each reported; the rows
of one id are one set of shingles, so a repeated row changes nothing; an empty
table gives an empty result; extra columns are ignored.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, small


def words(text: Column) -> Column:
    """Normalised words."""
    flat = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{M}\p{N}]+", " "))
    return F.when(flat == "", F.expr("cast(array() as array<string>)")).otherwise(F.split(flat, " "))


def hashes(w: Column, k: int) -> Column:
    """Hashes of the k-word shingles of a word array; null without words."""
    n = F.size(w)
    return F.when(n >= k, F.transform(F.sequence(F.lit(0), n - k), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(k)]))).when(
        n > 0, F.array(F.xxhash64(F.array_join(w, " "))))


def shingles(w: Column, k: int) -> Column:
    """The k-word shingles themselves."""
    n = F.size(w)
    return F.when(n >= k, F.transform(F.sequence(F.lit(1), n - k + 1), lambda i: F.array_join(F.slice(w, i, k), " "))).when(
        n > 0, F.array(F.array_join(w, " ")))


def item_sketches(items: DataFrame, threshold: int, k: int) -> DataFrame:
    """(item_id, n, size_class, h): the k-MinHash table of all size
    partitions; h are the least distinct shingle hashes of an item."""
    t = (items.select("item_id", F.explode(hashes(F.col("words"), k)).alias("h"))
         .groupBy("item_id").agg(F.array_sort(F.collect_set("h")).alias("hs")))
    t = t.select("item_id", F.size("hs").alias("n"), "hs", F.ceil(F.log2(F.size("hs"))).cast("int").alias("size_class"))
    most = F.expr(f"cast(floor(shiftleft(1, size_class) * {100 - threshold} / 100) as int) + 1")
    return (t.withColumn("take", F.least(F.col("n"), most))
            .select("item_id", "n", "size_class", F.explode(F.slice("hs", F.lit(1), F.col("take"))).alias("h")))


def contaminated(docs: DataFrame, items: DataFrame, threshold: int = 80, k: int = 5, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", broadcast_rows: int = 500_000) -> DataFrame:
    """(doc_id, item_id, n_item, n_shared, containment) for every document
    that contains an item."""
    # the words are a column of their own: every shingle refers to them
    d = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), words(F.col(f"`{text_col}`").cast("string")).alias("words"))
    it = items.select(F.col(f"`{item_col}`").cast("long").alias("item_id"), words(F.col(f"`{item_text_col}`").cast("string")).alias("words"))
    sketch = item_sketches(it, threshold, k)
    keys = small(sketch.select("h", "item_id").distinct(), broadcast_rows)
    probe = d.select("doc_id", F.explode(hashes(F.col("words"), k)).alias("h"))
    found = checkpointed(probe.join(keys, "h").select("doc_id", "item_id").distinct())
    # verification: the candidates' whole sets, as shingle texts
    texts = d.join(small(found.select("doc_id").distinct()), "doc_id", "left_semi")
    have = texts.select("doc_id", F.explode(F.array_distinct(shingles(F.col("words"), k))).alias("shingle"))
    want = it.select("item_id", F.explode(F.array_distinct(shingles(F.col("words"), k))).alias("shingle")).distinct()
    n_item = want.groupBy("item_id").agg(F.count("*").alias("n_item"))
    # the pairs the search found ask for their item's shingles; so a shingle
    # that many items and documents share is only met for found pairs.  Rows
    # of one id count a shingle once
    asked = found.join(want, "item_id")
    shared = (asked.join(have.distinct(), ["doc_id", "shingle"]).groupBy("doc_id", "item_id").agg(F.count("*").alias("n_shared")))
    return (shared.join(n_item, "item_id").where(f"100 * n_shared >= {threshold} * n_item")
            .select("doc_id", "item_id", "n_item", "n_shared", F.round(F.col("n_shared") / F.col("n_item"), 6).alias("containment")))
