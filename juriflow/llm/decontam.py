"""Benchmark decontamination: SimHash of item-sized windows, a multi-index of Hamming blocks, exact weighted-shingle check.

Items and documents are words (lower-cased), a window of an item is as many neighbouring words of a document as the item has (a
shorter document is one window), and its shingles are all runs of five words, weighted by how often they occur (fewer than five
words: one shingle of all). A document is contaminated by an item if a window of that item's size has weighted
Jaccard similarity of `similarity` or more with it.

1. Windows: for each size that items have, the windows of a document that could be similar to any item of that size. One as
   similar as that shares o = ceil(similarity * (n + m) / (1 + similarity)) of its m shingles with the item's n, so
   windows with fewer than o shingles of items of that size, whichever they are, get no fingerprint: no window that can
   qualify is passed over, and ordinary text has next to none.
2. SimHash: 64 bits, each the majority of that bit over the window's shingles (counted in 32 longs of two 32-bit lanes).
3. Multi-index Hamming: which items a window may hold is found by fingerprints alone. They are cut into `radius` + 1 blocks, one
   table for each; of two fingerprints within the radius at least one block is equal, so joins by block and value find all
   of them, and bit_count then holds the distance against the radius. Windows of an item's size are looked up among the items of
   that size, windows that are a whole short document among the longer items.
   At similarity 0.8 the distance is 9.7 bits on average, with a standard deviation of 2.9; the radius is 4.6 of them above.
4. Exact: the sum over shingles of the smaller weight, over the sum of the larger, of the pairs that the index gave.

Only DataFrame and SQL functions run here. The benchmark's shingles are broadcast if there are at most `broadcast_rows`
of them (16 bytes each), else joined by a shuffle. Texts are shuffled only if windows lie in more documents than a broadcast holds.

Defined results: null and empty texts and items match nothing; repeated rows match alike, each row on its own; items of
one text each match under their own id; rows of benchmark that agree in item_id count as different items of one id; very
long texts and items are whole (lanes hold 2 ** 31 shingles); ties between windows go to the first start;
an empty table gives an empty table; hits() has no other input columns, drop() all of docs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import counted, cut, fresh, keyed, words

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 23
BROADCAST_ROWS = 1_000_000


def _zipped(w: str) -> str:
    tails = ", ".join(f"slice({w}, {k}, greatest(1, size({w})))" for k in range(2, SHINGLE + 1))
    return f"arrays_zip({w}, {tails})"


def shingle_rows(df: DataFrame, keep: list[str], w: str = "_w") -> DataFrame:
    """A row for each shingle of the words in w: keep, pos (from 0) and h."""
    rows = df.where(F.size(w) > 0).select(*keep, F.size(w).alias("_n"), F.posexplode(F.expr(_zipped(w))).alias("pos", "_s"))
    h = F.xxhash64(*[F.col("_s").getField(str(k) if k else w) for k in range(SHINGLE)])
    last = F.col("_s").getField(str(SHINGLE - 1))
    return rows.where(last.isNotNull() | ((F.col("_n") < SHINGLE) & (F.col("pos") == 0))).select(*keep, "pos", h.alias("h"))


def fingerprints(rows: DataFrame, by: list[str]) -> DataFrame:
    """by, fp: SimHash of each group's shingles h; n: how many there are."""
    lanes = [F.sum(F.expr(f"shiftrightunsigned(h, {k}) & 4294967297L")).alias(f"_l{k}") for k in range(32)]
    summed = rows.groupBy(*by).agg(F.count("*").alias("n"), *lanes)
    bits = [f"CASE WHEN 2 * (shiftrightunsigned(_l{b % 32}, {b // 32 * 32}) & 4294967295L) > n THEN shiftleft(1L, {b}) ELSE 0L END" for b in range(64)]
    return summed.select(*by, "n", F.expr(" | ".join(bits)).alias("fp"))


def blocks(fp: str = "fp", radius: int = RADIUS) -> Column:
    """The fingerprint's radius + 1 blocks, as structs of number and value."""
    n, out, at = radius + 1, [], 0
    for k in range(n):
        width = 64 // n + (k < 64 % n)
        out.append(f"struct({k} AS block, shiftrightunsigned({fp}, {at}) & {(1 << width) - 1 if width < 64 else -1}L AS value)")
        at += width
    return F.expr(f"array({', '.join(out)})")


def near(prints: DataFrame, items: DataFrame, radius: int = RADIUS) -> DataFrame:
    """The index: prints' columns, item, n_item and distance, for the items of that size whose fingerprint is within radius.

    prints: fp, n (a window's shingles) and whole (it is a whole text); items: item, fp and n.
    """
    index = items.select("item", F.col("n").alias("n_item"), F.col("fp").alias("fp_item"), F.explode(blocks("fp", radius)).alias("b"))
    keyed_ = prints.withColumn("b", F.explode(blocks("fp", radius)))
    same = keyed_.join(index.withColumn("n", F.col("n_item")), ["n", "b"])
    longer = keyed_.where("whole").join(index, "b").where("n_item > n")
    distance = F.bit_count(F.col("fp").bitwiseXOR(F.col("fp_item"))).alias("distance")
    columns = [*prints.columns, "item", "n_item"]
    return same.select(*columns, distance).union(longer.select(*columns, distance)).where(F.col("distance") <= radius).distinct()


def hits(
    docs: DataFrame,
    items: DataFrame,
    similarity: float = SIMILARITY,
    radius: int = RADIUS,
    broadcast_rows: int = BROADCAST_ROWS,
    rid: str | None = None,
) -> DataFrame:
    """(rid, doc_id, item_id, start_word, similarity, distance): each document's best window for each item that it has."""
    own = docs if rid else keyed(docs.select("doc_id", "text"), "rid")
    own = own.select(F.col(rid or "rid").alias("rid"), "doc_id", "text")
    bench = cut(items.select("item_id", words(F.lower("text")).alias("_w")).withColumn("item", F.monotonically_increasing_id()))
    item_rows = shingle_rows(bench, ["item"])
    weights = cut(item_rows.groupBy("item", "h").agg(F.count("*").alias("weight")))
    small = weights.count() <= broadcast_rows

    def light(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if small else df

    known = cut(fingerprints(item_rows, ["item"]))
    # 1. windows that could be similar to some item of their size
    listed = own.select("rid", words(F.lower("text")).alias("_w"))
    seeds = weights.join(light(known), "item").select("h", F.col("n").alias("n_item")).distinct()
    found = shingle_rows(listed.withColumn("_size", F.size("_w")), ["rid", "_size"]).join(light(seeds), "h")
    of = found.groupBy("rid", "n_item").agg(F.greatest(F.lit(1), F.first("_size") - (SHINGLE - 1)).alias("n_doc"), F.array_sort(F.collect_list("pos")).alias("at"))
    sized = of.withColumn("m", F.least("n_item", "n_doc").cast("int"))
    sized = sized.withColumn("need", F.expr(f"int(ceil({similarity!r}D * (n_item + m) / {1 + similarity!r}D - 1e-9))")).where("size(at) >= need")
    run = "element_at(at, k + need - 1)"
    ranges = (
        f"filter(transform(sequence(1, greatest(1, size(at) - need + 1)), k -> CASE WHEN size(at) >= need AND {run} - element_at(at, k) < m "
        f"THEN struct(greatest(0, {run} - m + 1) AS lo, least(element_at(at, k), n_doc - m) AS hi) END), x -> x IS NOT NULL AND x.lo <= x.hi)"
    )
    starts = sized.withColumn("_r", F.expr(ranges)).where("size(_r) > 0")
    starts = starts.select(
        "rid", "m", (F.col("m") == F.col("n_doc")).alias("whole"), F.explode(F.expr("array_distinct(flatten(transform(_r, x -> sequence(x.lo, x.hi))))")).alias("start")
    )
    starts = cut(starts.distinct())
    texts = own.join(counted(starts.select("rid").distinct()), "rid").select("rid", words(F.lower("text")).alias("_w"))
    windows = starts.join(texts, "rid").select("rid", "m", "whole", "start", F.expr(f"slice(_w, start + 1, m + {SHINGLE - 1})").alias("_w"))
    by = ["rid", "m", "whole", "start"]
    rows = cut(shingle_rows(windows, by))
    # 2. and 3. fingerprints, and the items that the index gives for them
    pairs = near(fingerprints(rows, by), light(known), radius).select("rid", "m", "start", "item", "n_item", "distance")
    # 4. exact
    by = ["rid", "m", "start", "item", "n_item", "distance"]
    both = rows.groupBy("rid", "m", "start", "h").agg(F.count("*").alias("c")).join(pairs, ["rid", "m", "start"])
    overlap = both.join(light(weights), ["item", "h"]).groupBy(*by).agg(F.sum(F.least("c", "weight")).alias("common"))
    exact = overlap.withColumn("similarity", F.expr("common / (m + n_item - common)"))
    best = F.max(F.struct("similarity", (-F.col("start")).alias("back"), "distance")).alias("best")
    leaks = exact.where(F.col("similarity") >= similarity).groupBy("rid", "item").agg(best)
    named = leaks.join(bench.select("item", "item_id"), "item").join(own.select("rid", "doc_id"), "rid")
    return named.select(
        "rid", "doc_id", "item_id", (-F.col("best.back")).cast("long").alias("start_word"),
        F.col("best.similarity").alias("similarity"), F.col("best.distance").cast("int").alias("distance"),
    )


def drop(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents without any item's window, with the columns of docs."""
    rid = fresh(docs.columns, "_rid")
    own = keyed(docs, rid)
    bad = counted(hits(own, items, rid=rid, **options).select(F.col("rid").alias(rid)).distinct())
    return own.join(bad, rid, "left_anti").select(*docs.columns)
