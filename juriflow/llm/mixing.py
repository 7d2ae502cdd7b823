"""Mixing sources to target weights: hash-random keys, range blocks, distributed prefix sums and an exact cut.

Every document gets a random key, the first 60 bits of md5(seed, doc_id), or of its text where it has no id. Keys are uniform, so
equal ranges of them (`blocks` of each source) are the quantiles that a range sort would find, without sampling. Block totals, a
table without texts, are summed over the blocks before. A source of target T and size S is repeated floor(T / S)
times whole, and the next epoch is cut after exactly T mod S words. Blocks that end before the cut are taken whole,
those that begin behind it not at all; only in the one block of a source in which its budget ends documents are sorted and
their words summed, and the document at the cut gives its first words only. So texts are not shuffled, but for those blocks.

Targets are weights' shares of the wanted total. A source stops at `most` times its size; the excess goes to the
others by weight until none is above (in closed form: sources in order of the level at which they fill up).

The number of blocks follows the number of rows, so that a block, the unit that one task sorts, stays bounded also for
a source with a third of all rows. Sources are a table of one row each, whose window runs in one task and can spill: millions of
sources are fine, and there are no more blocks than rows.

Defined results: null text is size 0; a null source is a source of its own, last in order; documents without words are
taken 0 times; an empty table gives an empty table; rows of one doc_id are ordered by size, then by md5 of their text, and rows
that agree in that, too, in any way, which changes nothing; all-empty sources get target 0; very long texts are counted whole; extra columns are kept by mix(), except names of the
result's (size, source_size, target, taken, copy, take_words), which are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import counted, cut, fresh, n_words, words

#: Fixed values of the mix: weights of the sources by code point, repeating; wanted share of all words; most epochs.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
SEED = "mix-1"
BLOCK_ROWS = 200_000

RESULT = ("size", "source_size", "target", "taken")


def hash_key(doc_id: Column, text: Column, seed: str = SEED) -> Column:
    """60 hash-random bits of a document's id; of its text where there is none, so that such documents don't share one key."""
    text = F.concat(F.lit(f"{seed}/"), F.coalesce(doc_id.cast("string"), F.concat(F.lit("null/"), F.md5(F.coalesce(text, F.lit(""))))))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, source_size) -> with target, a double."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    which = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (which + 1).cast("int"))
    weighed = sizes.withColumn("_weight", weight).withColumn("_full", F.col("source_size") * F.lit(float(most)))
    fill = Window.orderBy(F.col("_full") / F.col("_weight"), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    rest = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.partitionBy()) * F.lit(share)
    level = (total - F.coalesce(F.sum("_full").over(before), F.lit(0.0))) / F.sum("_weight").over(rest)
    filled = weighed.withColumn("_level", level)
    # a source that doesn't fill up takes its weight's share at the level of the first such source
    free = F.min(F.when(F.col("_level") * F.col("_weight") < F.col("_full"), F.struct(F.col("_full") / F.col("_weight"), "_level"))).over(
        Window.partitionBy()
    )
    target = F.least(F.col("_full"), F.coalesce(free["_level"] * F.col("_weight"), F.col("_full")))
    return filled.select(*sizes.columns, target.alias("target"))


def take(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
    seed: str = SEED,
    blocks: int | None = None,
) -> DataFrame:
    """docs with the columns of RESULT: its words, its source's words and target, and how many words of it are taken."""
    base = docs.drop(*[c for c in docs.columns if c.lower() in RESULT])
    key, block, before, ahead, own, tie, total, rest = (fresh(base.columns, x) for x in ("_key", "_block", "_before", "_ahead", "_own", "_tie", "_total", "_rest"))
    if blocks is None:
        blocks = max(16, docs.count() // BLOCK_ROWS)
    width = (1 << 60) // blocks + 1

    def placed_in(df: DataFrame) -> DataFrame:  # own: the source, with a value for null, so that joins and windows share one key
        df = df.withColumn(key, hash_key(F.col("doc_id"), F.col("text"), seed)).withColumn(block, F.expr(f"{key} div {width}L"))
        return df.withColumn(own, F.concat(F.when(F.col("source").isNull(), "0").otherwise("1"), F.coalesce("source", F.lit(""))))

    lean = placed_in(docs.select("doc_id", "source", "text")).withColumn("size", n_words(F.col("text")))
    totals = cut(lean.groupBy(own, "source", block).agg(F.sum("size").alias(total)))
    goals = targets(totals.groupBy(own, "source").agg(F.sum(total).alias("source_size")), weights, share, most)
    earlier = Window.partitionBy(own).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    fronts = totals.select(own, block, total, F.coalesce(F.sum(total).over(earlier), F.lit(0)).alias(ahead)).join(goals.drop("source"), own)
    fronts = counted(fronts.withColumn(rest, F.expr("cast(round(target) as bigint) % greatest(source_size, 1)")))
    met = placed_in(base).join(fronts, [own, block])
    split = (F.col(ahead) < F.col(rest)) & (F.col(ahead) + F.col(total) > F.col(rest))
    size = n_words(F.col("text"))
    plain = met.where(~split).withColumn("size", size).withColumn(before, F.when(F.col(ahead) < F.col(rest), F.col("size")).otherwise(0))
    inside = Window.partitionBy(own, block).orderBy(key, "doc_id", "size", tie).rowsBetween(Window.unboundedPreceding, -1)
    at_cut = met.where(split).withColumn("size", size).withColumn(tie, F.md5(F.coalesce("text", F.lit(""))))
    front = F.coalesce(F.sum("size").over(inside), F.lit(0))
    at_cut = at_cut.withColumn(before, F.greatest(F.lit(0), F.least(F.col("size"), F.col(rest) - F.col(ahead) - front))).drop(tie)
    whole = F.expr("cast(round(target) as bigint) div greatest(source_size, 1)")
    taken = (whole * F.col("size") + F.col(before)).cast("long").alias("taken")
    return plain.select(*base.columns, "size", "source_size", "target", taken).union(at_cut.select(*base.columns, "size", "source_size", "target", taken))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: a row for each copy of a document, whose text is cut where the budget ends.

    Columns of docs, then copy (from 1) and take_words (words of this copy). A whole copy has the text unchanged.
    """
    taken = take(docs.drop(*[c for c in docs.columns if c.lower() in ("copy", "take_words")]), **options)
    copies = taken.withColumn("copy", F.explode(F.expr("sequence(1, int((taken + size - 1) div greatest(size, 1)))"))).where("taken > 0")
    cut_ = copies.withColumn("take_words", F.expr("least(size, taken - (copy - 1) * size)"))
    text = F.when(F.col("take_words") >= F.col("size"), F.col("text")).otherwise(
        F.array_join(F.slice(words(F.col("text")), F.lit(1), F.col("take_words").cast("int")), " ")
    )
    out = cut_.withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast("long"))
    return out.select(*[c for c in docs.columns if c.lower() not in (*RESULT, "copy", "take_words")], "copy", "take_words")
