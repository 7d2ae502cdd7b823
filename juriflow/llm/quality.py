"""Quality rules: hashed n-gram log-likelihood ratio of a trusted target against the raw corpus, beside plain rules.

Every word and every pair of neighbouring words falls into one of `buckets` by hash. Two multinomials over the
buckets are counted: the target's from trusted documents (`labels`: quality 1 and toxic 0), the
raw one from all documents. A document's score is the mean over its n-grams of ln(target / raw), so its length
cancels; it is kept if no base rule fails and the score is at least `threshold`.

Only DataFrame and SQL functions run here. Counts leave a task as `buckets` partial sums at most; the log ratios are
one array of `buckets` doubles whatever the input's size. Trusted ids are broadcast: at most `max_trusted` of them,
those with the least hash, which bounds the broadcast at 16 bytes each; raw counts and scores cover every document.

Defined results: a null text counts as empty; an empty text has no words, score 0 and fails the base rule; repeated
rows are judged alike, each on its own; very long texts are judged whole; an empty table gives an empty table; input columns are kept, but one with a
name of the result's (n_words, score, kept, ...) is replaced; labels with a null doc_id count for nothing; without
any trusted document the ratios tell nothing of quality.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import GAP, fresh, words

#: Fixed values of the base rules.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "[#*$%&|<>]"
#: A mean log ratio below this is unlike the trusted documents.
THRESHOLD = -0.06
BUCKETS = 1 << 16
MAX_TRUSTED = 100_000
SMOOTH = 50.0

RESULT = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept")


def trusted_ids(labels: DataFrame, max_trusted: int = MAX_TRUSTED) -> DataFrame:
    """Ids of documents labelled good, at most max_trusted: those with the least hash."""
    good = labels.where("quality = 1 and toxic = 0 and doc_id is not null").select("doc_id").distinct()
    return good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_trusted)


def _neighbours(w: str) -> str:
    """Hashes of each word with the next, as SQL."""
    return f"zip_with(slice({w}, 1, greatest(0, size({w}) - 1)), slice({w}, 2, size({w})), (a, b) -> xxhash64(a, b))"


def ngram_counts(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, raw, target): how many words and pairs of all documents, and of the trusted ones, each bucket has."""
    good = F.broadcast(trusted.select(F.col("doc_id").alias("_key"), F.lit(1).alias("_good")))
    marked = docs.select(F.col("doc_id").alias("_key"), words(F.col("text")).alias("_w")).join(good, "_key", "left")
    pairs = marked.select("_good", F.inline(F.expr("arrays_zip(_w, slice(_w, 2, greatest(1, size(_w))))")).alias("_a", "_b"))
    one, two = f"xxhash64(_a) & {buckets - 1}L", f"xxhash64(_a, _b) & {buckets - 1}L"
    grams = pairs.select("_good", F.explode(F.expr(f"array({one}, CASE WHEN _b IS NOT NULL THEN {two} END)")).alias("bucket"))
    return (
        grams.where("bucket is not null")
        .groupBy("bucket")
        .agg(F.count("*").alias("raw"), F.count("_good").alias("target"))
    )


def log_ratios(counts: DataFrame, buckets: int = BUCKETS, smooth: float = SMOOTH) -> DataFrame:
    """One row, one array: ln(target / raw) of each bucket.

    The target's multinomial is smoothed by `smooth` n-grams a bucket of the raw corpus' rate, so that a bucket of
    which little is known has a ratio near 1 and a small corpus doesn't favour the trusted documents' own rare words.
    """
    every = counts.sparkSession.range(buckets).withColumnRenamed("id", "bucket").join(counts, "bucket", "left").na.fill(0)
    listed = every.agg(
        F.array_sort(F.collect_list(F.struct("bucket", "raw", "target"))).alias("_all"),
        ((F.sum("target") + 1.0) / (F.sum("raw") + 1.0)).alias("_rate"),
    )
    return listed.select(
        F.expr(f"transform(_all, x -> ln((x.target / _rate + {smooth!r}D) / (x.raw + {smooth!r}D)))").alias("ratios")
    )


def annotate(
    docs: DataFrame,
    labels: DataFrame,
    buckets: int = BUCKETS,
    threshold: float = THRESHOLD,
    max_trusted: int = MAX_TRUSTED,
    smooth: float = SMOOTH,
) -> DataFrame:
    """docs with the columns of RESULT."""
    if buckets & (buckets - 1):
        raise ValueError("buckets must be a power of two")
    counts = ngram_counts(docs, trusted_ids(labels, max_trusted), buckets)
    known = log_ratios(counts, buckets, smooth).head()[0]  # `buckets` doubles, whatever the input
    ratios = F.split(F.lit(",".join(map(repr, known))), ",").cast("array<double>")  # folded to a constant
    base = docs.drop(*[c for c in docs.columns if c.lower() in RESULT])
    names = ("_w", "_two", "_three", "_lines", "_bits", "_mask", "_row")
    w, two, three, lines, bits, mask, row = (fresh(base.columns, x) for x in names)
    found = (
        base.withColumn(w, words(F.col("text")))
        .withColumn(two, F.expr(_neighbours(w)))
        .withColumn(
            three,
            F.expr(
                f"zip_with(slice({two}, 1, greatest(0, size({two}) - 1)), slice({w}, 3, size({w})), (h, c) -> xxhash64(h, c))"
            ),
        )
        .withColumn(bits, F.expr(f"int(length(bin(size({w}))))"))
        .withColumn(mask, F.expr(f"shiftleft(1L, int(length(bin(size({w}))))) - 1"))
        .withColumn(lines, F.expr("filter(split(coalesce(text, ''), '\n'), x -> x rlike '[^\\x20\\x09-\\x0D]')"))
        # a filter on the verdict stops at this column; below it, lists would be built anew for each of their elements
        .withColumn(row, F.monotonically_increasing_id())
    )

    # Only texts with some hash twice are sorted: hash above, place in the low bits; neighbours are then compared by word.
    ordered = f"sort_array(transform({three}, (h, i) -> shiftleft(h, {bits}) | bigint(i)))"
    word = f"element_at({w}, int({{}}) + {{}})"
    same = " AND ".join(f"{word.format('x.p', k)} = {word.format('x.q', k)}" for k in (1, 2, 3))
    twice = (
        "filter(zip_with(slice(s, 1, size(s) - 1), slice(s, 2, size(s)), (a, b) -> "
        f"CASE WHEN shiftrightunsigned(a ^ b, {bits}) = 0 THEN struct(a & {mask} AS p, b & {mask} AS q) END), "
        f"x -> x IS NOT NULL AND {same})"
    )
    covered = f"flatten(transform({twice}, x -> array(x.p, x.p + 1, x.p + 2, x.q, x.q + 1, x.q + 2)))"
    repeats = (
        f"CASE WHEN size(array_distinct({three})) = size({three}) THEN 0 "
        f"ELSE element_at(transform(array({ordered}), s -> size(array_distinct({covered}))), 1) END"
    )
    grams = F.concat(F.transform(w, lambda x: F.xxhash64(x)), F.col(two))
    total = F.aggregate(grams, F.lit(0.0), lambda a, h: a + F.get(ratios, h.bitwiseAND(F.lit(buckets - 1)).cast("int")))
    judged = found.select(
        *base.columns,
        F.size(w).cast("long").alias("n_words"),
        F.length(F.regexp_replace(F.coalesce("text", F.lit("")), GAP, "")).cast("long").alias("word_chars"),
        F.regexp_count(F.coalesce("text", F.lit("")), F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.expr(f"bigint(size({lines}) - size(array_distinct({lines})))").alias("n_dup_lines"),
        F.expr(f"bigint({repeats})").alias("n_repeat_words"),
        F.coalesce(total / F.nullif(F.size(w) + F.size(two), F.lit(0)), F.lit(0.0)).alias("score"),
        row,
    )
    failed = F.expr(f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words")
    kept = F.expr(f"NOT base_failed AND score >= {threshold!r}D AND {row} >= 0")
    return judged.withColumn("base_failed", failed).withColumn("kept", kept).drop(row)


def keep(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that pass, with the columns of docs."""
    clash = {c.lower() for c in docs.columns} & {*RESULT}
    if clash:  # hold replaced columns under other names meanwhile
        names = {c: fresh(docs.columns, f"_own_{c}") for c in docs.columns if c.lower() in clash}
        held = docs.withColumnsRenamed(names)
        return annotate(held, labels, **options).where("kept").select(*[F.col(names.get(c, c)).alias(c) for c in docs.columns])
    return annotate(docs, labels, **options).where("kept").select(*docs.columns)
