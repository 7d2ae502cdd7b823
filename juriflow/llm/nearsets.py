"""MinHash near-dedup: BagMinHash signatures of multisets of five-word shingles, banded and verified by multiset overlap.

A text is the multiset of its five-word shingles (a text of one to four words has one shingle, all of it). The
signature of a multiset is BagMinHash's: over each shingle's weights 0..c, discretised at whole numbers, runs a Poisson
process of rate 1, each point falling into one of `registers` at random; a register keeps the first point in time. Two
multisets agree in a register with the probability of their weighted Jaccard similarity. The weight axis is cut
hierarchically, [0,1), [1,2), [2,4), [4,8) ..., one process each; in the topmost interval that a count reaches only
in part, points above the count are passed over. Points are made in the order of time and only up to a time by which
all registers are likely filled; a text for which that isn't so gets twice the time, so signatures are exact.

Steps:
1. Texts of the same words, whatever their number, are one: the least row of each stands for them.
2. Signatures are cut into bands; texts that share a band are candidates. A bucket of few texts is compared pair by
   pair. In a larger one every member is compared with the bucket's least member, its head, which joins most of a
   large group of near copies without all pairs.
3. Texts of large buckets that then still hold different components (say, of texts that share one long passage) are
   bucketed anew, by their rarest shingles: two similar texts are sure to share such a bucket, dissimilar ones
   hardly are. These buckets are compared in rounds of ever more heads, leaving out pairs that are already in one
   component, until any two members are in one component or were compared: no pair as similar is left out for a
   bucket's size.
4. Candidates are verified: multiset overlap / union of the shingles >= `similarity`; links make components.

Two documents of similarity 0.8 share one of 25 bands of 5 registers with probability 0.99995.

Defined results: null, empty and blank texts have no shingles, and each is a class of its own; repeated rows and equal
texts share a class; a class is named by the least doc_id in it (null ids come last; a class of null ids only is named
null); representatives are least by doc_id, then by the row's place; very long texts give all their shingles; an empty table gives an empty table; classes() has
no other input columns, keep() all of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import _SEQ, Words, anew, as_long, components, counted, cut, fresh, keyed, lists, mix, powers, slices

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 25
ROWS = 5
#: Buckets of so many texts at most are compared pair by pair at once.
ALL_PAIRS = 16
#: How many times as many heads a round has as the one before it.
GROWTH = 64
#: Any fixed values: they tell the random streams apart.
_INTERVAL, _STEP, _REGISTER, _HEIGHT, _COPY = 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F


def _unit(x: np.ndarray) -> np.ndarray:
    """Uniform in (0, 1]."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0**-53


def multisets(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The texts' shingles: (text, shingle's hash, which occurrence of it in the text, from 0)."""
    hashes, whole = w.runs(SHINGLE)
    doc = w.doc()
    few = np.flatnonzero((w.counts > 0) & (w.counts < SHINGLE))
    short = np.array([mix(np.array([(w.hashes[w.first[d] : w.first[d + 1]] * powers(_SEQ, w.counts[d])).sum() + np.uint64(w.counts[d])]))[0] for d in few], np.uint64)
    doc = np.concatenate([doc[whole], few])
    hashes = np.concatenate([hashes[whole], short])
    # occurrences are counted among the few shingles whose (text, hash) is met again
    both = mix(hashes ^ mix(doc.astype(np.uint64) + np.uint64(_COPY)))
    ordered = np.sort(both)
    again = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    nth = np.zeros(len(hashes), np.int64)
    if len(again):
        at = np.searchsorted(again, both)
        hit = np.flatnonzero((at < len(again)) & (again[np.minimum(at, len(again) - 1)] == both))
        by = hit[np.argsort(both[hit], kind="stable")]
        opens = np.concatenate([[True], both[by][1:] != both[by][:-1]])
        starts = np.flatnonzero(opens)
        nth[by] = np.arange(len(by)) - np.repeat(starts, np.diff(np.append(starts, len(by))))
    return doc, hashes, nth


def signatures(doc: np.ndarray, hashes: np.ndarray, nth: np.ndarray, n_docs: int, registers: int) -> np.ndarray:
    """BagMinHash: the time of the first point in each register of each text (infinite without shingles)."""
    times = np.full((n_docs, registers), np.inf)
    size = np.bincount(doc, minlength=n_docs)
    # interval b > 0 holds weights 2^(b-1) .. 2^b; it is entered by the occurrence that is first in it
    enters = (nth & (nth - 1)) == 0
    d, b = doc[enters], np.zeros(enters.sum(), np.int64)
    above = nth[enters]
    b[above > 0] = np.log2(above[above > 0]).astype(np.int64) + 1
    # how much of its interval a shingle's count covers
    covered = np.ones(len(d), np.int64)
    if (above > 0).any():
        key = mix(hashes ^ mix(doc.astype(np.uint64) + np.uint64(_COPY)))
        many = np.flatnonzero(nth > 0)
        keys, inverse = np.unique(key[many], return_inverse=True)
        most = np.zeros(len(keys), np.int64)
        np.maximum.at(most, inverse, nth[many] + 1)
        count = most[np.searchsorted(keys, key[enters][above > 0])]
        covered[above > 0] = np.minimum(count, 2 * above[above > 0]) - above[above > 0]
    length = np.where(b > 0, 1 << np.maximum(b - 1, 0), 1)
    seed = mix(hashes[enters] + b.astype(np.uint64) * np.uint64(_INTERVAL))
    limit = np.full(n_docs, np.inf)
    some = size > 0
    limit[some] = registers * (np.log(registers) + 3) / size[some]
    todo = some.copy()
    while todo.any():
        live = np.flatnonzero(todo[d])
        at = np.zeros(len(live))
        step = 0
        while len(live):
            step += 1
            x = mix(seed[live] + np.uint64(step * _STEP & (1 << 64) - 1))
            at = at - np.log(_unit(x)) / length[live]
            soon = at <= limit[d[live]]
            live, at, x = live[soon], at[soon], x[soon]
            inside = (length[live] == 1) | (_unit(mix(x ^ np.uint64(_HEIGHT))) * length[live] <= covered[live])
            register = (mix(x ^ np.uint64(_REGISTER)) % np.uint64(registers)).astype(np.int64)
            np.minimum.at(times.reshape(-1), d[live][inside] * registers + register[inside], at[inside])
        todo = some & np.isinf(times).any(axis=1)
        limit[todo] *= 2
        times[todo] = np.inf
    return times


def _sketches(docs: DataFrame, rid: str, bands: int, rows: int) -> DataFrame:
    """(rid, doc_id, words: 128-bit hash of the words, bands: a hash for each band), bands empty without shingles."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                w = Words(batch.column(2))
                n = batch.num_rows
                times = signatures(*multisets(w), n, bands * rows).view(np.uint64).reshape(n, bands, rows)
                key = np.broadcast_to(np.arange(bands, dtype=np.uint64), (n, bands)).copy()
                for r in range(rows):
                    key = mix(key * np.uint64(_STEP) + times[:, :, r])
                some = w.counts > 0
                texts = batch.column(2).cast(pa.binary()).fill_null(b"").to_pylist()
                same = [xxhash.xxh3_128_digest(b" ".join(t.split())) if s else None for t, s in zip(texts, some)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(same, pa.binary()), lists(as_long(key[some].reshape(-1)), some * bands)],
                    ["rid", "doc_id", "words", "bands"],
                )

    lean = docs.select(F.col(rid).alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return lean.mapInArrow(found, "rid long, doc_id long, words binary, bands array<long>")


def _shingles(docs: DataFrame) -> DataFrame:
    """(rid, items): each shingle occurrence's hash, sorted; equal in two texts as often as the shingle is in both."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                doc, hashes, nth = multisets(Words(batch.column(1)))
                item = mix(hashes + nth.astype(np.uint64) * np.uint64(_COPY))
                order = np.lexsort((item, doc))
                counts = np.bincount(doc, minlength=batch.num_rows)
                yield pa.RecordBatch.from_arrays([batch.column(0), lists(as_long(item[order]), counts)], ["rid", "items"])

    return docs.select("rid", "text").mapInArrow(found, "rid long, items array<long>")


def links(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs (u, v) whose multisets' overlap / union is at least similarity; texts: (rid, items)."""
    left = pairs.join(texts.select(F.col("rid").alias("u"), F.col("items").alias("a")), "u")
    both = left.join(texts.select(F.col("rid").alias("v"), F.col("items").alias("b")), "v")
    near = both.where(
        (F.size("a") >= F.lit(similarity) * F.size("b")) & (F.size("b") >= F.lit(similarity) * F.size("a"))
    ).withColumn("common", F.size(F.array_intersect("a", "b")))
    return near.where(F.col("common") >= F.lit(similarity) * (F.size("a") + F.size("b") - F.col("common"))).select("u", "v")


def rare_buckets(texts: DataFrame, similarity: float) -> DataFrame:
    """(band, rid, size, place, common, n): buckets by shingle such that any two texts as similar as that share one.

    Two sets of that similarity share one of the first floor((1 - similarity) * size) + 1 shingles of each, in any one
    order of all shingles; in the order of frequency these are the rarest, so a passage that many texts share makes no bucket.
    place: the shingle's, in that order; common: how many texts have a shingle of the text, on average.
    """
    rows = texts.select("rid", F.size("items").alias("size"), F.explode("items").alias("band"))
    often = rows.groupBy("band").agg(F.count("*").alias("often"))
    place = F.row_number().over(Window.partitionBy("rid").orderBy("often", "band"))
    common = F.avg("often").over(Window.partitionBy("rid"))
    first = rows.join(often, "band").withColumn("place", place).withColumn("common", common)
    first = first.where(F.col("place") <= F.floor(F.col("size") * (1 - similarity) + 1e-9) + 1).where("often > 1")
    shared = first.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    return first.select("band", "rid", "size", "place", "common").join(shared, "band")


def by_heads(finer: DataFrame, again: DataFrame, items: DataFrame, edges: DataFrame, similarity: float) -> DataFrame:
    """edges and further links, so that all pairs of rare_buckets() as similar as that are in one component.

    Each round compares heads with the members of their bucket that are in other components. A small bucket's members are all
    heads in the first round; of a larger one the member whose shingles most texts have is (the original of edited
    copies), then those of a growing range of a hash. A bucket is done when its members that were no heads are in one
    component: of any two members, then, they are in one component or were compared.
    """
    draw = (F.xxhash64("rid").bitwiseAND((1 << 52) - 1) / float(1 << 52)).alias("draw")
    most = finer.where(F.col("n") > ALL_PAIRS).groupBy("band").agg(F.max_by("rid", F.struct("common", "rid")).alias("top"))
    left = cut(finer.join(most, "band", "left").select("band", "rid", "size", "place", "n", draw, F.coalesce(F.col("rid") == F.col("top"), F.lit(False)).alias("top")))
    number = 0
    while True:
        roots = components(edges).withColumnRenamed("v", "rid")
        own = again.select("rid").join(roots, "rid", "left").select("rid", F.coalesce("root", "rid").alias("root"))
        placed = left.join(own, "rid")
        # share of a bucket's members that were heads before this round, and with it
        was, now = (F.lit(float(ALL_PAIRS * GROWTH**k)) / F.col("n") if k >= 0 else F.lit(0.0) for k in (number - 2, number - 1))
        small = F.col("n") <= ALL_PAIRS
        before = F.lit(False) if number == 0 else small | F.col("top") | (F.col("draw") < was)
        heads = small | F.col("top") if number == 0 else ~before & (F.col("draw") < now)
        rest = placed.where(~before).groupBy("band").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("band")
        placed = anew(placed.join(rest, "band"))
        if not placed.limit(1).count():
            return edges
        one = placed.where(heads).select("band", *[F.col(c).alias(f"{c}_h") for c in ("rid", "size", "place", "root")])
        least, other = F.lit(similarity), placed.select("band", "rid", "size", "place", "root")
        # the first shingle that two similar texts share leaves enough of both behind it
        behind = F.least(F.col("size") - F.col("place"), F.col("size_h") - F.col("place_h")) + 1
        near = (F.col("size") >= least * F.col("size_h")) & (F.col("size_h") >= least * F.col("size")) & (behind >= least / (1 + least) * (F.col("size") + F.col("size_h")) - 1e-6)
        met = one.join(other, "band").where((F.col("root") != F.col("root_h")) & near)
        pairs = met.select(F.least("rid", "rid_h").alias("u"), F.greatest("rid", "rid_h").alias("v")).distinct()
        edges = anew(edges.union(links(pairs, items, similarity)))
        left = placed.drop("root")
        number += 1


def classes(docs: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS, rid: str | None = None) -> DataFrame:
    """(rid, doc_id, class_id, class_size, n_verified, kept): a row for each of docs; n_verified: links of its text that were compared and hold, enough to tell the class."""
    own = docs if rid else keyed(docs.select("doc_id", "text"), "rid")
    own = own.select(F.col(rid or "rid").alias("rid"), "doc_id", "text")
    sketch = cut(_sketches(own, "rid", bands, rows))
    texts = cut(sketch.where("words is not null").groupBy("words").agg(F.min("rid").alias("rep"), F.count("*").alias("n")))
    reps = sketch.join(texts.select(F.col("rep").alias("rid")), "rid", "left_semi")
    keys = reps.select("rid", F.explode("bands").alias("band"))
    shared = keys.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    # members of the buckets that hold several different texts
    member = cut(keys.join(shared, "band"))
    within = own.select("rid", "text").join(counted(member.select("rid").distinct()), "rid")
    items = cut(_shingles(within))

    def compared(bucket: DataFrame) -> DataFrame:
        """Pairs to verify of buckets (band, rid, n): all of a small one, each member and the least of a large one."""
        few = bucket.where(F.col("n") <= ALL_PAIRS).select("band", F.col("rid").alias("head"))
        large = bucket.where(F.col("n") > ALL_PAIRS).groupBy("band").agg(F.min("rid").alias("head"))
        pairs = bucket.join(few.union(large), "band").where("rid <> head")
        return pairs.select(F.least("rid", "head").alias("u"), F.greatest("rid", "head").alias("v")).distinct()

    edges = cut(links(compared(member), items, similarity))
    roots = components(edges)
    # large buckets that aren't one component: their texts are bucketed anew, by their rarest shingles
    large = member.where(F.col("n") > ALL_PAIRS).join(roots.withColumnRenamed("v", "rid"), "rid", "left")
    rooted = large.select("band", "rid", F.coalesce("root", "rid").alias("root"))
    mixed = rooted.groupBy("band").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("band")
    again = cut(rooted.join(mixed, "band").select("rid").distinct())
    if again.limit(1).count():
        finer = cut(rare_buckets(items.join(again, "rid"), similarity))
        edges = by_heads(finer, again, items, edges, similarity)
        roots = components(edges)
    degree = edges.select(F.explode(F.array("u", "v")).alias("rep")).groupBy("rep").agg(F.count("*").alias("n_verified"))
    named = (
        texts.select("words", "rep")
        .join(roots.withColumnRenamed("v", "rep"), "rep", "left")
        .join(degree, "rep", "left")
        .select("words", F.coalesce("root", "rep").alias("root"), F.coalesce("n_verified", F.lit(0)).cast("long").alias("n_verified"))
    )
    placed = sketch.select("rid", "doc_id", "words").join(named, "words", "left").withColumn("root", F.coalesce("root", -F.col("rid") - 1))
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid")).alias("least")
    groups = placed.groupBy("root").agg(least, F.count("*").alias("class_size"))
    return placed.join(groups, "root").select(
        "rid",
        "doc_id",
        F.col("least.doc_id").alias("class_id"),
        "class_size",
        F.coalesce("n_verified", F.lit(0)).cast("long").alias("n_verified"),
        (F.col("rid") == F.col("least.rid")).alias("kept"),
    )


def keep(docs: DataFrame, **options) -> DataFrame:
    """One document of each class, with the columns of docs."""
    rid = fresh(docs.columns, "_rid")
    own = keyed(docs, rid)
    gone = counted(classes(own, rid=rid, **options).where("NOT kept").select(F.col("rid").alias(rid)))
    return own.join(gone, rid, "left_anti").select(*docs.columns)
