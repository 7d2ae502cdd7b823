"""Ranked lexical search: each item's best documents by a BM25-like score in whole numbers, found by Fagin's threshold algorithm.

Terms are runs of ASCII letters and digits and of all characters above ASCII, A-Z lower-cased. The score sums, over the item's different
terms, the term's weight times the document's impact for it (see weight() and impacts()); statistics are those of all documents.

1. Vocabulary: the items' different terms, in blocks of at most about `block_terms` of them (more items are more passes over the documents).
   A block is broadcast.
2. index(): the forward index, written to the checkpoint folder: a row for each document with its number of terms, and the vocabulary's
   terms in it with their counts. Each task adds one row of sums: how many of its documents hold each term. These give N, L and df
   by an aggregation of one row a task and term.
3. search(): each task cuts its part of the index into shards of at most `shard` postings and turns each into impact-sorted lists.
   For an item the lists of its terms are read round-robin, in strides that double; documents met first are scored by look-ups in
   the forward index; it stops when the threshold, the score that a document would have that stood where all lists have been read to, falls
   strictly below the kth score so far, so that no document is passed over that could still stand among the first k, ties included. The best k of
   a task's earlier shards are taken along, which ends its later shards sooner. Only k rows an item leave a task.
4. The k best of all tasks' rows, by score, then by doc_id.

Terms are told apart by a hash and then by comparing their bytes, so that a collision can't change a count.

Defined results: null and blank texts have no term and are no documents for the statistics; items without terms have no rows; rows of one
item_id are items of their own, each with its own ranks; repeated documents are each ranked; a null doc_id stands behind others of its
score; very long texts are whole; an empty table gives an empty table; other columns of the input are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Words, cut, lists, slices

TOP = 10
BLOCK_TERMS = 200_000
SHARD = 1_000_000
STRIDE = 16
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_GAP = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_SHORT = 32
_INDEX = "doc_id long, n long, terms array<int>, counts array<int>"
_FOUND = "item int, doc_id long, score long"


def weight(n_docs: int, df: int) -> int:
    """A term's weight."""
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What a term of weight 1 gives in a document of n terms that has it tf times."""
    m = 100 - 90 + (90 * n * n_docs) // max(1, n_terms)
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def terms(text: Column) -> Column:
    """The different terms of a text."""
    low = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.array_distinct(F.regexp_extract_all(low, F.lit(TERM), F.lit(0)))


class Vocabulary:
    """Terms by number, and which of a column's words they are."""

    def __init__(self, known: list[str]):
        own = Words(pa.array(known, pa.string()), gap=_GAP)
        self.size = len(known)
        self.order = np.argsort(own.hashes, kind="stable")
        self.sorted = own.hashes[self.order]
        self.lengths = own.ends - own.starts
        self.data, self.starts = own.data, own.starts

    def find(self, w: Words) -> tuple[np.ndarray, np.ndarray]:
        """(places of the words that are known, their terms' numbers)."""
        if not self.size or not len(w.hashes):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        spot = np.minimum(np.searchsorted(self.sorted, w.hashes), self.size - 1)
        at = np.flatnonzero(self.sorted[spot] == w.hashes)
        term = self.order[spot[at]]
        length = (w.ends - w.starts)[at]
        same = length == self.lengths[term]
        at, term, length = at[same], term[same], length[same]
        same = np.ones(len(at), bool)
        for k in range(min(_SHORT, int(length.max()) if len(length) else 0)):  # byte by byte, of the words that are as long
            longer = np.flatnonzero(length > k)
            same[longer] &= w.data[w.starts[at[longer]] + k] == self.data[self.starts[term[longer]] + k]
        for i in np.flatnonzero(length > _SHORT):
            a, b = w.starts[at[i]], self.starts[term[i]]
            same[i] &= (w.data[a : a + length[i]] == self.data[b : b + length[i]]).all()
        return at[same], term[same]


def index(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id, n, terms, counts: a row for each document with a term; with n -1, a row for each task: terms, in how many of its documents, and beside it n -2: how many documents and terms it read."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        held = np.zeros(known.size, np.int64)
        n_docs = n_terms = 0

        def made(ids, n, term, count, sizes):
            return pa.RecordBatch.from_arrays([ids, n, lists(pa.array(term.astype(np.int32)), sizes), lists(pa.array(count.astype(np.int32)), sizes)], ["doc_id", "n", "terms", "counts"])

        for batch in batches:
            for part in slices(batch):
                w = Words(part.column(1), lower=True, gap=_GAP)
                at, term = known.find(w)
                both, tf = np.unique(w.doc()[at] * known.size + term, return_counts=True)
                doc, term = both // max(1, known.size), both % max(1, known.size)
                held += np.bincount(term, minlength=known.size)
                n_docs, n_terms = n_docs + int((w.counts > 0).sum()), n_terms + int(w.counts.sum())
                sizes = np.bincount(doc, minlength=len(w.counts))
                some = sizes > 0
                yield made(part.column(0).filter(pa.array(some)), pa.array(w.counts[some]), term, tf, sizes[some])
        some = np.flatnonzero(held)
        yield made(pa.array([None], pa.int64()), pa.array([-1]), some, held[some], np.array([len(some)]))
        yield made(pa.array([n_docs, n_terms], pa.int64()), pa.array([-2, -3]), some[:0], some[:0], np.array([0, 0]))

    return cut(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text")).mapInArrow(rows, _INDEX))


@dataclass
class Items:
    """Items as numbers of terms: of item i, terms[starts[i] : starts[i + 1]]; weights by term."""

    starts: np.ndarray
    terms: np.ndarray
    weights: np.ndarray
    n_docs: int
    n_terms: int


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0] .. starts[0] + sizes[0], and so on, as one array."""
    if not len(sizes) or not sizes.sum():
        return np.zeros(0, np.int64)
    ends = np.cumsum(sizes)
    return np.repeat(starts - np.concatenate([[0], ends[:-1]]), sizes) + np.arange(ends[-1])


class Shard:
    """Some documents' postings: by document, and by term with falling impacts."""

    def __init__(self, ids: np.ndarray, null: np.ndarray, n: np.ndarray, sizes: np.ndarray, term: np.ndarray, tf: np.ndarray, items: Items):
        self.ids, self.null, self.sizes = ids, null, sizes
        self.firsts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
        doc = np.repeat(np.arange(len(ids)), sizes)
        self.term, self.impact = term, impacts(tf, np.repeat(n, sizes), items.n_docs, items.n_terms)
        by = np.lexsort((-self.impact, term))
        self.list_doc, self.list_impact = doc[by], self.impact[by]
        self.list_ends = np.cumsum(np.bincount(term, minlength=len(items.weights)))
        self.seen = np.zeros(len(ids), np.int64)

    def scores(self, docs: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Look-ups in the forward index: the documents' whole scores."""
        spots = _ranges(self.firsts[docs], self.sizes[docs])
        return np.add.reduceat(weights[self.term[spots]] * self.impact[spots], np.concatenate([[0], np.cumsum(self.sizes[docs])[:-1]]))

    def top(self, mark: int, own: np.ndarray, weights: np.ndarray, best: tuple, k: int, read: list[int] | None = None) -> tuple:
        """best, (scores, null ids, ids), with this shard's documents; own: the item's terms; weights: 0 for all others; mark: tells items apart."""
        ends = self.list_ends[own]
        at = np.where(own > 0, self.list_ends[own - 1], 0)
        w, stride = weights[own], STRIDE
        some = (ends > at) & (w > 0)
        at, ends, w = at[some], ends[some], w[some]
        while len(at):
            size = np.minimum(stride, ends - at)
            met = self.list_doc[_ranges(at, size)]
            if read is not None:
                read.append(len(met))
            new = np.unique(met[self.seen[met] != mark])
            if len(new):
                self.seen[new] = mark
                found = self.scores(new, weights)
                if len(best[0]) >= k:
                    some = found >= best[0][k - 1]
                    new, found = new[some], found[some]
                if len(new):
                    best = tuple(np.concatenate(x) for x in zip(best, (found, self.null[new], self.ids[new]), strict=True))
                    order = np.lexsort((best[2], best[1], -best[0]))[:k]
                    best = tuple(x[order] for x in best)
            at = at + size
            last = self.list_impact[at - 1]
            left = at < ends
            if len(best[0]) >= k and (w * last)[left].sum() < best[0][k - 1]:
                break
            at, ends, w, stride = at[left], ends[left], w[left], stride * 2
        return best


def search(rows: DataFrame, items: Items, k: int = TOP, shard: int = SHARD) -> DataFrame:
    """item (its number), doc_id, score: the best k of each task for each item."""
    sent = rows.sparkSession.sparkContext.broadcast(items)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        none = (np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64))
        n_items = len(known.starts) - 1
        best, held, size = [none] * n_items, [], 0
        weights = np.zeros(len(known.weights), np.int64)

        def passed() -> None:
            one = Shard(*(np.concatenate(x) for x in zip(*held, strict=True)), known)
            for i in range(n_items):
                own = known.terms[known.starts[i] : known.starts[i + 1]]
                weights[own] = known.weights[own]
                best[i] = one.top(i + 1, own, weights, best[i], k)
                weights[own] = 0
            held.clear()

        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                ids, n, term, count = batch.slice(at, 1024).columns
                null = ids.is_null().to_numpy(zero_copy_only=False)
                sizes = np.asarray(pa.compute.list_value_length(term)).astype(np.int64)
                held.append((np.asarray(ids.fill_null(0)), null, np.asarray(n), sizes, np.asarray(term.flatten()).astype(np.int64), np.asarray(count.flatten()).astype(np.int64)))
                size += int(sizes.sum())
                if size >= shard:
                    passed()
                    size = 0
        if held:
            passed()
        for i in range(0, n_items, 1000):
            some = best[i : i + 1000]
            item = np.repeat(np.arange(i, i + len(some)), [len(x[0]) for x in some]).astype(np.int32)
            scores, null, ids = (np.concatenate(x) for x in zip(*some, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(ids, mask=null), pa.array(scores)], ["item", "doc_id", "score"])

    return rows.where("n > 0").mapInArrow(found, _FOUND)


def _block(docs: DataFrame, block: list, k: int, shard: int) -> DataFrame:
    spark = docs.sparkSession
    known = sorted({t for r in block for t in r.terms})
    number = {t: i for i, t in enumerate(known)}
    rows = index(docs, Vocabulary(known))
    sums = cut(rows.where("n < 0"))
    read = {r.n: r.s for r in sums.where("n < -1").groupBy("n").agg(F.sum("doc_id").alias("s")).collect()}
    held = sums.where("n = -1").select(F.explode(F.arrays_zip("terms", "counts")).alias("x")).groupBy("x.terms").agg(F.sum("x.counts").alias("df"))
    df = {r.terms: r.df for r in held.collect()}  # the block's terms at most
    n_docs, n_terms = read.get(-2, 0), read.get(-3, 0)
    weights = np.array([weight(n_docs, df.get(i, 0)) for i in range(len(known))], np.int64)
    starts = np.concatenate([[0], np.cumsum([len(r.terms) for r in block])]).astype(np.int64)
    items = Items(starts, np.array([number[t] for r in block for t in r.terms], np.int64), weights, n_docs, n_terms)
    names = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(block)], "item int, item_id long")
    found = search(rows, items, k, shard)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = found.where("score > 0").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def rank(docs: DataFrame, items: DataFrame, k: int = TOP, block_terms: int = BLOCK_TERMS, shard: int = SHARD) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents (doc_id, text) of each item (item_id, text)."""
    asked = cut(items.select(F.col("item_id").cast("long").alias("item_id"), terms(F.col("text")).alias("terms")).where(F.size("terms") > 0))
    total = asked.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).head()[0]
    blocks = -(-total // block_terms)
    dealt = asked.withColumn("block", F.pmod(F.xxhash64("terms", "item_id"), F.lit(max(1, blocks))))
    out = docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for number in range(blocks):
        block = dealt.where(F.col("block") == number).orderBy("item_id", "terms").drop("block").collect()
        if block:
            out = out.union(_block(docs, block, k, shard))
    return out
