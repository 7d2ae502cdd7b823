"""Substring dedup: prefix-partitioned suffix trees over words, whose internal nodes of `window` words or more are repeats.

A suffix begins at each word of each text. A window of `window` words is repeated if its suffix shares a path of that depth
with another suffix, that is, if it hangs below an internal node of depth `window` or more. Such nodes are the maximal
repeats, and the words on their paths are removed.

Suffixes are split by what they begin with. In a suffix' first `window` words the run of `prefix` words with the least hash,
leftmost if equal, is its anchor; suffixes that share `window` words share their anchor, so a group of one anchor holds all
suffixes that can meet below a deep node. Neighbouring suffixes of one anchor are one row (about 7 in 100 words begin one). A
group of one row holds no repeat and is passed over. A group of up to `group` rows is a subtree that a task holds in memory: the
rows' words, which are sent along and compared themselves, become a sorted suffix array by doubling, neighbours' common
lengths (LCP) are the depths of the tree's internal nodes, and a suffix' deepest node gives the repeat that begins there. A
group of more rows is split by a longer prefix, half of what a window adds to the anchor, to its left or to its right. One
that is still too large is split by the whole window: then the group itself is the node, and its leaves are only counted.

Rows of frequent anchors don't meet in one task: frequent ones, few as they are, are told apart by a counted broadcast
(a shuffle beyond `common.BROADCAST_ROWS`) before anything is joined. What is shuffled: anchors twice, the texts once (both
joins read the same exchange) and the words of repeated rows. Repeats are judged on the input, whatever else is removed.

Defined results: null, empty and blank texts have no words; texts of fewer words than a window lose none; repeated rows
and equal texts lose all words if they are as long as a window; a window that overlaps its own other occurrence counts;
very long texts are cut nowhere; an empty table gives an empty table; the result has doc_id and the columns of RESULT only, spans() rid, lo and hi.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, Words, as_long, cut, keyed, slices

WINDOW = 35
PREFIX = 8
GROUP = 2_000
RESULT = ("n_words", "n_removed", "kept_sha256")


def anchored(w: Words, window: int, prefix: int, lengthened: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of neighbouring windows with one anchor: (prefix' hash, first window's word, number of windows), and all windows' hashes.

    lengthened: runs are cut in two, and the prefix has half of what a window adds to it: windows that begin well before
    the anchor have it lengthened to the left, the others to the right.
    """
    path, whole = w.runs(window)
    runs, _ = w.runs(prefix)
    n = len(runs)
    least, at = runs.copy(), np.arange(n)
    width, span = 1, window - prefix + 1
    while width < span:  # least of twice as many, the left one if equal
        step = min(width, span - width)
        other, place = least[step:], at[step:]
        later = other < least[:-step] if step < n else np.zeros(0, bool)
        if step < n:
            least[:-step] = np.where(later, other, least[:-step])
            at[:-step] = np.where(later, place, at[:-step])
        width += step
    start = np.flatnonzero(whole)
    anchor = at[start]
    new = np.ones(len(start), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)
    if not lengthened:
        head = np.flatnonzero(new)
        return runs[anchor[head]], start[head], np.diff(np.append(head, len(start))), path
    more = (window - prefix + 1) // 2
    left = anchor - start >= more
    new[1:] |= left[1:] != left[:-1]
    head = np.flatnonzero(new)
    long_, _ = w.runs(prefix + more)
    key = long_[np.where(left[head], anchor[head] - more, anchor[head])] ^ left[head].astype(np.uint64)
    return key, start[head], np.diff(np.append(head, len(start))), path


def _anchors(docs: DataFrame, window: int, prefix: int) -> DataFrame:
    """(anchor, rid, at): a row for each run; at: its first word in the text."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                w = Words(batch.column(1))
                anchor, start, _, _ = anchored(w, window, prefix)
                doc = np.searchsorted(w.first, start, "right") - 1
                rid = batch.column(0).take(pa.array(doc))
                yield pa.RecordBatch.from_arrays(
                    [as_long(anchor), rid, pa.array((start - w.first[doc]).astype(np.int32))], ["anchor", "rid", "at"]
                )

    return docs.select("rid", "text").mapInArrow(found, "anchor long, rid long, at int")


def _rows(docs: DataFrame, window: int, prefix: int, lengthened: bool) -> DataFrame:
    """docs: (rid, doc_id, text, ats) -> (anchor, rid, at, n, words): the suffixes of the rows that ats lists; words: the text they run over."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                w = Words(batch.column(2))
                anchor, start, size, _ = anchored(w, window, prefix)
                ats = batch.column(3)
                doc = np.repeat(np.arange(batch.num_rows), np.asarray(pa.compute.list_value_length(ats)))
                wanted = np.asarray(ats.flatten()).astype(np.int64) + w.first[doc]
                mine = np.isin(start, wanted)
                if lengthened:  # suffixes of the wanted rows, each row in one piece or two
                    piece, first, n, _ = anchored(w, window, prefix, True)
                    mine = mine[np.searchsorted(start, first, "right") - 1]
                    anchor, start, size = piece, first, n
                anchor, start, size = anchor[mine], start[mine], size[mine]
                doc = np.searchsorted(w.first, start, "right") - 1
                raw = w.data.tobytes()
                words = [raw[a:b] for a, b in zip(w.starts[start].tolist(), w.ends[start + size + window - 2].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        as_long(anchor),
                        batch.column(0).take(pa.array(doc)),
                        pa.array((start - w.first[doc]).astype(np.int32)),
                        pa.array(size.astype(np.int32)),
                        pa.array(words, pa.binary()),
                    ],
                    ["anchor", "rid", "at", "n", "words"],
                )

    return docs.mapInArrow(found, "anchor long, rid long, at int, n int, words binary")


class SuffixTree:
    """The suffixes of some word sequences as a sorted array with common lengths, that is, a suffix tree's leaves and inner depths.

    ids: words as whole numbers, equal for equal words only; stop: for each place, the end of its sequence; places: where suffixes begin.
    """

    def __init__(self, ids: np.ndarray, stop: np.ndarray, places: np.ndarray):
        n = len(ids)
        left = stop - np.arange(n)
        self.ranks = [ids.astype(np.int64) + 1]  # of 1, 2, 4 .. words; a sequence's end is less than any word
        most = int(left.max()) if n else 0
        width = 1
        while width < most:
            rank = self.ranks[-1]
            then = np.zeros(n, np.int64)
            then[:-width] = np.where(left[:-width] > width, rank[width:], 0)
            _, name = np.unique(rank.astype(np.uint64) << np.uint64(32) | then.astype(np.uint64), return_inverse=True)
            self.ranks.append(name.astype(np.int64) + 1)
            width *= 2
        self.leaves = places[np.argsort(self.ranks[-1][places], kind="stable")]
        self.common = self._common(self.leaves[:-1], self.leaves[1:], left)  # of each leaf and the next

    def _common(self, a: np.ndarray, b: np.ndarray, left: np.ndarray) -> np.ndarray:
        out = np.zeros(len(a), np.int64)
        room = np.minimum(left[a], left[b])
        for k in range(len(self.ranks) - 1, -1, -1):
            width, rank = 1 << k, self.ranks[k]
            for _ in range(2 if k == len(self.ranks) - 1 else 1):
                fits = np.flatnonzero(out + width <= room)
                fits = fits[rank[a[fits] + out[fits]] == rank[b[fits] + out[fits]]]
                out[fits] += width
        return out

    def deepest(self) -> tuple[np.ndarray, np.ndarray]:
        """(place, depth of the deepest internal node above it) of all leaves."""
        edge = np.zeros(1, np.int64)
        return self.leaves, np.maximum(np.concatenate([edge, self.common]), np.concatenate([self.common, edge]))[: len(self.leaves)]


def word_ids(w: Words) -> np.ndarray:
    """A number for each word, the same for the same bytes only."""
    inside = np.ones(len(w.data), bool)
    size = w.ends - w.starts
    bounds = np.zeros(len(w.data) + 1, np.int8)
    bounds[w.starts] += 1
    np.subtract.at(bounds, w.ends, 1)
    inside = np.cumsum(bounds[:-1], dtype=np.int8).astype(bool)
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    column = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(w.data[inside])])
    return np.asarray(column.dictionary_encode().indices)


def _subtrees(rows: DataFrame, window: int) -> DataFrame:
    """(rid, lo, hi): words on the paths of nodes of depth `window` or more; rows: sorted by anchor, each anchor in one partition."""

    def nodes(batch: pa.RecordBatch) -> pa.RecordBatch:
        w = Words(batch.column(4))
        size = np.asarray(batch.column(3)).astype(np.int64)
        row = np.repeat(np.arange(batch.num_rows), size)
        inside = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
        place, depth = SuffixTree(word_ids(w), w.first[1:].repeat(w.counts), w.first[row] + inside).deepest()
        deep = np.zeros(len(w.hashes), np.int64)
        deep[place] = depth
        depth = deep[w.first[row] + inside]
        word = np.asarray(batch.column(2)).astype(np.int64)[row] + inside
        again = depth >= window
        row, word, depth = row[again], word[again], depth[again]
        opens = np.ones(len(row), bool)
        opens[1:] = (row[1:] != row[:-1]) | (word[1:] != word[:-1] + 1)
        head = np.flatnonzero(opens)
        last = np.append(head[1:], len(row)) - 1 if len(head) else head
        return pa.RecordBatch.from_arrays(
            [
                batch.column(1).take(pa.array(row[head])),
                pa.array(word[head].astype(np.int32)),
                pa.array((word[last] + depth[last]).astype(np.int32)),
            ],
            ["rid", "lo", "hi"],
        )

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # rows of the last anchor so far, `group` at most
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.asarray(batch.column(0))
            if held and held[-1].column(0)[-1].as_py() == keys[-1] and keys[0] == keys[-1]:
                held.append(batch)
                continue
            stop = int(np.flatnonzero(keys != keys[-1])[-1]) + 1 if keys[0] != keys[-1] else 0
            ready = [*held, batch.slice(0, stop)]
            table = pa.Table.from_batches(ready).combine_chunks()
            for piece in table.to_batches():
                yield nodes(piece)
            held = [batch.slice(stop)]
        if held:
            for piece in pa.Table.from_batches(held).combine_chunks().to_batches():
                yield nodes(piece)

    return rows.mapInArrow(found, "rid long, lo int, hi int")


def _digests(batch: pa.RecordBatch, window: int) -> Iterator[tuple[int, int, list[bytes]]]:
    """(rid, first word, each suffix' first `window` words as 128 bits) of each row."""
    for rid, at, n, text in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3, 4))):
        words = text.split()
        yield rid, at, [xxhash.xxh3_128_digest(b" ".join(words[i : i + window])) for i in range(n)]


def _window_counts(rows: DataFrame, window: int, held: int = 200_000) -> DataFrame:
    """(path, n): how often a window begins a suffix of rows, summed in the task first, `held` of them at a time."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["path", "n"])

        for batch in batches:
            for _, _, digests in _digests(batch, window):
                counts.update(digests)
                if len(counts) > held:
                    yield out()
                    counts.clear()
        yield out()

    return rows.mapInArrow(found, "path binary, n long")


def _met_windows(rows: DataFrame, window: int, known: Broadcast) -> DataFrame:
    """(rid, lo, hi): runs of neighbouring suffixes of rows whose windows are known."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[int, int, int]] = []
            for rid, at, digests in _digests(batch, window):
                here = np.flatnonzero([d in known.value for d in digests])
                if len(here):
                    cut_ = np.flatnonzero(np.diff(here) > 1)
                    out += [(rid, at + a, at + b + window) for a, b in zip(here[np.append(0, cut_ + 1)].tolist(), here[np.append(cut_, len(here) - 1)].tolist())]
            columns = list(zip(*out)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int32()))], ["rid", "lo", "hi"])

    return rows.mapInArrow(found, "rid long, lo int, hi int")


def _windows(rows: DataFrame, window: int, known: Broadcast | None) -> DataFrame:
    """(path, rid, lo): the suffixes of rows whose windows aren't known."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = known.value if known else frozenset()
        for batch in batches:
            path, rid, lo = [], [], []
            for r, at, digests in _digests(batch, window):
                here = [i for i, d in enumerate(digests) if d not in of]
                path += [digests[i] for i in here]
                rid += [r] * len(here)
                lo += [at + i for i in here]
            yield pa.RecordBatch.from_arrays([pa.array(path, pa.binary()), pa.array(rid, pa.int64()), pa.array(lo, pa.int32())], ["path", "rid", "lo"])

    return rows.mapInArrow(found, "path binary, rid long, lo int")


def _counted_windows(rows: DataFrame, window: int, most: int) -> DataFrame:
    """(rid, lo, hi): the suffixes of rows whose first `window` words begin another suffix of rows, too.

    Windows met more than `most` times are few; if they are counted to be few enough for a broadcast, tasks know them and join only the others.
    """
    again = cut(_window_counts(rows, window).groupBy("path").agg(F.sum("n").alias("_n")).where("_n > 1"))
    hot = again.where(F.col("_n") > most).select("path")
    n, known = hot.count(), None
    if 0 < n <= BROADCAST_ROWS:
        known = rows.sparkSession.sparkContext.broadcast(frozenset(bytes(r.path) for r in hot.collect()))  # 16 bytes each
        again = again.where(F.col("_n") <= most)
    rest = _windows(rows, window, known).join(again.select("path"), "path", "left_semi")
    rest = rest.select("rid", "lo", (F.col("lo") + window).alias("hi"))
    return rest.union(_met_windows(rows, window, known)) if known else rest


def _left(docs: DataFrame) -> DataFrame:
    """docs: (rid, doc_id, text, spans) -> doc_id and RESULT."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[int, int, str]] = []
            for text, spans in zip(batch.column(2).cast(pa.binary()).to_pylist(), batch.column(3).to_pylist()):
                words = (text or b"").split()
                stay = np.ones(len(words), bool)
                for s in spans or ():
                    stay[s["lo"] : s["hi"]] = False
                kept = words if stay.all() else [words[i] for i in np.flatnonzero(stay)]
                out.append((len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
            n, gone, sha = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha, pa.string())],
                ["doc_id", *RESULT],
            )

    return docs.mapInArrow(found, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def _met(rows: DataFrame, key: str, most: int) -> tuple[DataFrame, DataFrame | None]:
    """rows whose key others have too: those of keys met up to `most` times, and those of frequent ones (None without any), which no join gathers."""
    again = cut(rows.groupBy(key).agg(F.count("*").alias("_n")).where("_n > 1"))
    hot = again.where(F.col("_n") > most).select(key)
    if not (n := hot.count()):
        return rows.join(again.select(key), key, "left_semi"), None
    hot = F.broadcast(hot) if n <= BROADCAST_ROWS else hot
    few = again.where(F.col("_n") <= most).select(key)
    return rows.join(hot, key, "left_anti").join(few, key, "left_semi"), rows.join(hot, key, "left_semi")


def spans(own: DataFrame, window: int = WINDOW, prefix: int = PREFIX, group: int = GROUP) -> DataFrame:
    """(rid, lo, hi): runs of repeated words of own: (rid, doc_id, text); runs may overlap."""

    def listed(runs: DataFrame, lengthened: bool = False) -> DataFrame:
        ats = runs.groupBy("rid").agg(F.collect_list("at").alias("ats"))
        return _rows(own.join(ats, "rid").select("rid", "doc_id", "text", "ats"), window, prefix, lengthened)

    def subtrees(rows: DataFrame) -> DataFrame:
        return _subtrees(rows.select("anchor", "rid", "at", "n", "words").repartition("anchor").sortWithinPartitions("anchor"), window)

    few, many = _met(_anchors(own, window, prefix), "anchor", group)
    out = subtrees(listed(few))
    if many is None:
        return out
    few, many = _met(cut(listed(many, lengthened=True)), "anchor", group)
    out = out.union(subtrees(few))
    if many is None:
        return out
    return out.union(_counted_windows(cut(many), window, group))


def dedup(docs: DataFrame, window: int = WINDOW, prefix: int = PREFIX, group: int = GROUP) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 (of the kept words, joined by a space) of each of docs."""
    own = keyed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "rid").select("rid", "doc_id", "text")
    gone = spans(own, window, prefix, group).groupBy("rid").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    return _left(own.join(gone, "rid", "left").select("rid", "doc_id", "text", "spans"))
