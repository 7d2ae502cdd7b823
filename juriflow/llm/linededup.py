"""Line dedup: content-defined chunks of lines; repeated chunks of several lines go, but for their first occurrence.

A document's lines (split at \\n) are hashed, and a rolling hash over `window` neighbouring line hashes ends a chunk
after a line where it is 0 modulo `divisor`, unless the chunk then has less than `min_lines` lines. So none is shorter but
a document's last, which is told by the chunk before it and itself. Where boundaries may be depends on the lines around
them alone; behind the first gap between them a passage gives the same chunks in whatever document it stands.

Chunks of at least `min_lines` lines are counted by hash and length (partial sums). Of those met again, the text is
gathered by hash and grouped by hash and by the bytes themselves: a hash that two texts share removes nothing. The
first occurrence, by doc_id (null last), then the row's place, then the place in the document, stays.

What is shuffled: hashes of all chunks (a plain join, so a hash in a third of all rows is split), the documents to meet
their own repeated chunks and again their removed ones (the same exchange where both need the same columns), and the
text of repeated chunks. No group is gathered: the first occurrence is a minimum.

Defined results: null text has no lines and stays null; an empty text is one empty line; repeated rows are repeats of
all their chunks; texts without a multi-line chunk stay as they are; a document all of whose lines go gets an empty text
(removed_lines = n_lines); a very long text is one document with all its chunks, cut nowhere; an empty table gives an empty table; extra columns are kept, those named n_lines or
removed_lines are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _BASE, _INVERSE, _SEQ, fresh, keyed, mix, powers, slices

WINDOW = 2
DIVISOR = 3
MIN_LINES = 2
RESULT = ("n_lines", "removed_lines")


def _spaced(may: np.ndarray, doc: np.ndarray, place: np.ndarray, min_lines: int) -> np.ndarray:
    """Of the lines that may end a chunk, those that do: one that would leave the chunk less than min_lines lines is passed over."""
    at = np.flatnonzero(may)
    out, now, least = [], -1, 0
    for i, d, k in zip(at.tolist(), doc[at].tolist(), place[at].tolist()):
        if d != now:
            now, least = d, min_lines - 1
        if k >= least:
            out.append(i)
            least = k + min_lines
    ends = np.zeros(len(may), bool)
    ends[np.array(out, np.int64)] = True
    return ends


def line_chunks(batch: pa.RecordBatch, window: int, divisor: int, min_lines: int) -> dict[str, np.ndarray]:
    """All chunks of a batch: the row's index, the chunk's number, first and last+1 line, first and last+1 byte told by, hash, lines told by."""
    column = batch.column(batch.schema.get_field_index("text")).cast(pa.binary()).fill_null(b"")
    column = pa.concat_arrays([column])
    offsets = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1).astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[: offsets[-1]]
    ends = np.flatnonzero(data == 10)
    doc = np.concatenate([np.searchsorted(offsets, ends, "right") - 1, np.arange(len(column))])
    stop = np.concatenate([ends, offsets[1:]])
    order = np.lexsort((stop, doc))
    doc, stop = doc[order], stop[order]
    first = np.concatenate([[True], doc[1:] != doc[:-1]])
    start = np.where(first, offsets[doc], np.concatenate([[0], stop[:-1] + 1]))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(_BASE, len(data)), out=total[1:])
    line = mix((total[stop] - total[start]) * powers(_INVERSE, len(data) + 1)[start] + (stop - start).astype(np.uint64))
    place = np.arange(len(line)) - np.repeat(np.flatnonzero(first), np.diff(np.append(np.flatnonzero(first), len(line))))
    roll = np.zeros(len(line), np.uint64)
    for j in range(window):  # lines before the document's first count as 0
        shifted = np.zeros(len(line), np.uint64)
        shifted[j:] = line[: len(line) - j]
        shifted[place < j] = 0
        roll += shifted * np.uint64(pow(_SEQ, j, 1 << 64))
    last = np.concatenate([first[1:], [True]])
    cut = last | _spaced(mix(roll) % np.uint64(divisor) == 0, doc, place, min_lines)
    tail = np.flatnonzero(cut)
    head = np.concatenate([[0], tail[:-1] + 1])
    # a document's short last chunk is told by the one before it and itself
    short = (tail + 1 - head < min_lines) & (place[head] > 0)
    since = np.where(short, np.concatenate([[0], head[:-1]]), head)
    summed = np.zeros(len(line) + 1, np.uint64)
    np.cumsum(line * powers(_SEQ, len(line)), out=summed[1:])
    back = powers(pow(_SEQ, -1, 1 << 64), len(line) + 1)
    hashes = mix((summed[tail + 1] - summed[since]) * back[since] + (tail + 1 - since).astype(np.uint64))
    owner = doc[head]
    opens = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    number = np.arange(len(head)) - np.repeat(opens, np.diff(np.append(opens, len(head))))
    return {
        "row": owner, "k": number, "from_line": place[head], "to_line": place[tail] + 1,
        "from_byte": start[since], "to_byte": stop[tail], "hash": hashes.view(np.int64), "lines": tail + 1 - since, "data": data,
    }


def _wanted(x: dict[str, np.ndarray], ks: pa.Array) -> np.ndarray:
    """Which chunks of a batch are in their row's list of numbers."""
    row = np.repeat(np.arange(len(ks)), np.asarray(pa.compute.list_value_length(ks)))
    return np.isin(x["row"] << 32 | x["k"], row << 32 | np.asarray(ks.flatten()).astype(np.int64))


def chunks(docs: DataFrame, window: int, divisor: int, min_lines: int) -> DataFrame:
    """docs: (rid, text) -> (rid, k, n_bytes, hash) of the chunks of min_lines lines or more."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                x = line_chunks(batch, window, divisor, min_lines)
                many = x["lines"] >= min_lines
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(x["row"][many])), pa.array(x["k"][many].astype(np.int32)),
                     pa.array(x["to_byte"][many] - x["from_byte"][many]), pa.array(x["hash"][many])], ["rid", "k", "n_bytes", "hash"],
                )

    return docs.mapInArrow(found, "rid long, k int, n_bytes long, hash long")


def chunk_texts(docs: DataFrame, window: int, divisor: int, min_lines: int) -> DataFrame:
    """docs: (rid, doc_id, text, ks) -> (rid, doc_id, k, from_line, to_line, hash, chunk) of the chunks that ks numbers."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                x = line_chunks(batch, window, divisor, min_lines)
                mine = _wanted(x, batch.column(3))
                take, raw = pa.array(x["row"][mine]), x["data"].tobytes()
                bytes_ = [raw[a:b] for a, b in zip(x["from_byte"][mine], x["to_byte"][mine])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(take), batch.column(1).take(take), *(pa.array(x[c][mine].astype(np.int32)) for c in ("k", "from_line", "to_line")),
                     pa.array(x["hash"][mine]), pa.array(bytes_, pa.binary())],
                    ["rid", "doc_id", "k", "from_line", "to_line", "hash", "chunk"],
                )

    return docs.mapInArrow(found, "rid long, doc_id long, k int, from_line int, to_line int, hash long, chunk binary")


def removals(docs: DataFrame, rid: str, window: int = WINDOW, divisor: int = DIVISOR, min_lines: int = MIN_LINES) -> DataFrame:
    """(rid, spans): the line ranges of each row to remove."""
    own = docs.select(rid, "doc_id", "text")
    every = chunks(docs.select(F.col(rid).alias("rid"), "text"), window, divisor, min_lines)
    again = every.groupBy("hash", "n_bytes").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    lists = every.join(again, ["hash", "n_bytes"]).groupBy(F.col("rid").alias(rid)).agg(F.collect_list("k").alias("ks"))
    listed = own.join(lists, rid).select(F.col(rid).alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), "text", "ks")
    met = chunk_texts(listed, window, divisor, min_lines)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid", "k").alias("place")
    placed = met.select("hash", "chunk", "from_line", "to_line", order)
    firsts = placed.groupBy("hash", "chunk").agg(F.min("place").alias("first"))
    gone = placed.join(firsts, ["hash", "chunk"]).where("place > first")
    return gone.groupBy(F.col("place.rid").alias("rid")).agg(F.collect_list(F.struct("from_line", "to_line")).alias("spans"))


def dedup(docs: DataFrame, window: int = WINDOW, divisor: int = DIVISOR, min_lines: int = MIN_LINES) -> DataFrame:
    """docs with text as it is left, n_lines (before) and removed_lines."""
    base = docs.drop(*[c for c in docs.columns if c.lower() in RESULT])
    rid, spans, lines = (fresh([*base.columns, "rid"], x) for x in ("_rid", "_spans", "_lines"))
    own = keyed(base, rid)
    gone = removals(own, rid, window, divisor, min_lines).withColumnsRenamed({"rid": rid, "spans": spans})
    joined = own.join(gone, rid, "left").withColumn(lines, F.split(F.coalesce("text", F.lit("")), "\n"))
    kept = F.filter(
        F.col(lines), lambda x, i: ~F.exists(F.col(spans), lambda s: (s["from_line"] <= i) & (i < s["to_line"]))
    )
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long")
    removed = F.coalesce(F.aggregate(spans, F.lit(0), lambda a, s: a + s["to_line"] - s["from_line"]), F.lit(0)).cast("long")
    text = F.when(F.col(spans).isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    names = [text.alias("text") if c == "text" else F.col(c) for c in base.columns]
    return joined.select(*names, n_lines.alias("n_lines"), removed.alias("removed_lines"))
