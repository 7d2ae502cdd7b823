"""What the corpus operators share: row identities, checkpoints, components and byte-level word hashing.

Words are maximal runs of characters other than space and U+0009..U+000D, in every operator of this
package. Their UTF-8 bytes are never split by those separators, so words are found on bytes.
"""

from __future__ import annotations

import re
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Java and RE2 pattern of what separates words.
GAP = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text that a Python worker turns into arrays at a time (a longer text makes a slice of its own).
SLICE_BYTES = 1 << 20

_STEADY = re.compile(r"^[\s:+\-|]*(Project|Filter|Relation|LogicalRDD|LocalRelation|SubqueryAlias|Generate)\b")


def checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's shared folder of spark.checkpoint.dir; where it is unset, one of our own, but only on a single machine."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        own = spark.conf.get("spark.checkpoint.dir", "")
        if not own and not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(own or tempfile.mkdtemp(prefix="juriflow-checkpoint-"))


def cut(df: DataFrame) -> DataFrame:
    """Write df to the shared checkpoint folder and go on from the files: lineage ends there, lost executors don't matter."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def anew(df: DataFrame) -> DataFrame:
    """cut(df) without the plan's estimates and constraints, which a checkpoint keeps and which multiply from round to round of a loop."""
    jdf = cut(df)._jdf
    return DataFrame(jdf.sparkSession().internalCreateDataFrame(jdf.queryExecution().toRdd(), jdf.schema(), False), df.sparkSession)


#: Rows of at most 40 bytes that are broadcast to spare the shuffle of texts; beyond it both sides are shuffled.
BROADCAST_ROWS = 1_000_000


def counted(ids: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """ids, a small column or two, written to the checkpoint folder; marked for broadcast if they are counted to be at most `most` rows."""
    ids = cut(ids)
    return F.broadcast(ids) if ids.count() <= most else ids


def fresh(taken: list[str], name: str) -> str:
    """A column name that no input column has."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name = f"_{name}"
    return name


def _steady_plan(df: DataFrame) -> bool:
    """A scan of files or of what was checkpointed, with nothing that deals rows anew behind it."""
    plan = df._jdf.queryExecution().optimizedPlan()
    if not all(_STEADY.match(line) for line in plan.toString().splitlines() if line.strip()):
        return False
    leaves = plan.collectLeaves()
    names = [leaves.apply(i) for i in range(leaves.size())]
    return all(n.nodeName() != "LogicalRDD" or n.rdd().isCheckpointed() for n in names)


def keyed(df: DataFrame, name: str) -> DataFrame:
    """df with a long that tells its rows apart and is the same each time a task is run again.

    monotonically_increasing_id is steady over a scan, also after a task is repeated; behind a shuffle, of rows or of an RDD,
    the order of rows isn't, so such inputs are written to the checkpoint folder first.
    """
    return (df if _steady_plan(df) else cut(df)).withColumn(name, F.monotonically_increasing_id())


def words(text: Column) -> Column:
    """The words of a text; none for null, empty and blank texts. (A one-character split needs no regular expression.)"""
    text = F.coalesce(text, F.lit(""))
    for gap in "\t\n\x0b\x0c\r":
        text = F.replace(text, F.lit(gap), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")


def n_words(text: Column) -> Column:
    """size(words(text)) without the list."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


#: Links that one task holds (16 bytes each, and as much for their ends) instead of rounds of joins.
TASK_LINKS = 1_000_000


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Components of all links that a task has: ends take the least label of their neighbours, then their label's label, until nothing changes."""
    read = list(batches)
    u, v = (np.concatenate([np.asarray(b.column(k)) for b in read] or [np.zeros(0, np.int64)]) for k in (0, 1))
    names, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = ends[: len(u)], ends[len(u) :]
    root = np.arange(len(names))
    while True:
        new = root.copy()
        np.minimum.at(new, a, root[b])
        np.minimum.at(new, b, root[a])
        np.minimum.at(new, root, new.copy())
        new = new[new]
        if (new == root).all():
            break
        root = new
    yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(names[root])], ["v", "root"])


def components(edges: DataFrame, rounds: int = 60, task_links: int = TASK_LINKS) -> DataFrame:
    """(v, root): the smallest vertex of each vertex's connected component; edges: (u, v) longs.

    Links counted to be at most task_links are united in one task. More of them go in rounds: labels go to the neighbours'
    smallest and then jump to their label's label, so that long chains halve; each round is one aggregation with
    map-side minima and two joins, and ends in the checkpoint folder. Both give the same.
    """
    links = cut(edges.select("u", "v").where("u <> v"))
    if links.count() <= task_links:
        return cut(links.coalesce(1).mapInArrow(_united, "v long, root long"))
    both = cut(links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
    labels = cut(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("root")))
    for _ in range(rounds):
        near = both.join(labels, "u").groupBy("v").agg(F.min("root").alias("near")).withColumnRenamed("v", "u")
        step = labels.join(near, "u").select("u", F.least("root", "near").alias("next"), F.col("root").alias("was"))
        up = labels.select(F.col("u").alias("next"), F.col("root").alias("top"))
        new = cut(step.join(up, "next").select("u", F.least("next", "top").alias("root"), "was"))
        labels = new.select("u", "root")
        if not new.where("root <> was").limit(1).count():
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return labels.withColumnRenamed("u", "v")


# ---- words of many texts at once, on bytes -------------------------------------------------------------------

M64 = (1 << 64) - 1
_BASE, _SEQ = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 1 << 64)
_IS_GAP = np.zeros(256, bool)
_IS_GAP[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser: a bijection of 64 bits that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0..n-1 modulo 2 ** 64."""
    key = str(base)
    if key not in _powers or len(_powers[key]) < n:
        out = np.full(max(n, SLICE_BYTES + 1), base, np.uint64)
        out[0] = 1
        _powers[key] = np.multiply.accumulate(out)
    return _powers[key][:n]


def slices(batch: pa.RecordBatch, text: str = "text") -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of SLICE_BYTES of text at most."""
    column = batch.column(batch.schema.get_field_index(text))
    ends = np.cumsum(np.asarray(pa.compute.binary_length(column).fill_null(0)).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + SLICE_BYTES, "right")))
        yield batch.slice(at, to - at)
        at = to


class Words:
    """The words of a column of texts: byte starts and ends, 64-bit hashes, and where each text's words begin.

    gap: whether each of the 256 bytes separates words.
    """

    def __init__(self, column: pa.Array, lower: bool = False, gap: np.ndarray = _IS_GAP):
        column = column.cast(pa.binary()).fill_null(b"")
        if column.offset:
            column = pa.concat_arrays([column])
        offsets = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4).astype(np.int64)
        data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        self.data, self.offsets = (_LOWER[data] if lower else data), offsets
        inside = ~gap[data]
        n = len(data)
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        before = np.zeros(n, bool)
        before[1:] = inside[:-1]
        before &= ~edge[:n]
        after = np.zeros(n, bool)
        after[:-1] = inside[1:]
        after &= ~edge[1:]
        self.starts = np.flatnonzero(inside & ~before)
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.starts, offsets)  # of each text, and the number of words at last
        self.counts = np.diff(self.first)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * powers(_BASE, n), out=total[1:])
        raw = (total[self.ends] - total[self.starts]) * powers(_INVERSE, n + 1)[self.starts]
        self.hashes = mix(raw + (self.ends - self.starts).astype(np.uint64))

    def doc(self) -> np.ndarray:
        """The text's index of each word."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def runs(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the k words that begin at each word, and whether as many are left in the text."""
        n = len(self.hashes)
        out = np.zeros(n, np.uint64)
        if n >= k:
            total = np.zeros(n + 1, np.uint64)
            np.cumsum(self.hashes * powers(_SEQ, n), out=total[1:])
            inverse = powers(pow(_SEQ, -1, 1 << 64), n + 1)
            out[: n - k + 1] = mix((total[k:] - total[: n - k + 1]) * inverse[: n - k + 1] + np.uint64(k))
        left = np.repeat(self.first[1:], self.counts) - np.arange(n)
        return out, left >= k


def as_long(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64))


def lists(values: pa.Array, counts: np.ndarray) -> pa.Array:
    """values cut into lists of the given lengths."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), values)
