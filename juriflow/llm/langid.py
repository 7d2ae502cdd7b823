"""Language identification: multinomial naive Bayes over hashed character n-grams.

A text is lower-cased and read as letters with one boundary between, before and after their runs, whatever else stands there; its
features are all runs of 2, 3 and 4 of these characters, hashed into `buckets`. learn() counts them by language: each task adds up
dense counts of the languages that it meets and sends on what isn't zero, so that a task's rows are bounded by languages times
buckets whatever it read, and no language, however common, is one task's. A language's log probability of a bucket is that of the
multinomial smoothed by `smooth`, its prior that of its documents.

predict() broadcasts the log probabilities, as whole numbers of 2 ** -16 each, `at_once` languages at a time (at most at_once *
buckets * 4 bytes); more languages are more passes over the same rows, which carry the best so far. A task scores whole texts in
numpy: the matrix is gathered at all n-grams of a slice of texts, and summed by text. Whole numbers sum to the same in
any order, so that results don't depend on how rows are dealt. lang_pred is the language of the highest posterior, the first by code
point of equals; score is that posterior.

Defined results: a text that is null or has no letter (as str.isalpha tells) is `und` with score 0, and so is every text if nothing was learned;
texts of null language and null texts teach nothing; a document without an id counts as one whose id is the empty text
(remainder 0, so not held out); very long texts are whole; repeated rows each count and get the same; bytes that are no UTF-8 count as no letters;
an empty table gives an empty table; other columns are kept, but those with a name of the result's are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, fresh, slices

SIZES = (2, 3, 4)
BUCKETS = 1 << 15
SMOOTH = 0.5
AT_ONCE = 64
UNIT = 1 << 16
UNKNOWN = "und"
RESULT = ("held_out", "lang_pred", "score")
_NONE = -(1 << 63)
#: Languages of which a task holds counts before it sends them on (8 * BUCKETS bytes each).
HELD = 64

_letters: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    """Whether each code point is a letter."""
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


class Grams:
    """buckets: of all n-grams of a column of texts, text by text; counts: how many each text has; lettered: whether it has a letter."""

    def __init__(self, column: pa.Array, buckets: int):
        texts = ["\0" + (t or b"").decode("utf-8", "replace").lower() + "\0" for t in column.cast(pa.binary()).to_pylist()]
        points = np.frombuffer("".join(texts).encode("utf-32-le", "replace"), np.uint32)
        ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
        firsts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        letter = _is_letter()[points]
        keep = letter.copy()
        keep[1:] |= letter[:-1]  # the first of what follows a run of letters stands for all of it
        keep[firsts] = True
        read = np.where(letter, points, 0)[keep].astype(np.uint32)
        before = np.concatenate([[0], np.cumsum(keep)])
        self.lettered = np.add.reduceat(letter, firsts, dtype=np.int64) > 0 if len(texts) else np.zeros(0, bool)
        starts, left = before[firsts], before[ends]
        of = np.repeat(np.arange(len(texts)), left - starts)
        room = left[of] - np.arange(len(read))  # characters from each on to its text's end
        h, parts, whose = read * np.uint32(0x9E3779B1), [], []
        for n in range(2, max(SIZES) + 1):
            h = (h[:-1] ^ (h[:-1] >> np.uint32(15))) * np.uint32(0x85EBCA77) + read[n - 1 :] * np.uint32(0x9E3779B1)
            if n in SIZES:
                whole = np.flatnonzero(room[: len(h)] >= n)
                x = h[whole]
                x = (x ^ (x >> np.uint32(16))) * np.uint32(0xC2B2AE3D)
                parts.append(((x ^ (x >> np.uint32(13))) & np.uint32(buckets - 1)).astype(np.int32))
                whose.append(of[whole])
        self.parts, self.whose, self.n_texts = parts, whose, len(texts)

    def sums(self, values: np.ndarray) -> np.ndarray:
        """The sum of values[bucket] over each text's n-grams."""
        total = np.zeros(self.n_texts, np.int64)
        for buckets, whose in zip(self.parts, self.whose, strict=True):
            if len(buckets):
                at = np.flatnonzero(np.concatenate([[True], whose[1:] != whose[:-1]]))
                total[whose[at]] += np.add.reduceat(values[buckets], at, dtype=np.int64)
        return total


@dataclass
class Model:
    """counts: (lang, bucket, n), the documents of a language at bucket -1; langs: all languages, by code point."""

    counts: DataFrame
    langs: list[str]
    buckets: int
    smooth: float

    def matrix(self, langs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(log probabilities by language and bucket, log priors), in units of 1 / UNIT."""
        place = {x: i for i, x in enumerate(langs)}
        rows = self.counts.where(F.col("lang").isin(langs)).toArrow()
        n = np.zeros((len(langs), self.buckets + 1))
        which = np.array([place[x] for x in rows.column("lang").to_pylist()], np.int64)
        n[which, np.asarray(rows.column("bucket")) + 1] = np.asarray(rows.column("n"))
        smoothed = n[:, 1:] + self.smooth
        logs = np.log(smoothed / smoothed.sum(axis=1, keepdims=True))
        return np.rint(logs * UNIT).astype(np.int32), np.rint(np.log(n[:, 0]) * UNIT).astype(np.int64)


def learn(docs: DataFrame, buckets: int = BUCKETS, smooth: float = SMOOTH) -> Model:
    """docs: text and lang."""
    if buckets & (buckets - 1):
        raise ValueError("buckets must be a power of two")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}

        def send() -> Iterator[pa.RecordBatch]:
            for lang, n in held.items():
                at = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at - 1), pa.array(n[at])], ["lang", "bucket", "n"])
            held.clear()

        for batch in batches:
            for part in slices(batch):
                grams, langs = Grams(part.column(0), buckets), part.column(1).to_pylist()
                here = sorted(set(langs))
                place = {x: i for i, x in enumerate(here)}
                which = np.array([place[x] for x in langs], np.int64)
                n = np.zeros((len(here), buckets + 1), np.int64)
                n[:, 0] = np.bincount(which, minlength=len(here))
                for found, whose in zip(grams.parts, grams.whose, strict=True):
                    n[:, 1:] += np.bincount(which[whose] * buckets + found, minlength=len(here) * buckets).reshape(len(here), buckets)
                if held and len(held.keys() | here) > HELD:
                    yield from send()
                for lang, own in zip(here, n, strict=True):
                    held[lang] = held[lang] + own if lang in held else own
        yield from send()

    rows = docs.where("text IS NOT NULL AND lang IS NOT NULL").select(F.col("text").cast("binary").alias("text"), "lang")
    counts = cut(rows.mapInArrow(counted, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")))
    return Model(counts, sorted(r.lang for r in counts.where("bucket = -1").select("lang").collect()), buckets, smooth)


def predict(docs: DataFrame, model: Model, at_once: int = AT_ONCE, keep_text: bool = True) -> DataFrame:
    """docs (text as the workers give it back, or without it) with lang_pred and score."""
    base = docs.drop(*[c for c in docs.columns if c.lower() in RESULT[1:]])
    best, total, name = (fresh(base.columns, x) for x in ("_best", "_total", "_name"))
    rows = base.withColumn("text", F.col("text").cast("binary"))
    rows = rows.withColumns({best: F.lit(_NONE), total: F.lit(0.0), name: F.lit(None).cast("string")})
    buckets, blocks = model.buckets, [model.langs[k : k + at_once] for k in range(0, len(model.langs), at_once)]
    for langs in blocks:
        sent = docs.sparkSession.sparkContext.broadcast(model.matrix(langs))
        shape = rows.schema if keep_text or langs is not blocks[-1] else rows.drop("text").schema

        def scored(batches: Iterator[pa.RecordBatch], langs=langs, sent=sent, shape=shape) -> Iterator[pa.RecordBatch]:
            logs, priors = sent.value
            for batch in batches:
                for part in slices(batch):
                    values = dict(zip(part.schema.names, part.columns, strict=True))
                    grams = Grams(values["text"], buckets)
                    sums = np.stack([grams.sums(x) + prior for x, prior in zip(logs, priors, strict=True)])
                    top = sums.argmax(axis=0)  # the first of equals
                    highest, was = sums[top, np.arange(len(top))], np.asarray(values[best])
                    first = was == _NONE
                    new = np.maximum(was, highest)
                    carried = np.asarray(values[total]) * np.exp(np.where(first, 0, was - new) / UNIT)
                    named = np.where(highest > was, np.array(langs, object)[top], np.array(values[name].to_pylist(), object))
                    values[best], values[total] = pa.array(new), pa.array(carried + np.exp((sums - new) / UNIT).sum(axis=0))
                    values[name] = pa.array(np.where(grams.lettered, named, None).tolist(), pa.string())
                    yield pa.RecordBatch.from_arrays([values[c] for c in shape.names], shape.names)

        rows = rows.mapInArrow(scored, shape)
    known = F.col(name).isNotNull()
    kept = [F.col(c).cast("string").alias(c) if c == "text" else F.col(c) for c in base.columns if c in rows.columns]
    return rows.select(*kept, F.coalesce(name, F.lit(UNKNOWN)).alias("lang_pred"), F.when(known, F.round(1 / F.col(total), 9)).otherwise(0.0).alias("score"))


def held_out() -> Column:
    """Documents whose crc32(doc_id as text) modulo 3 is 1: the model doesn't learn from them."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 1


def label(docs: DataFrame, buckets: int = BUCKETS, smooth: float = SMOOTH, at_once: int = AT_ONCE, keep_text: bool = True) -> DataFrame:
    """docs with held_out, lang_pred and score, by a model of those that aren't held out."""
    model = learn(docs.where(~held_out()), buckets, smooth)
    base = docs.drop(*[c for c in docs.columns if c.lower() in RESULT])
    return predict(base, model, at_once, keep_text).withColumn("held_out", held_out())
