"""Token counts: rollups by source, language and tokenizer version, maintained by signed deltas in idempotent batches.

Every change is a row of signed numbers: an insert adds a document and its tokens, a delete takes them away, a revised
count (another tokenizer, another text) is both. A batch is summed to one row per group and written to a folder of its own, `data/<random>`.
It counts from the moment when its marker stands in `commits`: a small file, named by the SHA-256 of the batch's name, that holds the name, the
folder and a digest of the sums. The marker is written aside and moved into place by a rename that fails where one stands, so that of
several writers of a batch one commits it; the others find its digest. A writer that breaks off leaves a folder that nothing tells of. So any
text but the empty one is a batch's name, and it is never part of a path.

Totals are the sum over committed batches: additive, in any order. compact() folds them into one: sums and the folded batches' names and digests are
written, then one marker in `folds`, by the same rename, makes both count, and then what was folded goes. The names of folded batches are a
table that is only ever joined, so that a batch which comes again later isn't taken again. A batch whose name was committed with
other sums is an error, not a repeat.

Defined results: null source and language are groups of their own; a null or empty text has 0 tokens but is a document;
repeated rows count each time; groups all of whose documents are gone have no row; an empty batch is committed and
changes nothing; an empty rollup has no row; very long texts are counted whole; other columns of the input are left out.
"""

from __future__ import annotations

import hashlib
import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import n_words

GROUP = ("source", "lang", "tokenizer")
NAMES = "key string, batch string, digest string, n long"
MARKER = f"{NAMES}, data string"
SCHEMA = "source string, lang string, tokenizer string, n_docs long, n_tokens long"
#: Tokenizers by version: words, and words cut into runs of letters, digits and single other characters.
PIECES = r"[A-Za-z\x{80}-\x{10FFFF}]+|[0-9]+|[^A-Za-z0-9\x09-\x0D\x20\x{80}-\x{10FFFF}]"


def count_tokens(text: Column, tokenizer: str) -> Column:
    if tokenizer == "words-v1":
        return n_words(text)
    if tokenizer == "pieces-v2":
        return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(PIECES)).cast("long")
    raise ValueError(f"unknown tokenizer {tokenizer}")


def changes(docs: DataFrame, tokenizer: str, sign: int) -> DataFrame:
    """Signed rows of documents that come (1) or go (-1)."""
    n = count_tokens(F.col("text"), tokenizer)
    return docs.select("source", "lang", F.lit(tokenizer).alias("tokenizer"), F.lit(sign).cast("long").alias("n_docs"), (n * sign).alias("n_tokens"))


def revisions(docs: DataFrame, old: str, new: str) -> DataFrame:
    """Signed rows of documents counted anew by another tokenizer."""
    return changes(docs, old, -1).union(changes(docs, new, 1))


class Rollup:
    """A rollup kept below a folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # ---- files ----------------------------------------------------------------------------------------------------

    def _at(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{path}")

    def _files(self):
        return self._at("").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _exists(self, path: str) -> bool:
        return self._files().exists(self._at(path))

    def _remove(self, path: str) -> None:
        self._files().delete(self._at(path), True)

    def _create(self, path: str, content: dict) -> bool:
        """Write a marker whole, or not at all; False if it stands already."""
        aside = self._at(f"aside/{uuid.uuid4().hex}")
        stream = self._files().create(aside, False)
        try:
            stream.write(bytearray(json.dumps(content).encode()))
        finally:
            stream.close()
        jvm = self.spark._jvm
        self._files().mkdirs(self._at(path).getParent())
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(aside.toUri(), self.spark._jsc.hadoopConfiguration())
        never = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)  # not over another
        try:
            context.rename(aside, self._at(path), never)
        except Py4JJavaError as e:
            if "FileAlreadyExistsException" not in e.java_exception.getClass().getName():
                raise
            self._files().delete(aside, False)
            return False
        return True

    def _sums(self, *folders: str) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(*[f"{self.path}/data/{f}" for f in folders])

    # ---- batches --------------------------------------------------------------------------------------------------

    @staticmethod
    def _digest(sums: DataFrame) -> tuple[str, int]:
        row = F.xxhash64(*GROUP, *[F.col(c).isNull() for c in GROUP], "n_docs", "n_tokens").cast("decimal(38,0)")
        return tuple(sums.agg(F.coalesce(F.sum(row), F.lit(0)).cast("string"), F.count("*")).head())

    def _known(self, key: str) -> tuple[str, int] | None:
        """The digest of a committed batch."""
        if self._exists(f"commits/{key}"):
            row = self.spark.read.schema(MARKER).json(f"{self.path}/commits/{key}").head()
        else:
            row = self._folded().where(F.col("key") == key).head()
        return None if row is None else (row.digest, row.n)

    def commit(self, batch: str, delta: DataFrame) -> bool:
        """Apply a batch once; False if it had been committed, ValueError if that was with other sums."""
        if not isinstance(batch, str) or not batch:
            raise ValueError("a batch needs a name")
        key = hashlib.sha256(batch.encode()).hexdigest()
        summed = delta.groupBy(*GROUP).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        known = self._known(key)
        if known is None:
            data = uuid.uuid4().hex
            summed.coalesce(1).write.parquet(f"{self.path}/data/{data}")
            own = self._digest(self._sums(data))
            if self._create(f"commits/{key}", {"key": key, "batch": batch, "digest": own[0], "n": own[1], "data": data}):
                return True
            self._remove(f"data/{data}")
            known = self._known(key)
        else:
            own = self._digest(summed)
        if own != known:
            raise ValueError(f"batch {batch} was committed with other sums")
        return False

    def _fold(self) -> tuple[int, dict | None]:
        """The newest fold's number and marker; 0 and None before any."""
        names = [s.getPath().getName() for s in self._files().listStatus(self._at("folds"))] if self._exists("folds") else []
        if not names:
            return 0, None
        last = max(names)
        return int(last), json.loads(self.spark.read.text(f"{self.path}/folds/{last}", wholetext=True).head()[0])

    def _folded(self) -> DataFrame:
        """NAMES of the batches that compact() has taken up."""
        fold = self._fold()[1]
        return self.spark.read.schema(NAMES).parquet(f"{self.path}/names/{fold['data']}") if fold else self.spark.createDataFrame([], NAMES)

    def _single(self) -> DataFrame:
        """MARKER of the committed batches that no fold has taken up (one that broke off while it cleaned up may have left markers of others)."""
        if not self._exists("commits"):
            return self.spark.createDataFrame([], MARKER)
        return self.spark.read.schema(MARKER).json(f"{self.path}/commits").join(self._folded().select("key"), "key", "left_anti")

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, n_docs, n_tokens of the groups that have documents."""
        fold = self._fold()[1]
        folders = sorted(r.data for r in self._single().select("data").collect()) + ([fold["data"]] if fold else [])
        return self._totals(folders)

    def _totals(self, folders: list[str]) -> DataFrame:
        rows = self._sums(*folders).groupBy(*GROUP).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        return rows.where("n_docs <> 0 OR n_tokens <> 0")

    def compact(self) -> bool:
        """Fold the committed batches into one; False if another fold came first, which then stands."""
        number, fold = self._fold()
        single = self._single().collect()  # a row for each batch since the last fold
        data = uuid.uuid4().hex
        fresh = self.spark.createDataFrame([(r.key, r.batch, r.digest, r.n) for r in single], NAMES)
        self._folded().unionByName(fresh).coalesce(1).write.parquet(f"{self.path}/names/{data}")
        self._totals(sorted(r.data for r in single) + ([fold["data"]] if fold else [])).coalesce(1).write.parquet(f"{self.path}/data/{data}")
        if not self._create(f"folds/{number + 1:012d}", {"data": data}):
            self._remove(f"names/{data}")
            self._remove(f"data/{data}")
            return False
        for r in single:
            self._remove(f"commits/{r.key}")
            self._remove(f"data/{r.data}")
        if fold:
            for gone in (f"folds/{number:012d}", f"names/{fold['data']}", f"data/{fold['data']}"):
                self._remove(gone)
        return True
