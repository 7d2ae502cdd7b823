"""Runs over decisions as they arrive: texts that an earlier micro-batch selected from are not selected from again.

What has been selected is kept by the text's hash, below out/selections. A batch reads what the batches before it wrote, and joins it.
unique_limit counts different texts of the whole stream; the other limits are a batch's own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from juriflow.plans import extract

SELECTION = (
    "decision_sha256 string, text_bits long, selected array<struct<rank:int,unit_ids:array<string>,category:string,priority:int,reason:string,text:string>>, "
    "teacher_status string, teacher_attempts int, teacher_response_mode string, error string, batch long"
)


def selections(spark: SparkSession, out: str, before: int) -> DataFrame:
    """The selections of the batches before a number."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{out}/selections")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], SELECTION).drop("batch")
    return spark.read.schema(SELECTION).parquet(f"{out}/selections").where(F.col("batch") < before).drop("batch")


def start(source: DataFrame, out: str, checkpoint: str, once: bool = True, unique_limit: int | None = None, **options) -> StreamingQuery:
    """Append candidates and documents below out for each micro-batch of source, a streaming table of decisions.

    A batch writes to its own folders, overwritten if it is repeated, so that a restart neither loses nor repeats rows.
    """

    def batch(rows: DataFrame, number: int) -> None:
        known = selections(rows.sparkSession, out, number)
        left = None if unique_limit is None else max(0, unique_limit - known.count())
        run = extract.run(rows, known=known, unique_limit=left, keep=True, **options)
        run.selections.write.mode("overwrite").parquet(f"{out}/selections/batch={number}")
        run.candidates.write.mode("overwrite").parquet(f"{out}/candidates/batch={number}")
        run.documents.write.mode("overwrite").parquet(f"{out}/documents/batch={number}")
        run.unpersist()

    writer = source.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def results(spark: SparkSession, out: str) -> tuple[DataFrame, DataFrame]:
    """(candidates, documents) of all batches."""
    return spark.read.parquet(f"{out}/candidates"), spark.read.parquet(f"{out}/documents")
