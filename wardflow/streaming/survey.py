"""Survey files from a drop folder into the survey table, as a batch or as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..operators.joins import anti_append, anti_append_legacy
from ..session import tune, workers_import
from ..sources.files import SURVEY_COLUMNS, any_match, read_delimited, stamped, survey_schema, to_int_or_fail

KEYS = ["surveyid", "question_id"]

#: Buckets of keys in the state of the stream, fixed for the life of a checkpoint.
BUCKETS = 4096


def stage(raw: DataFrame, load_time=None) -> DataFrame:
    return stamped(to_int_or_fail(raw, "surveyid"), load_time)


def new_answers(spark: SparkSession, folder: str, target: DataFrame, file_spec: str = "*", legacy: bool = False,
                load_time=None) -> DataFrame:
    """Rows of the folder's files whose (survey, question) is not in ``target`` yet."""
    rows = stage(read_delimited(spark, folder, survey_schema(), file_spec=file_spec), load_time)
    return (anti_append_legacy if legacy else anti_append)(rows, target, KEYS)


def bucketed(rows: DataFrame) -> DataFrame:
    """Add the bucket whose state knows the row's key; rows with a NULL key, which no state holds, are spread over all."""
    null_key = F.greatest(*[F.col(k).isNull().cast("int") for k in KEYS]) == 1
    spread = F.when(null_key, F.xxhash64(*[c for c in rows.columns if c != "load_dt"])).otherwise(F.xxhash64(*KEYS))
    return rows.withColumn("_bucket", F.pmod(spread, F.lit(BUCKETS)))


class NewAnswers(StatefulProcessor):
    """Lets the rows of a key through in the first batch that has it; keys of the table are known from the start.

    One state holds the keys of a bucket, so a batch costs calls between Spark and Python by bucket, not by key.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.known = handle.getListState("known", "surveyid int, question_id string")

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.known.appendList([(int(s), q) for s, q in zip(*(initialState[k] for k in KEYS))])

    def handleInputRows(self, key, rows, timerValues):
        """All rows of a bucket in this batch come in one call, so repeats inside a load are all kept."""
        known, fresh = set(self.known.get()), set()
        for part in rows:
            keep = []
            for at in zip(*(part[k] for k in KEYS)):
                keep.append(at not in known)
                if keep[-1] and not any(k is None or k != k for k in at):  # a NULL key (NaN in a number column) equals no other
                    fresh.add((int(at[0]), at[1]))
            if any(keep):
                yield part.loc[keep]
        if fresh:
            self.known.appendList(list(fresh))


def load_stream(spark: SparkSession, folder: str, target_path: str, checkpoint: str, file_spec: str = "*") -> None:
    """Load the files not seen before and stop.

    Which (survey, question) keys are loaded is state of the stream, keyed by a hash bucket of them and seeded from the table when its checkpoint is new, so later
    batches read nothing of the table.  The state of a batch is committed with the batch, and its rows are written under its
    stream and batch number, so a batch that is run again after a failure starts from the same state and replaces what it
    wrote before; a stream with a new checkpoint never touches what an earlier one wrote.
    """
    workers_import(tune(spark))
    schema = stage(spark.createDataFrame([], survey_schema())).schema
    files = (spark.readStream.schema(survey_schema()).option("sep", "|").option("quote", '"').option("escape", '"')
             .option("header", True).option("encoding", "windows-1252").option("pathGlobFilter", file_spec).csv(folder))
    if any_match(spark, target_path, "stream=*"):
        table = spark.read.schema(StructType([*schema.fields, StructField("stream", StringType()), StructField("batch", LongType())])).parquet(target_path)
    else:
        table = spark.createDataFrame([], schema)
    loaded = table.select(*KEYS).na.drop().distinct()
    fresh = bucketed(stage(files)).groupBy("_bucket").transformWithStateInPandas(
        NewAnswers(), schema, outputMode="Append", timeMode="None", initialState=bucketed(loaded).groupBy("_bucket"))

    def append(batch: DataFrame, batch_id: int) -> None:
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        batch.write.mode("overwrite").parquet(f"{target_path}/stream={stream}/batch={batch_id}")

    provider = "spark.sql.streaming.stateStore.providerClass"  # state of this kind needs the disk-backed store
    before = spark.conf.get(provider)
    spark.conf.set(provider, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        query = (fresh.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).outputMode("append")
                 .trigger(availableNow=True).start())
    finally:
        spark.conf.set(provider, before)
    query.awaitTermination()


__all__ = ["KEYS", "SURVEY_COLUMNS", "stage", "new_answers", "load_stream"]
