"""Transactions scored as they arrive, and alerts from the scored stream."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ledgerlight.operators.alerts import fraud_alerts
from ledgerlight.operators.scoring import bare_features, verdict
from ledgerlight.session import scratch_root

#: A file delivered again within this time of its first arrival raises no second alert in the stream.
REPEATS = "24 hours"


def incoming(
    spark: SparkSession, folder: str, schema: StructType | str, fmt: str = "parquet", pattern: str | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Files that arrive in a folder, as a stream."""
    reader = spark.readStream.format(fmt).schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


def scored(stream: DataFrame, scorer: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Neutral features, score and verdict; row-wise, so no state is kept."""
    return verdict(scorer(bare_features(stream)))


def alert_stream(
    scored_rows: DataFrame, key: str, user: str, at: str, payload: Sequence[str], score: str = "fraud_proba"
) -> DataFrame:
    """One alert per transaction, also when a source file is delivered twice.

    The state is bounded by the time of arrival, not by the time of the transaction, so no fraud is
    too late to be reported.  Deliveries further apart than ``REPEATS`` are folded by ``folded``.
    """
    alerts = fraud_alerts(scored_rows, key, user, at, payload, score)
    arrived = alerts.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", REPEATS)
    return arrived.dropDuplicatesWithinWatermark(["alert_id"]).drop("_arrived")


def folded(alerts: DataFrame) -> DataFrame:
    """One row per alert of what the stream has written; deliveries of one alert are equal."""
    return alerts.dropDuplicates(["alert_id"])


def write_stream(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Exactly-once file sink that processes what is there and stops."""
    return (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def drain(df: DataFrame) -> DataFrame:
    """Run a stream over all that is available and read its output back."""
    spark = df.sparkSession
    base = f"{scratch_root(spark)}/stream-{uuid.uuid4().hex}"
    write_stream(df, f"{base}/rows", f"{base}/progress").awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{base}/rows")


def score_with_champion(
    stream: DataFrame, champion: Callable[[], int], scorer_of: Callable[[int], Callable[[DataFrame], DataFrame]],
    path: str, checkpoint: str,
) -> StreamingQuery:
    """Score what is there with the model that is champion when a micro-batch starts, and stamp its version.

    ``champion`` reads the registry, ``scorer_of`` loads a version; both run once per micro-batch, the second only when
    the version has changed.  A batch is one folder and replaces it when it runs again, so rows of a batch have one
    version and none is written twice.
    """
    loaded: dict[int, Callable[[DataFrame], DataFrame]] = {}

    def one_batch(rows: DataFrame, batch: int) -> None:
        version = champion()
        if version not in loaded:
            loaded.clear()
            loaded[version] = scorer_of(version)
        out = scored(rows, loaded[version]).withColumn("model_version", F.lit(version))
        out.write.mode("overwrite").parquet(f"{path}/lot={batch}")

    return stream.writeStream.foreachBatch(one_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
