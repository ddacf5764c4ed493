"""Structured Streaming sources, sinks and change events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.ordering import pick_one


def kafka_options(servers: str, topic: str, start: str = "earliest", per_trigger: int | None = 50_000, fail_on_loss: bool = False) -> dict[str, str]:
    """Options of a Kafka subscription."""
    if start not in ("earliest", "latest"):
        raise ValueError("start must be earliest or latest")
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": start,
        "failOnDataLoss": str(fail_on_loss).lower(),
    }
    if per_trigger:
        options["maxOffsetsPerTrigger"] = str(per_trigger)
    return options


def kafka_source(spark: SparkSession, **options) -> DataFrame:
    """Needs the Kafka connector on the cluster; gives key, value, topic and offsets."""
    return spark.readStream.format("kafka").options(**kafka_options(**options)).load()


def file_source(spark: SparkSession, path: str, schema: T.StructType | str, kind: str = "parquet", per_trigger: int | None = None, **more) -> DataFrame:
    """New files below a path or glob as a stream; ``per_trigger`` caps files per micro-batch."""
    reader = spark.readStream.format(kind).schema(schema).options(**more)
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return reader.load(path)


def trigger_args(mode: str) -> dict:
    """``drain`` reads what is there and stops; ``micro`` runs on; else an interval such as ``1 minute``."""
    if mode == "drain":
        return {"availableNow": True}
    if mode == "micro":
        return {"processingTime": "0 seconds"}
    return {"processingTime": mode}


def envelope_schema(row: str) -> str:
    """Change-event envelope for rows of the given struct type, e.g. ``struct<id:int>``."""
    return f"struct<before:{row},after:{row},source:map<string,string>,op:string,ts_ms:bigint>"


def parse_envelope(df: DataFrame, row: str, value: str = "value", keep=()) -> DataFrame:
    """Envelope columns before, after, source, op, ts_ms; text that is no envelope is dropped."""
    parsed = df.select(*keep, F.from_json(F.col(value).cast("string"), envelope_schema(row)).alias("e"))
    return parsed.where(F.col("e.op").isNotNull()).select(*keep, "e.before", "e.after", "e.source", "e.op", "e.ts_ms")


def cdc_flatten(df: DataFrame, row: str, value: str = "value", ts: str = "ts", keep=()) -> DataFrame:
    """The ``after`` image of each change with its time and date; deletions are dropped.

    ``ts`` is the row's time in microseconds and comes out as a full-precision timestamp.
    """
    images = parse_envelope(df, row, value, keep).where(F.col("after").isNotNull())
    flat = images.select(*keep, "after.*")
    stamped = flat.withColumn(ts, F.timestamp_micros(F.col(ts)).cast("timestamp_ntz"))
    return stamped.withColumn("event_date", F.to_date(ts))


def cdc_latest(changes: DataFrame, key: str, position: str | None = None) -> DataFrame:
    """Current row per key from parsed changes; deleted keys are absent.

    Changes are ordered by ``ts_ms`` and then by ``position``, wherever they arrive.
    """
    keyed = changes.withColumn("__k", F.coalesce(F.col("after")[key], F.col("before")[key]))
    order = ["ts_ms", position] if position else ["ts_ms"]
    last = pick_one(keyed.select("__k", "after", "op", *order), ["__k"], order, last=True)
    return last.where((F.col("op") != "d") & F.col("after").isNotNull()).select("after.*")


def append_partitioned(df: DataFrame, path: str, checkpoint: str, *by: str, mode: str = "drain") -> StreamingQuery:
    """Append Parquet by partition with a checkpoint."""
    return (
        df.writeStream.format("parquet")
        .outputMode("append")
        .partitionBy(*by)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_args(mode))
        .start(path)
    )


def append_files(df: DataFrame, path: str, checkpoint: str, kind: str = "parquet", mode: str = "drain") -> StreamingQuery:
    """Append files of the given format with a checkpoint."""
    return (
        df.writeStream.format(kind)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_args(mode))
        .start(path)
    )


def flush_buffered(df: DataFrame, path: str, checkpoint: str, mode: str = "drain") -> StreamingQuery:
    """Collect small inserts and write each micro-batch as few files in its own folder.

    The batch size comes from the source's cap and the trigger. Adaptive execution joins the
    small parts up to its target size. A batch that is run again replaces its folder.
    """

    def flush(batch: DataFrame, number: int) -> None:
        batch.hint("rebalance").write.mode("overwrite").parquet(f"{path}/batch={number}")

    return df.writeStream.foreachBatch(flush).option("checkpointLocation", checkpoint).trigger(**trigger_args(mode)).start()


def read_buffered(spark: SparkSession, path: str) -> DataFrame:
    """All flushed rows with their ``batch`` number."""
    return spark.read.option("basePath", path).parquet(f"{path}/batch=*")


def json_trades(df: DataFrame, value: str = "value") -> DataFrame:
    """Typed trade events by JSON path."""

    def at(path: str, kind: str) -> Column:
        return F.get_json_object(F.col(value).cast("string"), f"$.{path}").try_cast(kind).alias(path)

    return df.select(
        at("trade_id", "bigint"),
        at("symbol", "string"),
        at("price", "double"),
        at("quantity", "double"),
        at("amount_usdt", "double"),
        at("trade_time", "bigint"),
        at("event_time", "bigint"),
        at("is_buyer_maker", "boolean"),
    )


def _readable(text: Column) -> Column:
    return F.json_object_keys(text).isNotNull()


def unreadable(df: DataFrame, value: str = "value") -> DataFrame:
    """Rows whose text is no JSON object."""
    return df.where(~_readable(F.col(value).cast("string")))


def route_images(df: DataFrame, value: str = "value") -> DataFrame:
    """Raw ``before`` and ``after`` documents of each envelope, ready to be published again.

    Text that is no JSON object is not published; ``unreadable`` gives those rows, to be counted.
    """
    text = F.col(value).cast("string")
    return df.where(_readable(text)).select(
        F.to_json(
            F.struct(
                F.get_json_object(text, "$.before").alias("before"),
                F.get_json_object(text, "$.after").alias("after"),
            )
        ).alias("value")
    )


def compact_log(log: DataFrame, path: str, key: str, position: str | None = None) -> None:
    """Write only the newest change per key; deletions are kept as such."""
    keyed = log.withColumn("__k", F.coalesce(F.col("after")[key], F.col("before")[key]))
    order = ["ts_ms", position] if position else ["ts_ms"]
    pick_one(keyed, ["__k"], order, last=True).drop("__k").write.mode("errorifexists").parquet(path)
