"""Transaction messages: streams, dead letters and their JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnflow.schemas import TEXT_TXN

RAW_TOPIC, ALERT_TOPIC, DEAD_TOPIC = "txn.raw", "txn.alert", "txn.dead-letter"

_CORRUPT = "_corrupt_record"
_MESSAGE = T.StructType([*TEXT_TXN.fields, T.StructField(_CORRUPT, T.StringType(), True)])


def kafka_options(servers: str, topic: str, starting: str = "latest", per_trigger: int | None = None) -> dict:
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting}
    if per_trigger:
        options["maxOffsetsPerTrigger"] = str(per_trigger)
    return options


def _key_value(df: DataFrame) -> DataFrame:
    return df.select(F.col("key").cast("string"), F.col("value").cast("string"))


def kafka_stream(spark: SparkSession, servers: str, topic: str = RAW_TOPIC, per_trigger: int | None = None):
    """All that has arrived per trigger, unless ``per_trigger`` sets a number of messages."""
    options = kafka_options(servers, topic, per_trigger=per_trigger)
    return _key_value(spark.readStream.format("kafka").options(**options).load())


def kafka_batch(spark: SparkSession, servers: str, topic: str = DEAD_TOPIC) -> DataFrame:
    """Everything in a topic now, oldest to newest."""
    options = kafka_options(servers, topic, starting="earliest") | {"endingOffsets": "latest"}
    return _key_value(spark.read.format("kafka").options(**options).load())


def kafka_publish(df: DataFrame, servers: str, topic: str) -> None:
    """Write key/value rows; acknowledged by all replicas."""
    df.write.format("kafka").options(
        **{"kafka.bootstrap.servers": servers, "kafka.acks": "all", "topic": topic}
    ).save()


def file_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """One JSON message per line, in files that arrive in ``path``."""
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path).select(F.lit(None).cast("string").alias("key"), "value")


def file_messages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.lit(None).cast("string").alias("key"), "value")


#: Messages kept as rows, as replayed letters are: a text may hold line ends, and has its key.
KEPT = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.StringType())])


def letter_messages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(KEPT).parquet(path)


def letter_stream(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(KEPT).parquet(path)


def parse(messages: DataFrame, *carry: str) -> DataFrame:
    """Message text to one text column per field; keeps ``value``.

    An array message gives a row per element, an empty one a row of nulls.
    Unparsable text leaves all fields null and ``_corrupt_record`` set.
    """
    text = F.col("value")
    options = {"columnNameOfCorruptRecord": _CORRUPT}
    single = F.from_json(text, _MESSAGE, options)
    listed = F.from_json(text, T.ArrayType(_MESSAGE), options)
    is_array = F.startswith(F.ltrim(text), F.lit("["))
    found = F.when(is_array & (F.size(listed) > 0), listed).when(is_array, F.array(F.get(listed, F.lit(0)))).otherwise(F.array(single))
    carried = [c for c in ("value", *carry) if c in messages.columns]
    # As a generator, the JSON is parsed once per message and not once per field.
    return messages.select(*carried, F.inline(found))


def to_messages(df: DataFrame, *fields: str) -> DataFrame:
    """Rows to key/value JSON, keyed by nothing, as producers send them."""
    columns = fields or tuple(df.columns)
    return df.select(
        F.lit(None).cast("string").alias("key"), F.to_json(F.struct(*columns)).alias("value")
    )
