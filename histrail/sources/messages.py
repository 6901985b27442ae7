"""Sources: files of wire messages, tables, JDBC, channel definitions."""

from __future__ import annotations

import json
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..streaming.pipeline import MESSAGES


def message_stream(spark: SparkSession, path: str, files_per_batch: int = 16, skip_empty: bool = False) -> DataFrame:
    """A stream over a folder of message files. Only a core subscription skips messages with an empty body (``skip_empty``);
    in the history log they are drift."""
    stream = spark.readStream.schema(MESSAGES).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    return stream.filter(F.octet_length("data") > 0) if skip_empty else stream


def message_batch(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MESSAGES).parquet(path)


def jdbc_table(spark: SparkSession, url: str, table: str, *, column: str, lower: int, upper: int, partitions: int, **options: str) -> DataFrame:
    """A table read over JDBC in ranges of a numeric column, so that no single task reads it all."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, partitionColumn=column, lowerBound=str(lower), upperBound=str(upper), numPartitions=str(partitions), **options).load()


@dataclass(frozen=True)
class Channel:
    """A channel definition. ``durable`` channels have dead letters; the others deliver at most once."""

    key: str
    direction: str
    subject: str
    durable: bool = False
    queue_group: str | None = None
    max_deliveries: int = 5
    dlq_subject: str | None = None


def channel(definition: str | dict[str, Any]) -> Channel:
    """Read a JSON channel definition; an error for a missing key, subject or direction."""
    d = json.loads(definition) if isinstance(definition, str) else definition
    direction = d.get("channelType")
    if direction not in ("inbound", "outbound") or not d.get("key") or not d.get("subject"):
        raise ValueError("a channel needs a key, a subject and a type, inbound or outbound")
    return Channel(d["key"], direction, d["subject"], bool(d.get("jetstream", d.get("durable", False))), d.get("queueGroup"), int(d.get("maxDeliver", 5)), d.get("dlqSubject"))


def channel_table(spark: SparkSession, definitions: list[Channel]) -> DataFrame:
    """``subject, channel`` of the inbound channels."""
    return spark.createDataFrame([(c.subject, c.key) for c in definitions if c.direction == "inbound"], "subject string, channel string")


def correlation(messages: DataFrame, header_name: str | None = None, variable_name: str | None = None) -> DataFrame:
    """Messages as correlations: the payload as text, the subject, and the business key by the configured source."""
    from ..functions import scalar as S

    text = F.decode("data", "UTF-8")
    variables = F.from_json(text, "map<string,string>")
    return messages.filter(F.octet_length("data") > 0).select(text.alias("payload"), "subject", S.business_key(F.col("headers"), header_name, variables, variable_name).alias("business_key"), S.header(F.col("headers"), "X-Trace-Id", "Trace-Id").alias("trace_id"))
