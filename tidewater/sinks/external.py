"""Sinks to other systems: database tables, topics, and row writers with set-up and tear-down."""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, Row
from pyspark.sql.streaming import StreamingQuery

from tidewater.sinks.encode import to_messages


def jdbc_batch(url: str, table: str, properties: Mapping[str, str] | None = None) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that appends to a database table, 2000 rows per round trip."""
    settings = {"batchsize": "2000", **(properties or {})}

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.jdbc(url, table, mode="append", properties=settings)

    return write


def stream_to_topic(df: DataFrame, servers: str, topic: str, checkpoint: str, key: str | None = None) -> StreamingQuery:
    writer = to_messages(df, key).writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
    return writer.option("topic", topic).option("checkpointLocation", checkpoint).start()


def stream_to_console(df: DataFrame, mode: str = "append", rows: int = 20) -> StreamingQuery:
    return df.writeStream.format("console").option("numRows", rows).outputMode(mode).start()


class RowWriter(ABC):
    """A sink for ``writeStream.foreach``: opened once per partition and epoch, then called row by row."""

    def open(self, partition_id: int, epoch_id: int) -> bool:
        return True

    @abstractmethod
    def process(self, row: Row) -> None: ...

    def close(self, error: Exception | None) -> None:
        return None
