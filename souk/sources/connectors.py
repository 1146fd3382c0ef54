"""Own sources and sinks on Spark's Python data source interface: a stream of an in-process list, and writes in two steps."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, DataSourceWriter, InputPartition, WriterCommitMessage

from souk.sources.online import FLUSH_ROWS


@dataclass
class Span(InputPartition):
    """Rows ``start`` to ``stop`` of the list."""

    start: int
    stop: int


def list_stream(spark: SparkSession, rows: Sequence[tuple], schema: str, per_task: int = 1000) -> DataFrame:
    """A stream of a list that the program holds, read by tasks of ``per_task`` rows.

    An offset is a position in the list, so a stream that goes on from a checkpoint reads what it has not committed and
    nothing twice, whatever has been added to the end of the list since.
    """
    held, name = tuple(rows), f"souk_list_{uuid.uuid4().hex}"

    class Reader(DataSourceStreamReader):
        def initialOffset(self) -> dict:
            return {"at": 0}

        def latestOffset(self) -> dict:
            return {"at": len(held)}

        def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
            return [Span(i, min(i + per_task, end["at"])) for i in range(start["at"], end["at"], per_task)]

        def read(self, partition: InputPartition) -> Iterator[tuple]:
            return iter(held[partition.start : partition.stop])

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return schema

        def streamReader(self, schema) -> DataSourceStreamReader:
            return Reader()

    spark.dataSource.register(Source)
    return spark.readStream.format(name).load()


class StagedStore(Protocol):
    """An external keyed store that shows rows only once their stage is published. A stage is named ``<write>-<attempt>-<number>``."""

    def stage(self, stage: str, rows: list[tuple[str, Mapping[str, str]]]) -> None: ...

    def publish(self, stages: list[str]) -> None: ...

    def discard(self, start: str) -> None:
        """Drop all stages whose name starts so, those that no one reported too."""

    def close(self) -> None: ...


@dataclass
class Staged(WriterCommitMessage):
    """What a task has staged."""

    stages: list[str] = field(default_factory=list)


def write_staged(rows: DataFrame, connect: Callable[[], StagedStore], flush_rows: int = FLUSH_ROWS) -> None:
    """Push ``(key, features)`` rows to a store: all of them, or none.

    Each task stages its rows over one connection under names of its own attempt. The driver publishes the stages of the attempts
    that count once every task has ended well, and drops what other attempts have left. A write that fails drops all its stages;
    a task that is still being stopped then may leave one more, which is never shown and which ``discard`` of the write drops.
    """
    write_id = uuid.uuid4().hex
    name = f"souk_staged_{write_id}"

    class Writer(DataSourceWriter):
        def write(self, iterator: Iterator[Row]) -> WriterCommitMessage:
            store, pending, attempt, stages = connect(), [], uuid.uuid4().hex, []

            def flush() -> None:
                stages.append(f"{write_id}-{attempt}-{len(stages)}")
                store.stage(stages[-1], pending)

            try:
                for row in iterator:
                    pending.append((row["key"], row["features"]))
                    if len(pending) >= flush_rows:
                        flush()
                        pending = []
                if pending:
                    flush()
            finally:
                store.close()
            return Staged(stages)

        def commit(self, messages: list[WriterCommitMessage | None]) -> None:
            store = connect()
            try:
                store.publish([s for m in messages if m is not None for s in m.stages])
                store.discard(write_id)
            finally:
                store.close()

        def abort(self, messages: list[WriterCommitMessage | None]) -> None:
            store = connect()
            try:
                store.discard(write_id)
            finally:
                store.close()

    class Sink(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def writer(self, schema, overwrite: bool) -> DataSourceWriter:
            return Writer()

    rows.sparkSession.dataSource.register(Sink)
    rows.select("key", "features").write.format(name).mode("append").save()
