"""Start and supervise the streaming queries.

A checkpoint is required: batch ids go on from it after a restart, which the newest-batch
queries and the replay of a batch rely on.
"""

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from time import monotonic

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from turnout.operators.messages import (
    bad_lines,
    clean_messages,
    flatten_detail,
    judged_lines,
    malformed_messages,
    split_messages,
)
from turnout.plans.messages import counts_of, detail_of
from turnout.streaming.sinks import Sink, fan_out, lines_sink

# Fixed value: the interval between micro-batches.
INTERVAL = "20 seconds"

# Count rows per writing task: as many as one database connection inserts well within an
# interval. For files it means some megabytes each.
ROWS_PER_TASK = 100_000

# Totals are kept for every group ever seen, so they stay on disk, not on the JVM heap.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def session_conf(spark: SparkSession, conf: Mapping[str, str]) -> Iterator[None]:
    """Set session options for the start of a query, which copies them."""
    before = {name: spark.conf.get(name, None) for name in conf}
    try:
        for name, value in conf.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def _start(
    writer: DataStreamWriter, name: str | None, checkpoint: str, interval: str | None
) -> StreamingQuery:
    """Run every ``interval``, or with None: take all there is and stop."""
    if name is not None:
        writer = writer.queryName(name)
    if interval is None:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=interval)
    return writer.option("checkpointLocation", checkpoint).start()


def _sink(sinks: Sequence[Sink]) -> Sink:
    return sinks[0] if len(sinks) == 1 else fan_out(*sinks)


def start_detail(
    raw: DataFrame,
    sinks: Sequence[Sink],
    checkpoint: str,
    *,
    interval: str | None = INTERVAL,
    name: str | None = None,
) -> StreamingQuery:
    """Detail rows of each micro-batch to the sinks."""
    writer = detail_of(raw).writeStream.outputMode("update").foreachBatch(_sink(sinks))
    return _start(writer, name, checkpoint, interval)


def start_split_detail(
    raw: DataFrame,
    sinks: Sequence[Sink],
    malformed: Sink,
    checkpoint: str,
    *,
    interval: str | None = INTERVAL,
    name: str | None = None,
) -> StreamingQuery:
    """Detail rows of clean messages to the sinks, text and time of the others to ``malformed``.

    Each message is parsed once and goes to one of the two: no message is lost.
    """
    kept = _sink(sinks)

    def clean(batch: DataFrame, batch_id: int) -> None:
        kept(flatten_detail(clean_messages(batch)), batch_id)

    def other(batch: DataFrame, batch_id: int) -> None:
        malformed(malformed_messages(batch), batch_id)

    writer = split_messages(raw).writeStream.outputMode("append")
    return _start(writer.foreachBatch(fan_out(clean, other)), name, checkpoint, interval)


def start_counts(
    raw: DataFrame,
    sinks: Sequence[Sink],
    checkpoint: str,
    *,
    interval: str | None = INTERVAL,
    name: str | None = None,
    state_partitions: int | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> StreamingQuery:
    """Changed groups of each micro-batch, with their running totals, to the sinks.

    One query keeps one copy of the state for all sinks. ``state_partitions`` is fixed by
    the first start of a checkpoint: choose it for the groups to come. The default is the
    session's number of shuffle partitions.
    """
    conf = dict(STATE_CONF)
    if state_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(state_partitions)
    sink = fan_out(*sinks, rows_per_task=rows_per_task)
    writer = counts_of(raw).writeStream.outputMode("update").foreachBatch(sink)
    with session_conf(raw.sparkSession, conf):
        return _start(writer, name, checkpoint, interval)


def start_console(
    frame: DataFrame,
    checkpoint: str,
    *,
    mode: str = "update",
    interval: str | None = INTERVAL,
    rows: int = 20,
    truncate: bool = False,
    name: str | None = None,
) -> StreamingQuery:
    """Rows of a streaming frame to the console, as a query of its own."""
    writer = frame.writeStream.outputMode(mode).format("console").option("truncate", truncate)
    writer = writer.option("numRows", rows)
    with session_conf(frame.sparkSession, STATE_CONF):
        return _start(writer, name, checkpoint, interval)


def start_publish(
    lines: DataFrame,
    servers: str,
    topic: str,
    rejected: Sink,
    checkpoint: str,
    *,
    interval: str | None = INTERVAL,
    name: str | None = None,
    connector: str = "kafka",
    **options: str,
) -> StreamingQuery:
    """Feed lines to a topic, one message per line, without a key; at least once.

    Lines that are not JSON go to the sink ``rejected``, with their text: no line is lost. Each line
    is judged once; both sinks read the flag.
    """
    published = lines_sink(servers, topic, connector, **options)

    def refused(batch: DataFrame, batch_id: int) -> None:
        rejected(bad_lines(batch), batch_id)

    writer = judged_lines(lines).writeStream.outputMode("append")
    return _start(writer.foreachBatch(fan_out(published, refused)), name, checkpoint, interval)


def await_batch(query: StreamingQuery, batch_id: int, seconds: float) -> bool:
    """Wait until micro-batch ``batch_id`` is done, by the query's progress; False if it is not done
    in time or the query has ended without it. A failure of the query is raised."""
    until = monotonic() + seconds
    while monotonic() < until:
        last = query.lastProgress
        if last is not None and last["batchId"] >= batch_id:
            return True
        if query.awaitTermination(0.1):
            last = query.lastProgress
            return last is not None and last["batchId"] >= batch_id
    return False


def await_all(queries: Sequence[StreamingQuery]) -> None:
    """Wait until all queries have ended. If one fails, stop the others and raise."""
    try:
        # Each wait ends after a second, so the failure of any query is seen by then.
        while not all([query.awaitTermination(1) for query in queries]):
            pass
    finally:
        for query in queries:
            if query.isActive:
                query.stop()
