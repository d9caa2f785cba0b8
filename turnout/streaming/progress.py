"""Progress and state metrics of the streaming queries, one row per micro-batch."""

import json
from threading import Condition
from time import monotonic

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

PROGRESS_DDL = (
    "name STRING, run_id STRING, started STRING, input_rows BIGINT, input_rows_per_second DOUBLE, "
    "processed_rows_per_second DOUBLE, duration_ms BIGINT, state_rows BIGINT, "
    "state_updated_rows BIGINT, state_memory_bytes BIGINT, state_partitions BIGINT"
)


def progress_row(progress: dict) -> dict:
    """The metrics of one progress report; the state's are NULL for a query without state, and the
    sums over its operators otherwise."""
    state = progress.get("stateOperators") or []

    def total(field: str) -> int | None:
        return sum(s.get(field, 0) for s in state) if state else None

    return {
        "name": progress.get("name"),
        "run_id": progress["runId"],
        "started": progress["timestamp"],
        "input_rows": progress["numInputRows"],
        "input_rows_per_second": progress.get("inputRowsPerSecond"),
        "processed_rows_per_second": progress.get("processedRowsPerSecond"),
        "duration_ms": progress.get("batchDuration"),
        "state_rows": total("numRowsTotal"),
        "state_updated_rows": total("numRowsUpdated"),
        "state_memory_bytes": total("memoryUsedBytes"),
        "state_partitions": total("numShufflePartitions"),
    }


class ProgressLog(StreamingQueryListener):
    """Writes the progress of the session's queries to a table of JSON files.

    One folder per query and micro-batch: a batch that runs again replaces its row. Reports without
    a batch (an idle query sends them) write nothing. Rows come after the batch, from the session's
    listener thread; ``wait`` for those of a query that has ended.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        self.ended: set[str] = set()
        self.changed = Condition()

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        progress = json.loads(event.progress.json)
        if "addBatch" not in (progress.get("durationMs") or {}):
            return
        row = self.spark.createDataFrame([progress_row(progress)], PROGRESS_DDL).coalesce(1)
        row.write.mode("overwrite").json(
            f"{self.path}/query_id={progress['id']}/batch_id={progress['batchId']}"
        )

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        with self.changed:
            self.ended.add(str(event.runId))
            self.changed.notify_all()

    def wait(self, query: StreamingQuery, seconds: float = 60) -> bool:
        """Wait until all rows of a query that has ended are written."""
        until = monotonic() + seconds
        with self.changed:
            while str(query.runId) not in self.ended:
                if not self.changed.wait(max(0, until - monotonic())):
                    return False
        return True


def progress_table(spark: SparkSession, path: str) -> DataFrame:
    """The rows that a ``ProgressLog`` has written, with ``query_id`` and ``batch_id``."""
    return spark.read.schema(f"{PROGRESS_DDL}, query_id STRING, batch_id BIGINT").json(path)
