"""What running queries report, as rows of a table: progress, lag and counters."""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from millrace.operators.lag import progress_lag

REPORT = (
    "query string, run_id string, batch_id long, input_rows long, "
    "counters map<string, map<string, long>>, lag map<string, long>"
)


class ProgressTable(StreamingQueryListener):
    """Writes a row per finished micro-batch of the queries named, or of all, to a table.

    Holds what came from ``observe_counts``, by its name, and how far the query is behind in each
    topic partition. A batch that is repeated after a failure reports again: ``read_progress`` keeps
    the last report of each.
    """

    def __init__(self, spark: SparkSession, path: str, names=None):
        self.spark, self.path, self.names = spark, path, names
        self.ended, self.runs = threading.Condition(), {}

    def onQueryStarted(self, event):
        if self.names is None or event.name in self.names:
            with self.ended:
                self.runs[str(event.runId)] = False

    def onQueryProgress(self, event):
        progress = json.loads(event.progress.json)
        if progress["runId"] not in self.runs:
            return
        counters = {
            name: {label: int(value) for label, value in row.items()}
            for name, row in (progress.get("observedMetrics") or {}).items()
        }
        lag = {f"{topic}-{partition}": n for (topic, partition), n in progress_lag(progress).items()}
        row = (
            progress.get("name"), progress["runId"], progress["batchId"], progress["numInputRows"],
            counters, lag,
        )
        self.spark.createDataFrame([row], REPORT).coalesce(1).write.mode("append").parquet(self.path)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        with self.ended:
            if str(event.runId) in self.runs:
                self.runs[str(event.runId)] = True
                self.ended.notify_all()

    def wait(self, run_id, seconds=60):
        """Wait until all that a query had to report is written: reports come after the batch has ended."""
        with self.ended:
            return self.ended.wait_for(lambda: self.runs.get(str(run_id)), seconds)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """The last report of each micro-batch that had input."""
    rows = spark.read.schema(REPORT).parquet(path).where(F.col("input_rows") > 0)
    last = F.max_by(F.struct("input_rows", "counters", "lag"), "run_id")
    return rows.groupBy("query", "batch_id").agg(last.alias("_last")).select("query", "batch_id", "_last.*")


def counter_totals(progress: DataFrame) -> DataFrame:
    """Totals of every counter over all micro-batches: ``query, name, label, n``."""
    named = progress.select("query", F.explode("counters").alias("name", "counts"))
    each = named.select("query", "name", F.explode("counts").alias("label", "n"))
    return each.groupBy("query", "name", "label").agg(F.sum("n").alias("n"))
