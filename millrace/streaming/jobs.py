"""Running streams into tables."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession

from millrace.functions.scalar import GRACE, WINDOW_SIZE
from millrace.operators.payments import charge
from millrace.session import ROCKSDB
from millrace.sinks.tables import exactly_once_writer
from millrace.streaming.fraud import stream_high_value, stream_velocity

AVAILABLE_NOW = {"availableNow": True}


def start(stream: DataFrame, writer, checkpoint: str, *, mode="append", trigger=None, name=None):
    """Start a query that hands each micro-batch to ``writer``."""
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    query = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(writer)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or AVAILABLE_NOW))
    )
    return (query.queryName(name) if name else query).start()


def supervise(begin, restarts=3):
    """Run a query to its end, beginning it again after a failure, ``restarts`` times at most.

    ``begin`` starts the query. It goes on from its checkpoint: the batch that failed is repeated.
    Returns how often it was begun.
    """
    for attempt in range(1, restarts + 2):
        try:
            begin().awaitTermination()
            return attempt
        except StreamingQueryException:
            if attempt > restarts:
                raise


def start_to_table(stream: DataFrame, folder: str, *, mode="append", transform=None,
                   after_write=None, trigger=None, name=None):
    """Start a query that writes exactly once into ``folder/table``; it runs as ``trigger`` says.

    Without a trigger it processes what is there now and ends. Started again on the same folder it
    goes on where it stopped.
    """
    writer = exactly_once_writer(f"{folder}/table", transform, after_write)
    return start(stream, writer, f"{folder}/checkpoint", mode=mode, trigger=trigger, name=name)


def run_to_table(stream: DataFrame, folder: str, *, restarts=0, **options) -> str:
    """``start_to_table``, and wait for the end; returns the table's path."""
    supervise(lambda: start_to_table(stream, folder, **options), restarts)
    return f"{folder}/table"


def run_members(streams: dict, folder: str, *, restarts=0, transform=None, after_write=None) -> str:
    """Members of one consumer group side by side: ``run_to_table`` for each stream, with progress of its own.

    Their batches lie under ``member=`` in one table, whose path is returned. A cap on micro-batches holds for
    each member. Returns when all have ended, also where one fails.
    """

    def run(member):
        writer = exactly_once_writer(f"{folder}/table/member={member}", transform, after_write)
        checkpoint = f"{folder}/checkpoint/member={member}"
        supervise(lambda: start(streams[member], writer, checkpoint), restarts)

    with ThreadPoolExecutor(len(streams)) as pool:
        list(pool.map(run, streams))
    return f"{folder}/table"


def stream_payments(orders: DataFrame, folder: str, after_write=None, **options) -> str:
    """Charge a stream of orders, one payment per order, into ``folder``."""
    return run_to_table(orders, folder, transform=charge, after_write=after_write, **options)


def stream_fraud(orders: DataFrame, folder: str, size=WINDOW_SIZE, grace=GRACE, trigger=None) -> dict:
    """Both kinds of alert from a stream of orders, each by its own query, side by side.

    Returns the paths of the two tables. A window that grows over several micro-batches has
    an alert in each of them, told apart by ``n``. With a ``trigger`` that never ends they run on.
    """
    fast = stream_velocity(orders, size, grace)
    running = [
        start_to_table(stream_high_value(orders), f"{folder}/high-value", trigger=trigger),
        start_to_table(fast, f"{folder}/velocity", mode="update", trigger=trigger),
    ]
    if trigger is None or "availableNow" in trigger:
        for query in running:
            query.awaitTermination()
    return {"HIGH_VALUE": f"{folder}/high-value/table", "VELOCITY": f"{folder}/velocity/table"}


def read_state(spark: SparkSession, checkpoint: str, variable=None, operator=0) -> DataFrame:
    """The keyed state of a query, from its checkpoint."""
    reader = spark.read.format("statestore").option("operatorId", operator)
    if variable:
        reader = reader.option("stateVarName", variable)
    return reader.load(checkpoint)
