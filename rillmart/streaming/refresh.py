"""Streams that look at tables which change while they run.

A static table joined to a stream is planned once.  Here each micro-batch loads
the tables anew, so a config row or dimension row written a moment ago counts
from the next batch on and no cache has to be cleared.

Each batch writes a folder under its own number and replaces it when it is run
again, so a table read of the output has every batch exactly once.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.query import StreamingQueryException

from ..operators.routing import dim_changes, fact_changes, route_as_of, route_changes
from ..sinks.dims import COMPACT_AFTER, config_tables, create_dim, dim_schema, write_batch
from ..sinks.topics import start


def enrich(stream: DataFrame, load: Callable[[], object], join: Callable[[DataFrame, object], DataFrame], path: str,
           checkpoint: str, **run) -> StreamingQuery:
    """Join each batch with freshly loaded tables and write it to ``<path>/batch=<n>``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        join(batch, load()).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return start(stream.writeStream.foreachBatch(write), checkpoint, **run)


def db_split(changes: DataFrame, load_config: Callable[[], DataFrame], facts_path: str, dims_root: str,
             checkpoint: str, order_by: str, compact_after: int = COMPACT_AFTER, as_of: str | None = None, **run) -> StreamingQuery:
    """Route change envelopes by the present config: facts to text topics, dimension rows to their tables.

    With ``as_of``, the name of the changes' time, the config is its versions
    (``routing.route_as_of``) and each change goes by the one of its time.

    Facts go to ``<facts_path>/batch=<n>/sink_table=<topic>`` as JSON lines.
    Dimension tables are created when the config first names them.  The config is
    a short table, a row per source table and operation.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        config = load_config()
        routed = route_as_of(batch, config, as_of) if as_of else route_changes(batch, config)
        # Facts, the bulk, pass once and are not kept; of the rest only what the dimension tables take.
        fact_changes(routed).select(F.col("sinkTable").alias("sink_table"), F.to_json("after").alias("value")
                                    ).write.mode("overwrite").partitionBy("sink_table").text(
            f"{facts_path}/batch={batch_id}")
        tables = {}
        for table, (columns, pk) in config_tables(config).items():
            schema = dim_schema(columns, pk)
            create_dim(batch.sparkSession, f"{dims_root}/{table}", columns, pk)
            tables[table] = (schema.names, next(f.name for f in schema.fields if not f.nullable))
        rows = dim_changes(routed).select("sinkType", "sinkTable", "after", order_by).persist()
        try:
            write_batch(rows, dims_root, tables, batch_id, order_by, compact_after)
        finally:
            rows.unpersist()

    return start(changes.writeStream.foreachBatch(write), checkpoint, **run)


def keep_running(begin: Callable[[], StreamingQuery], attempts: int = 3, pause_seconds: float = 2.0) -> None:
    """Run a query to its end, starting it again from its checkpoint after a failure, at most ``attempts`` times."""
    for left in range(attempts, -1, -1):
        try:
            begin().awaitTermination()
            return
        except StreamingQueryException:
            if left == 0:
                raise
            time.sleep(pause_seconds)
