"""Continuous ingest: a stream of document batches into a collection's write log.

Each micro-batch becomes one write of the log.  Its write number is recorded before the write, so a
replayed batch replaces its own partition.  Arrival order decides between rows of the same id,
within a batch by input position and between batches by write number.  Index search sees the
rows after ``refresh``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from trawl.functions.embed import embed
from trawl.operators import mutate
from trawl.operators.mutate import last_per_id
from trawl.sources.collection import Collection


def ingest(stream: DataFrame, collection: Collection, checkpoint: str, *,
           refresh_every: int | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Start writing ``stream`` (``[id,] content, metadata[, embedding]``) into a collection.

    ``refresh_every`` publishes after that many micro-batches; ``None`` leaves it to the caller.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, collection, collection.stream_seq(checkpoint, batch_id))
        if refresh_every and (batch_id + 1) % refresh_every == 0:
            collection.refresh()

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def write_batch(batch: DataFrame, collection: Collection, seq: int) -> None:
    """Write one micro-batch as log partition ``seq``, replacing an earlier attempt."""
    batch = mutate.number_rows(batch)
    if "embedding" not in batch.columns:
        batch = embed(batch, collection.embedder, "content", "embedding")
    rows = last_per_id(collection.prepare(batch), collection.schema.id_column)
    collection.replace_log(rows, seq)
