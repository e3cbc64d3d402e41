"""Answering questions as they arrive (Structured Streaming).

The original answers one question per invocation. Here questions may arrive
as a stream (files landing in a folder, a message bus); every micro-batch is
a table of questions and is answered by the same batch plan
(``graph_rag`` / ``vector_rag``) through ``foreachBatch``. No streaming
state is needed: each question is answered from the stored graph alone.

Exactly-once output: each micro-batch is written to its own ``batch_id``
partition with dynamic partition overwrite, so a batch that is replayed
after a failure replaces its earlier partial output instead of duplicating
it. This holds as long as the batches keep their numbers, so the checkpoint
location has to be named and kept with the sink: a stream that is started
again goes on after its last batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def answer_stream(questions: DataFrame, answer: Callable[[DataFrame], DataFrame], sink_path: str,
                  *, checkpoint_location: str, trigger: dict | None = None,
                  query_name: str | None = None) -> StreamingQuery:
    """Start a streaming query that answers every micro-batch of ``questions``.

    questions: a streaming DataFrame of question rows (e.g. question_id,
    question, embedding); answer: batch plan applied to each micro-batch;
    sink_path: Parquet folder, partitioned by batch_id; checkpoint_location:
    the stream's own folder on shared storage, one for each sink.
    ``trigger`` is passed to ``DataStreamWriter.trigger`` (default:
    process what is available, then stop)."""
    def run(batch: DataFrame, batch_id: int) -> None:
        out = answer(batch).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id").parquet(sink_path))

    writer = questions.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint_location)
    if query_name:
        writer = writer.queryName(query_name)
    writer = writer.trigger(**(trigger or {"availableNow": True}))
    return writer.start()
