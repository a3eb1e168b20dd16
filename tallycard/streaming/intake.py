"""Messages of a stream into a table, with broken ones set apart.

A message that does not fit the schema neither stops the stream, at every restart anew, nor is lost: it goes to a table of
its own, from which it can be mended and sent again.
"""

from pyspark.sql import functions as F

from tallycard.functions.messages import decode_with_broken
from tallycard.streaming.authorize import _run

# What readers of the two tables do not see: the micro-batch that a row came with.
BATCH = "intake_batch"


def take_in(messages, schema, sink, broken_sink, checkpoint, column="value"):
    """Append what the source holds to `sink`, and broken messages as (broken) to `broken_sink`, then stop.

    Micro-batch n is `intake_batch=n` in both, and is replaced as a whole if it is repeated after a failure, so each
    message is there once. Run again on the same checkpoint, it goes on where it stopped. Returns the number of
    messages that fit and of those that are broken.
    """
    counts = [0, 0]

    def store(batch, number):
        decoded = decode_with_broken(batch, schema, column).persist()
        try:
            fits = decoded.where(F.col("broken").isNull()).drop("broken")
            broken = decoded.where(F.col("broken").isNotNull()).select("broken")
            for place, (rows, path) in enumerate(((fits, sink), (broken, broken_sink))):
                folder = f"{path}/{BATCH}={number}"
                rows.write.mode("overwrite").parquet(folder)
                counts[place] += rows.sparkSession.read.schema(rows.schema).parquet(folder).count()
        finally:
            decoded.unpersist()

    _run(messages.sparkSession, messages.writeStream.foreachBatch(store), checkpoint)
    return tuple(counts)


def taken_in(spark, schema, sink):
    """The rows of one of the tables, of all micro-batches."""
    return spark.read.schema(schema).parquet(sink).select(*schema.names)
