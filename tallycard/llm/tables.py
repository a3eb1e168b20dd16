"""Reading the given tables, and keeping tables between the steps of an operator."""

from pyspark.sql import functions as F

from tallycard.sources.scratch import scratch_dir


def table(spark, folder, name):
    """A table of the data folder, by any path that Spark reads."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def kept(frame, purpose):
    """`frame` written to the shared scratch folder and read back.

    Cuts the lineage: what follows reads files, which outlive an executor, and never computes `frame` again.
    """
    spark = frame.sparkSession
    path = scratch_dir(spark, purpose)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def blocks(rows, size):
    """How many blocks of about `size` rows hold `rows` rows; one at least."""
    return max(1, -(-rows // size))


def text_of(name="text"):
    """A text column with null as the empty text."""
    return F.coalesce(F.col(name), F.lit(""))


def slices(batch, column, most):
    """Consecutive slices of an Arrow batch whose strings in `column` have about `most` bytes together.

    A single longer text is a slice of its own.
    """
    import pyarrow.compute as pc

    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for at, length in enumerate(lengths.tolist()):
        if at > start and held + length > most:
            yield batch.slice(start, at - start)
            start, held = at, 0
        held += length
    if start < batch.num_rows:
        yield batch.slice(start)


_HELD = {}


def held(make, argument):
    """`make(argument)`, one for all tasks of a Python worker until another one is asked for."""
    key = (make.__module__, make.__qualname__, argument)
    if key not in _HELD:
        release()
        _HELD[key] = make(argument)
    return _HELD[key]


def release():
    """Drop what earlier tasks of this worker have left, and what Arrow keeps for later ones."""
    import pyarrow as pa

    _HELD.clear()
    pa.default_memory_pool().release_unused()
