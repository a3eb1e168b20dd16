"""Tables in a relational database."""

import datetime
from dataclasses import dataclass, field

from tallycard import schemas
from tallycard.sources.scratch import scratch_dir


@dataclass
class Database:
    """Connection options of a JDBC database."""

    url: str
    driver: str
    user: str
    password: str = field(repr=False)
    fetch_size: int = 10_000

    def options(self):
        return {
            "url": self.url,
            "driver": self.driver,
            "user": self.user,
            "password": self.password,
            "fetchsize": str(self.fetch_size),
            "preferTimestampNTZ": "true",
        }

    def properties(self):
        """The form `spark.read.jdbc` takes next to the URL."""
        return {name: value for name, value in self.options().items() if name != "url"}


def split_options(key, low, high, parts):
    """Read a table in `parts` ranges of an integer key, one task each, instead of in a single task."""
    if parts < 2:
        return {}
    return {
        "partitionColumn": key,
        "lowerBound": str(low),
        "upperBound": str(high),
        "numPartitions": str(parts),
    }


def day_query(table, first, last=None):
    """Subquery the database runs: a closed range of days as a range on the bare column."""
    after = (last or first) + datetime.timedelta(days=1)
    return (
        f"(SELECT * FROM {table} WHERE timestamp >= '{first} 00:00:00' "
        f"AND timestamp < '{after} 00:00:00') AS day_rows"
    )


def read_table(spark, database, table, **split):
    """A table, or a parenthesised subquery with alias. Pass `split_options` for big ones."""
    reader = spark.read.format("jdbc").options(**database.options())
    return reader.options(dbtable=table, **split).load()


def read_bank_table(spark, database, name, parts=1):
    """One of the bank tables, in `parts` tasks that share the actual range of its primary key."""
    key, split = schemas.PRIMARY_KEYS[name], {}
    if parts > 1:
        ends = f"(SELECT MIN({key}) AS low, MAX({key}) AS high FROM {name}) AS key_range"
        low, high = read_table(spark, database, ends).first()
        if low is not None:
            split = dict(column=key, lowerBound=low, upperBound=high, numPartitions=parts)
    return spark.read.jdbc(database.url, name, properties=database.properties(), **split)


def overwrite_table(df, database, table, batch_size=10_000):
    """Replace a table's rows and keep its definition.

    `df` may read the very table, so it is stored first and only then is the table emptied: the write
    cannot read its own output, and a failed write can be repeated from the stored rows.
    """
    stored = scratch_dir(df.sparkSession, f"jdbc-{table}")
    df.write.parquet(stored)
    rows = df.sparkSession.read.schema(df.schema).parquet(stored)
    writer = rows.write.format("jdbc").options(**database.options())
    writer.options(dbtable=table, truncate="true", batchsize=str(batch_size)).mode(
        "overwrite"
    ).save()
    return stored
