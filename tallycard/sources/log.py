"""The transaction log: a Kafka topic of JSON messages keyed by card.

One card's messages share a topic partition, so they stay in the order in which they were sent.
The connector package (spark-sql-kafka) must be on the class path.
"""

from pyspark.sql import functions as F

from tallycard import schemas
from tallycard.functions.messages import as_message, decode
from tallycard.operators.days import transactions_between
from tallycard.operators.heavy import HEAVY_ROWS
from tallycard.streaming.replay import waves


def to_messages(transactions):
    """Kafka rows: `key` is the card, `value` the JSON record."""
    return transactions.select(
        F.col("card_id").cast("string").alias("key"), as_message(transactions.schema).alias("value")
    )


def from_messages(messages):
    return decode(messages, schemas.TRANSACTIONS)


def send(messages, servers, topic):
    writer = messages.write.format("kafka")
    writer.option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def publish(transactions, servers, topic, heavy_rows=HEAVY_ROWS):
    """Send transactions in time order within each card.

    One task sends a card's rows, but not more than about `heavy_rows` of them in one job; what is left of the card follows
    in the next one.
    """
    for wave in waves(transactions, heavy_rows):
        send(to_messages(wave), servers, topic)


def replay(transactions, servers, topic, ranges):
    """Send ranges of days, oldest first; each is sent in full before the next one starts."""
    for first, last in ranges:
        publish(transactions_between(transactions, first, last), servers, topic)


def subscribe(spark, servers, topic, max_offsets=None):
    """Transactions of a topic from its beginning; the query's checkpoint keeps the position."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets))
    return from_messages(reader.load())
