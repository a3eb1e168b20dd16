"""The four bank tables derived from the `customer` and `orders` test tables.

All arithmetic is on integers, so every engine derives the same rows. Cards come from `explode` on
the customer row, so the derivation is one pass over each table.
"""

from collections.abc import Mapping

from pyspark.sql import functions as F

from tallycard import schemas

# What is read of the test tables; a declared schema spares the look into the files.
_CUSTOMER = "c_custkey bigint, c_name string, c_nationkey int"
_ORDERS = "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate timestamp_ntz"

_CUSTOMERS = """
  CAST(c_custkey AS BIGINT) AS customer_id,
  c_name AS name,
  concat('555-', lpad(CAST(c_custkey AS STRING), 7, '0')) AS phone_number,
  concat(CAST(c_custkey AS STRING), ' Main Street, City ', CAST(c_nationkey AS STRING), ', NY ',
    lpad(CAST((c_custkey * 7919) % 100000 AS STRING), 5, '0')) AS address,
  concat('c', CAST(c_custkey AS STRING), '@example.org') AS email,
  CAST(580 + (c_custkey * 37) % 271 AS INT) AS credit_score,
  CAST(27800 + 100 * (c_custkey % 997) AS DOUBLE) AS annual_income
"""

_LIMIT = """
  CASE (c_custkey + k) % 4
    WHEN 0 THEN 700 + 100 * (c_custkey % 23)
    WHEN 1 THEN 3100 + 100 * (c_custkey % 59)
    WHEN 2 THEN 9200 + 100 * (c_custkey % 127)
    ELSE 22000 + 100 * (c_custkey % 613)
  END
"""

_CARDS = """
  CAST(c_custkey * 3 + k AS BIGINT) AS card_id,
  CAST(c_custkey AS BIGINT) AS customer_id,
  CAST(1 + (c_custkey + k) % 4 AS BIGINT) AS card_type_id,
  concat('4000-', lpad(CAST(c_custkey * 3 + k AS STRING), 8, '0')) AS card_number,
  concat(lpad(CAST(1 + c_custkey % 12 AS STRING), 2, '0'), '/', CAST(25 + k AS STRING))
    AS expiration_date,
  CAST(lim AS DOUBLE) AS credit_limit,
  CAST(CAST(lim * ((c_custkey * 17 + k * 5) % 90) AS DECIMAL(18,2)) / 100 AS DOUBLE)
    AS current_balance,
  CAST(concat('2024-01-', lpad(CAST(1 + c_custkey % 28 AS STRING), 2, '0')) AS DATE) AS issue_date
"""

_TRANSACTIONS = """
  CAST(o_orderkey AS BIGINT) AS transaction_id,
  CAST(o_custkey * 3 + o_orderkey % (o_custkey % 3 + 1) AS BIGINT) AS card_id,
  concat('Merchant#', CAST(o_orderkey % 97 AS STRING)) AS merchant_name,
  o_orderdate AS timestamp,
  CAST(CASE WHEN o_orderkey % 6 = 0 THEN -cents ELSE cents END AS DOUBLE) / 100 AS amount,
  CASE WHEN o_orderkey % 53 = 0 THEN 'Online' ELSE
    concat('Shop ', CAST(o_orderkey % 97 AS STRING), ', Town, ',
      CASE WHEN o_orderkey % 2 = 0 THEN 'NY' ELSE 'CA' END, ' ',
      lpad(CAST(
        CASE WHEN o_orderkey % 7 = 0 THEN (o_custkey * 7919 + 50000) % 100000
        ELSE (o_custkey * 7919) % 100000 - (o_custkey * 7919) % 10000 + o_orderkey % 10000 END
        AS STRING), 5, '0'))
  END AS location,
  CASE WHEN o_orderkey % 6 = 0 THEN 'refund' WHEN o_orderkey % 101 = 0 THEN 'cancellation'
    WHEN o_orderkey % 4 = 1 THEN 'wire_transfer' ELSE 'purchase' END AS transaction_type,
  CASE WHEN o_orderkey % 6 = 0 AND o_orderkey > 0 THEN CAST(o_orderkey - 1 AS STRING) END
    AS related_transaction_id
"""

# Invented tiers; no operator reads them.
_CARD_TYPES = [
    (1, "Basic", 300, 610, 700, 3000, 0, 0.0),
    (2, "Plus", 611, 705, 3100, 9000, 40, 0.004),
    (3, "Travel", 706, 777, 9200, 21900, 130, 0.012),
    (4, "Select", 778, 900, 22000, 83300, 310, 0.023),
]


def _columns(df, text):
    """`selectExpr` on a comma-separated select list."""
    return df.sparkSession.sql(f"SELECT {text} FROM {{df}}", df=df)


def _table(spark, folder, name, schema):
    return spark.read.schema(schema).parquet(f"{folder}/{name}.parquet")


def customers(spark, folder):
    return _columns(_table(spark, folder, "customer", _CUSTOMER), _CUSTOMERS)


def card_types(spark):
    return spark.createDataFrame(_CARD_TYPES, schemas.CARD_TYPES)


def cards(spark, folder):
    """One to three cards per customer; each fiftieth customer has none."""
    held = (
        _table(spark, folder, "customer", _CUSTOMER)
        .where("c_custkey % 50 <> 49")
        .select("c_custkey", F.explode(F.expr("sequence(0, CAST(c_custkey % 3 AS INT))")).alias("k"))
        .withColumn("lim", F.expr(_LIMIT))
    )
    return _columns(held, _CARDS)


def transactions(spark, folder):
    orders = _table(spark, folder, "orders", _ORDERS)
    return _columns(
        orders.withColumn("cents", F.expr("CAST(floor(o_totalprice) AS BIGINT)")), _TRANSACTIONS
    )


class Bank(Mapping):
    """The four tables by name, each derived when it is first asked for."""

    def __init__(self, spark, folder):
        self._make = {
            "customers": lambda: customers(spark, folder),
            "credit_card_types": lambda: card_types(spark),
            "cards": lambda: cards(spark, folder),
            "transactions": lambda: transactions(spark, folder),
        }
        self._made = {}

    def __getitem__(self, name):
        if name not in self._made:
            self._made[name] = self._make[name]()
        return self._made[name]

    def __iter__(self):
        return iter(self._make)

    def __len__(self):
        return len(self._make)
