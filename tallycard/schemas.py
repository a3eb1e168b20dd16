"""Declared schemas of the bank tables. `timestamp` has no time zone."""

from pyspark.sql import types as T


def _table(**columns):
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_ID, _INT, _TEXT, _MONEY = T.LongType(), T.IntegerType(), T.StringType(), T.DoubleType()

CUSTOMERS = _table(
    customer_id=_ID,
    name=_TEXT,
    phone_number=_TEXT,
    address=_TEXT,
    email=_TEXT,
    credit_score=_INT,
    annual_income=_MONEY,
)

CARD_TYPES = _table(
    card_type_id=_ID,
    name=_TEXT,
    credit_score_min=_INT,
    credit_score_max=_INT,
    credit_limit_min=_INT,
    credit_limit_max=_INT,
    annual_fee=_INT,
    rewards_rate=_MONEY,
)

CARDS = _table(
    card_id=_ID,
    customer_id=_ID,
    card_type_id=_ID,
    card_number=_TEXT,
    expiration_date=_TEXT,
    credit_limit=_MONEY,
    current_balance=_MONEY,
    issue_date=T.DateType(),
)

TRANSACTIONS = _table(
    transaction_id=_ID,
    card_id=_ID,
    merchant_name=_TEXT,
    timestamp=T.TimestampNTZType(),
    amount=_MONEY,
    location=_TEXT,
    transaction_type=_TEXT,
    related_transaction_id=_TEXT,
)

AUTHORISED = T.StructType(
    TRANSACTIONS.fields
    + [T.StructField("status", _TEXT), T.StructField("pending_balance", _MONEY)]
)

TABLES = {
    "customers": CUSTOMERS,
    "credit_card_types": CARD_TYPES,
    "cards": CARDS,
    "transactions": TRANSACTIONS,
}

PRIMARY_KEYS = {
    "customers": "customer_id",
    "credit_card_types": "card_type_id",
    "cards": "card_id",
    "transactions": "transaction_id",
}
