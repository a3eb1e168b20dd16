"""ANSI SQL with the same results as the registered queries, for an independent engine.

Nothing here is run by Spark. The running balance is a recursive query, one step per row of a card.
"""

from tallycard import catalog, fixtures

_TYPES = ", ".join(str(row) for row in fixtures._CARD_TYPES)

_BANK = f"""
customers AS (SELECT {fixtures._CUSTOMERS} FROM customer),
credit_card_types AS (
  SELECT CAST(a AS BIGINT) AS card_type_id, b AS name, CAST(c AS INT) AS credit_score_min,
    CAST(d AS INT) AS credit_score_max, CAST(e AS INT) AS credit_limit_min,
    CAST(f AS INT) AS credit_limit_max, CAST(g AS INT) AS annual_fee, CAST(h AS DOUBLE) AS rewards_rate
  FROM (VALUES {_TYPES}) v(a, b, c, d, e, f, g, h)),
cards AS (SELECT {fixtures._CARDS} FROM (
  SELECT c_custkey, k, {fixtures._LIMIT} AS lim
  FROM customer, (VALUES (0), (1), (2)) ks(k)
  WHERE k <= c_custkey % 3 AND c_custkey % 50 <> 49) held),
transactions AS (SELECT {fixtures._TRANSACTIONS} FROM (
  SELECT *, CAST(floor(o_totalprice) AS BIGINT) AS cents FROM orders) o)
"""

_ZIP = r"regexp_extract(trim({0}), ',\s[A-Z]{{2}}\s(\d{{5}})$', 1)"
_CENTS = "CAST(round({0} * 100) AS BIGINT)"
_DOLLARS = "CAST({0} AS DOUBLE) / 100"

_JUDGED = f"""
judged AS (
  SELECT t.*, k.customer_id, k.credit_limit, k.current_balance, c.address AS home_address,
    k.card_id IS NOT NULL AS has_card, c.customer_id IS NOT NULL AS has_holder,
    coalesce({_ZIP.format('c.address')}, '') AS home_zip,
    coalesce({_ZIP.format('t.location')}, '') AS merchant_zip,
    {_CENTS.format('t.amount')} AS cents,
    {_CENTS.format('k.credit_limit')} AS limit_cents,
    {_CENTS.format('k.current_balance')} AS opening_cents,
    t.transaction_type IN ('refund', 'cancellation') AS exempt
  FROM transactions t LEFT JOIN cards k ON t.card_id = k.card_id
    LEFT JOIN customers c ON k.customer_id = c.customer_id),
ruled AS (
  SELECT *,
    merchant_zip <> '' AND home_zip <> '' AND merchant_zip[1] = home_zip[1] AS is_close,
    amount >= 0 AND NOT exempt AND coalesce(2 * cents >= limit_cents, FALSE) AS half
  FROM judged),
pre AS (
  SELECT *, amount >= 0 AND NOT exempt AND NOT is_close AS far,
    CASE WHEN NOT has_card THEN 'card' WHEN NOT has_holder THEN 'customer' WHEN half THEN 'half'
      WHEN amount >= 0 AND NOT exempt AND NOT is_close THEN 'distance' END AS rule,
    row_number() OVER (PARTITION BY card_id ORDER BY timestamp, transaction_id) AS rn
  FROM ruled)
"""

_AUTH = """
fold AS (
  SELECT card_id, rn, transaction_id,
    CASE WHEN rule IS NULL AND opening_cents + cents <= limit_cents THEN TRUE ELSE FALSE END AS ok,
    CASE WHEN exempt OR (rule IS NULL AND opening_cents + cents <= limit_cents)
      THEN opening_cents + cents ELSE opening_cents END AS balance
  FROM pre WHERE rn = 1 AND has_holder
  UNION ALL
  SELECT p.card_id, p.rn, p.transaction_id,
    CASE WHEN p.rule IS NULL AND f.balance + p.cents <= p.limit_cents THEN TRUE ELSE FALSE END,
    CASE WHEN p.exempt OR (p.rule IS NULL AND f.balance + p.cents <= p.limit_cents)
      THEN f.balance + p.cents ELSE f.balance END
  FROM fold f JOIN pre p ON p.card_id = f.card_id AND p.rn = f.rn + 1),
folded AS (
  SELECT p.*, coalesce(f.ok, FALSE) AS ok, f.balance
  FROM pre p LEFT JOIN fold f ON p.transaction_id = f.transaction_id),
authorised AS (
  SELECT transaction_id, card_id, merchant_name, timestamp, amount, location, transaction_type,
    related_transaction_id, CASE WHEN ok THEN 'pending' ELSE 'declined' END AS status,
    CAST(balance AS DOUBLE) / 100 AS pending_balance
  FROM folded)
"""

_BATCH = """
approved AS (
  SELECT * REPLACE (CASE WHEN status = 'pending' THEN 'approved' ELSE status END AS status)
  FROM authorised),
last_pending AS (
  SELECT card_id, pending_balance FROM (
    SELECT card_id, pending_balance,
      row_number() OVER (PARTITION BY card_id ORDER BY timestamp DESC, transaction_id DESC) AS back
    FROM approved) WHERE back = 1),
sums AS (
  SELECT card_id, CAST(sum(CAST(round(amount * 100) AS BIGINT)) AS BIGINT) AS sum_cents
  FROM approved WHERE status = 'approved' GROUP BY card_id),
settled AS (
  SELECT c.* REPLACE (coalesce(l.pending_balance, c.current_balance) AS current_balance)
  FROM cards c LEFT JOIN last_pending l ON c.card_id = l.card_id)
"""


def _scoring(cards):
    return f"""
usage AS (
  SELECT customer_id, CAST(b AS DOUBLE) AS total_balance, CAST(l AS DOUBLE) AS total_limit,
    CASE WHEN l <> 0 THEN CAST(b AS DOUBLE) / CAST(l AS DOUBLE) * 100 END AS usage_percentage
  FROM (SELECT customer_id, sum(CAST(current_balance AS DECIMAL(18,2))) AS b,
      sum(CAST(credit_limit AS DECIMAL(18,2))) AS l FROM {cards} GROUP BY customer_id)),
change AS (
  SELECT customer_id, CAST(CASE WHEN usage_percentage IS NULL THEN NULL
    WHEN usage_percentage <= 10 THEN 15 WHEN usage_percentage <= 20 THEN 10
    WHEN usage_percentage <= 30 THEN 5 WHEN usage_percentage <= 50 THEN -5
    WHEN usage_percentage <= 70 THEN -15 ELSE -25 END AS INT) AS credit_score_change
  FROM usage),
scored AS (
  SELECT c.* REPLACE (CAST(c.credit_score + h.credit_score_change AS INT) AS credit_score),
    h.credit_score_change
  FROM customers c LEFT JOIN change h ON c.customer_id = h.customer_id),
limited AS (
  SELECT k.* REPLACE (CASE
    WHEN coalesce(s.credit_score_change, 0) >= 0 THEN k.credit_limit
    WHEN s.credit_score_change <= -20 THEN round_even(k.credit_limit * CAST(0.85 AS DOUBLE), -2)
    WHEN s.credit_score_change <= -10 THEN round_even(k.credit_limit * CAST(0.90 AS DOUBLE), -2)
    ELSE round_even(k.credit_limit * CAST(0.95 AS DOUBLE), -2) END AS credit_limit)
  FROM {cards} k LEFT JOIN scored s ON k.customer_id = s.customer_id)
"""


def _sql(select, *parts):
    return f"WITH RECURSIVE {', '.join((_BANK,) + parts)} {select}"


_RULES = (_JUDGED,)
_FOLD = (_JUDGED, _AUTH)
_SETTLED = (_JUDGED, _AUTH, _BATCH)
_OPENING = (_scoring("cards"),)
_ALL = (_JUDGED, _AUTH, _BATCH, _scoring("settled"))

_REASON = """
CASE WHEN rule = 'card' THEN concat('Card ID ', coalesce(CAST(card_id AS VARCHAR), 'None'), ' not found')
  WHEN rule = 'customer' THEN concat('Customer ID ', CAST(customer_id AS VARCHAR), ' not found')
  WHEN total > limit_cents THEN concat('Total balance ', {total}, ' exceeds credit limit ', {limit})
  WHEN rule = 'half' THEN concat('Amount ', {amount}, ' exceeds 50% of credit limit ', {limit})
  ELSE concat('Merchant location ', location, ' too far from customer address ', home_address) END
""".format(
    **{
        name: f"regexp_replace(CAST(CAST({cents} AS DECIMAL(18,2)) / 100 AS DECIMAL(18,2))::VARCHAR,"
        " '0$', '')"
        for name, cents in (("total", "total"), ("limit", "limit_cents"), ("amount", "cents"))
    }
)

_DECLINED = f"""
SELECT transaction_id, card_id, amount, transaction_type, {_REASON} AS decline_reason
FROM (SELECT *, CASE WHEN exempt THEN balance ELSE balance + cents END AS total FROM folded)
WHERE NOT ok
"""

_RECONCILE = f"""
SELECT card_id, pending_balance, current_balance, {_DOLLARS.format('expected')} AS expected_sum,
  {_DOLLARS.format('sum_cents')} AS recalculated_pending,
  {_DOLLARS.format('coalesce(expected, 0) - coalesce(sum_cents, 0)')} AS discrepancy
FROM (SELECT l.card_id, l.pending_balance, c.current_balance, s.sum_cents,
    {_CENTS.format('l.pending_balance')} - {_CENTS.format('c.current_balance')} AS expected
  FROM last_pending l LEFT JOIN cards c ON l.card_id = c.card_id
    LEFT JOIN sums s ON l.card_id = s.card_id)
WHERE coalesce(expected, 0) - coalesce(sum_cents, 0) <> 0
"""


def _key_check(table, key):
    return f"""SELECT '{table}' AS table_name, CAST(count(*) AS BIGINT) AS table_rows,
  CAST(count(*) - count({key}) AS BIGINT) AS null_keys,
  (SELECT count(*) FROM (SELECT {key} FROM {table} WHERE {key} IS NOT NULL GROUP BY {key}
    HAVING count(*) > 1)) AS repeated_keys FROM {table}"""


_KEY_CHECKS = " UNION ALL ".join(
    _key_check(table, key)
    for table, key in (
        ("customers", "customer_id"),
        ("credit_card_types", "card_type_id"),
        ("cards", "card_id"),
        ("transactions", "transaction_id"),
    )
)

_DAY = "strftime(timestamp, '%Y-%m-%d')"


def oracle_sql():
    return {
        "distinct_dates": _sql(f"SELECT DISTINCT {_DAY} AS date FROM transactions ORDER BY date"),
        "replay_day_counts": _sql(
            f"SELECT {_DAY} AS date, count(*) AS transactions FROM transactions GROUP BY 1 ORDER BY 1"
        ),
        "transactions_by_date": _sql(
            f"SELECT * FROM transactions WHERE CAST(timestamp AS DATE) = DATE '{catalog.DAY}'"
            " ORDER BY timestamp, transaction_id"
        ),
        "transaction_count": _sql("SELECT count(*) AS transaction_count FROM transactions"),
        "zip_extract": _sql(
            f"SELECT transaction_id, coalesce({_ZIP.format('location')}, '') AS zip FROM transactions"
        ),
        "zip_proximity": _sql(
            "SELECT transaction_id, merchant_zip, home_zip, is_close FROM pre", *_RULES
        ),
        "half_limit_rule": _sql(
            "SELECT transaction_id, amount, credit_limit, half AS declined FROM pre", *_RULES
        ),
        "location_rule": _sql("SELECT transaction_id, far AS declined FROM pre", *_RULES),
        "stateless_precheck": _sql(
            "SELECT transaction_id, card_id, rule, CAST(CASE WHEN rule IN ('card', 'customer') THEN -1"
            " WHEN rule IS NOT NULL THEN 0 WHEN exempt THEN 1 ELSE 2 END AS INT) AS kind, cents,"
            " limit_cents, opening_cents FROM pre",
            *_RULES,
        ),
        "unknown_card_declined": _sql(
            "SELECT transaction_id, card_id, 'declined' AS status,"
            " concat('Card ID ', CAST(card_id AS VARCHAR), ' not found') AS decline_reason"
            " FROM transactions t WHERE NOT EXISTS"
            " (SELECT 1 FROM cards k WHERE k.card_id = t.card_id)"
        ),
        "authorize_transactions": _sql("SELECT * FROM authorised", *_FOLD),
        "authorize_split_cards": _sql("SELECT * FROM authorised", *_FOLD),
        "authorize_by_card": _sql("SELECT * FROM authorised", *_FOLD),
        "stream_authorize_batches": _sql("SELECT * FROM authorised", *_FOLD),
        "stream_authorize": _sql("SELECT * FROM authorised", *_FOLD),
        "stream_hot_cards": _sql("SELECT * FROM authorised", *_FOLD),
        "messages_taken_in": _sql("SELECT * FROM transactions WHERE transaction_id % 50 <> 0"),
        "declined_transactions": _sql(_DECLINED, *_FOLD),
        "stream_declined": _sql(_DECLINED, *_FOLD),
        "whole_job_from_csv": _sql(
            "SELECT * EXCLUDE (credit_score_change) FROM scored ORDER BY customer_id", *_ALL
        ),
        "approve_pending": _sql("SELECT * FROM approved", *_SETTLED),
        "batch_transactions": _sql("SELECT * FROM approved", *_SETTLED),
        "last_pending_balance": _sql("SELECT * FROM last_pending", *_SETTLED),
        "approved_sum": _sql(
            f"SELECT card_id, {_DOLLARS.format('sum_cents')} AS recalculated_pending FROM sums",
            *_SETTLED,
        ),
        "reconcile_balances": _sql(_RECONCILE, *_SETTLED),
        "settle_balances": _sql("SELECT * FROM settled", *_SETTLED),
        "credit_utilisation": _sql("SELECT * FROM usage", *_OPENING),
        "score_adjustment": _sql("SELECT * FROM scored", *_OPENING),
        "credit_limit_revision": _sql("SELECT * FROM limited", *_OPENING),
        "cards_updated": _sql("SELECT * FROM limited ORDER BY card_id", *_ALL),
        "lambda_cards_updated": _sql("SELECT * FROM limited ORDER BY card_id", *_ALL),
        "customers_updated": _sql(
            "SELECT * EXCLUDE (credit_score_change) FROM scored ORDER BY customer_id", *_ALL
        ),
        "primary_key_check": _sql(_KEY_CHECKS),
        "completeness_check": _sql(
            "SELECT count(*) AS expected, count(*) AS processed, CAST(0 AS BIGINT) AS lost,"
            " CAST(0 AS BIGINT) AS doubled, 'ok' AS result FROM transactions"
        ),
        "off_cent_amounts": _sql(
            "SELECT * FROM transactions WHERE CAST(round(amount * 100) AS BIGINT) / 100.0::DOUBLE"
            " <> amount"
        ),
        "json_roundtrip": _sql("SELECT * FROM transactions"),
        "csv_roundtrip": _sql("SELECT * FROM transactions"),
        "serving_preview_cards": _sql("SELECT * FROM cards ORDER BY card_id LIMIT 20"),
        "serving_preview_customers": _sql("SELECT * FROM customers ORDER BY customer_id LIMIT 20"),
        "serving_preview_transactions": _sql(
            "SELECT * FROM transactions ORDER BY transaction_id LIMIT 20"
        ),
    }
