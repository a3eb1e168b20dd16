"""The registered queries: every operator over the bank tables derived from a data folder."""

import datetime
import uuid

from pyspark.sql import functions as F

from tallycard import fixtures, schemas, session
from tallycard.functions.messages import as_message, decode
from tallycard.functions.places import zip_code
from tallycard.operators import checks, days, rules, serving, settle
from tallycard.operators.authorize import authorize, declined_report, unknown_card_declines
from tallycard.plans import batch, lambda_job
from tallycard.sources.by_card import store_by_card
from tallycard.sources.files import read_csv, write_csv
from tallycard.sources.scratch import scratch_dir
from tallycard.streaming.authorize import authorize_stream, drain
from tallycard.streaming.intake import take_in, taken_in
from tallycard.streaming.replay import day_ranges, landed, replay

# The day the day query asks for.
DAY = datetime.date(1997, 6, 18)
# Cards with more rows than this are cut into segments in `authorize_split_cards`.
SPLIT_ROWS = 14

_REGISTRY = {}


def _query(function):
    """Register a function of the bank tables under its name."""

    def run(spark, folder):
        session.ship(spark)
        return function(fixtures.Bank(spark, folder))

    _REGISTRY[function.__name__] = run
    return function


def queries():
    return dict(_REGISTRY)


def _authorised(bank, **options):
    return authorize(bank["transactions"], bank["cards"], bank["customers"], **options)


def _judged(bank):
    """Transactions next to their account, for the stateless rules."""
    held = rules.accounts(bank["cards"], bank["customers"])
    return rules.with_accounts(bank["transactions"], held)


def _totals(bank):
    """Per-card totals, from only those columns of the transactions that they need."""
    authorised = _authorised(bank, columns=settle.TOTALS_FROM, mark_last=True)
    return settle.card_totals(settle.approve_pending(authorised))


def _scratch(bank, purpose):
    return scratch_dir(bank["transactions"].sparkSession, purpose)


# Calendar and counts


@_query
def distinct_dates(bank):
    return days.distinct_dates(bank["transactions"])


@_query
def replay_day_counts(bank):
    return days.day_counts(bank["transactions"])


@_query
def transactions_by_date(bank):
    return days.transactions_by_date(bank["transactions"], DAY)


@_query
def transaction_count(bank):
    return days.transaction_count(bank["transactions"])


# Stateless rules


@_query
def zip_extract(bank):
    return bank["transactions"].select("transaction_id", zip_code(F.col("location")).alias("zip"))


@_query
def zip_proximity(bank):
    return _judged(bank).select(
        "transaction_id",
        "merchant_zip",
        F.coalesce("home_zip", F.lit("")).alias("home_zip"),
        rules.is_close().alias("is_close"),
    )


@_query
def half_limit_rule(bank):
    return _judged(bank).select(
        "transaction_id",
        "amount",
        "credit_limit",
        F.coalesce(rules.breaks_half_limit(), F.lit(False)).alias("declined"),
    )


@_query
def location_rule(bank):
    return _judged(bank).select("transaction_id", rules.breaks_distance().alias("declined"))


@_query
def stateless_precheck(bank):
    held = rules.accounts(bank["cards"], bank["customers"])
    return rules.precheck(bank["transactions"], held).select(
        "transaction_id", "card_id", "rule", "kind", "cents", "limit_cents", "opening_cents"
    )


@_query
def unknown_card_declined(bank):
    return unknown_card_declines(bank["transactions"], bank["cards"])


# Authorisation


@_query
def authorize_transactions(bank):
    return _authorised(bank)


@_query
def authorize_split_cards(bank):
    return _authorised(bank, heavy_rows=SPLIT_ROWS)


@_query
def authorize_by_card(bank):
    """Over tables that are stored by card, so neither side is shuffled."""
    tables = [bank[name] for name in ("transactions", "cards", "customers")]
    stored = store_by_card(*tables, f"by_card_{uuid.uuid4().hex}", buckets=8)
    return authorize(stored.transactions, None, None, held=stored.accounts)


@_query
def declined_transactions(bank):
    return declined_report(bank["transactions"], bank["cards"], bank["customers"])


@_query
def stream_authorize(bank):
    spark, folder = bank["transactions"].sparkSession, _scratch(bank, "stream")
    days = day_ranges(bank["transactions"], 2)
    replay(bank["transactions"], f"{folder}/landing", days, by_card=True)
    stream = landed(spark, f"{folder}/landing", schemas.TRANSACTIONS, by_card=True)
    judged = authorize_stream(stream, bank["cards"], bank["customers"])
    drain(judged, f"{folder}/sink", f"{folder}/checkpoint")
    return spark.read.parquet(f"{folder}/sink")


@_query
def stream_declined(bank):
    spark, folder = bank["transactions"].sparkSession, _scratch(bank, "stream")
    replay(bank["transactions"], f"{folder}/landing", day_ranges(bank["transactions"], 2))
    stream = landed(spark, f"{folder}/landing", schemas.TRANSACTIONS)
    judged = authorize_stream(stream, bank["cards"], bank["customers"], reasons=True)
    drain(judged, f"{folder}/sink", f"{folder}/checkpoint")
    declined = spark.read.parquet(f"{folder}/sink").where("status = 'declined'")
    return declined.select("transaction_id", "card_id", "amount", "transaction_type", "decline_reason")


@_query
def stream_authorize_batches(bank):
    spark = bank["transactions"].sparkSession
    return lambda_job.authorise_history(spark, bank, _scratch(bank, "stream"), slices=2)


@_query
def stream_hot_cards(bank):
    """Cards with many rows land in several files, in order, and are authorised over several micro-batches."""
    spark, folder = bank["transactions"].sparkSession, _scratch(bank, "hot")
    days = day_ranges(bank["transactions"], 1)
    replay(bank["transactions"], f"{folder}/landing", days, by_card=True, heavy_rows=SPLIT_ROWS)
    stream = landed(spark, f"{folder}/landing", schemas.TRANSACTIONS, by_card=True, max_files=40)
    drain(authorize_stream(stream, bank["cards"], bank["customers"]), f"{folder}/sink", f"{folder}/checkpoint")
    return spark.read.parquet(f"{folder}/sink")


@_query
def messages_taken_in(bank):
    """What a stream of messages leaves in the table if every fiftieth is cut off in the middle."""
    spark, folder = bank["transactions"].sparkSession, _scratch(bank, "intake")
    whole = F.col("value")
    half = F.substring(whole, F.lit(1), F.floor(F.length(whole) / 2).cast("int"))
    sent = bank["transactions"].select("transaction_id", as_message(schemas.TRANSACTIONS).alias("value"))
    sent = sent.select(F.when(F.col("transaction_id") % 50 == 0, half).otherwise(whole).alias("value"))
    sent.write.parquet(f"{folder}/messages")
    stream = spark.readStream.schema(sent.schema).parquet(f"{folder}/messages")
    take_in(stream, schemas.TRANSACTIONS, f"{folder}/sink", f"{folder}/broken", f"{folder}/checkpoint")
    return taken_in(spark, schemas.TRANSACTIONS, f"{folder}/sink")


# Batch


@_query
def approve_pending(bank):
    return settle.approve_pending(_authorised(bank))


@_query
def last_pending_balance(bank):
    return _totals(bank).select("card_id", "pending_balance")


@_query
def approved_sum(bank):
    authorised = _authorised(bank, columns=settle.TOTALS_FROM)
    return settle.approved_sum(settle.approve_pending(authorised))


@_query
def reconcile_balances(bank):
    return settle.reconcile(_totals(bank), bank["cards"])


@_query
def settle_balances(bank):
    return settle.settle_balances(bank["cards"], _totals(bank))


@_query
def credit_utilisation(bank):
    return settle.credit_utilisation(bank["cards"])


@_query
def score_adjustment(bank):
    return settle.adjust_scores(bank["customers"], bank["cards"])


@_query
def credit_limit_revision(bank):
    scored = settle.adjust_scores(bank["customers"], bank["cards"])
    return settle.revise_limits(bank["cards"], scored)


def _settled(bank):
    authorised = _authorised(bank, columns=settle.TOTALS_FROM, mark_last=True)
    return batch.settle_day(authorised, bank["cards"], bank["customers"])


@_query
def cards_updated(bank):
    return _settled(bank).cards_updated


@_query
def customers_updated(bank):
    return _settled(bank).customers_updated


@_query
def batch_transactions(bank):
    return batch.settle_day(_authorised(bank), bank["cards"], bank["customers"]).batch_transactions


@_query
def lambda_cards_updated(bank):
    spark = bank["transactions"].sparkSession
    return lambda_job.run(spark, bank, _scratch(bank, "lambda"), slices=2)["cards_updated"]


@_query
def whole_job_from_csv(bank):
    spark, folder = bank["transactions"].sparkSession, _scratch(bank, "whole")
    for name, table in bank.items():
        write_csv(table, f"{folder}/csv/{name}")
    csv = {name: f"{folder}/csv/{name}" for name in bank}
    return lambda_job.whole(spark, csv, folder, slices=1)["customers_updated"]


# Checks, codecs, serving


@_query
def primary_key_check(bank):
    return checks.primary_key_check(bank)


@_query
def completeness_check(bank):
    key = schemas.PRIMARY_KEYS["transactions"]
    return checks.completeness(bank["transactions"], _authorised(bank, columns=(key, "timestamp")), key)


@_query
def off_cent_amounts(bank):
    return checks.off_cent_amounts(bank["transactions"])


@_query
def json_roundtrip(bank):
    rows = bank["transactions"]
    return decode(rows.select(as_message(rows.schema).alias("value")), schemas.TRANSACTIONS)


@_query
def csv_roundtrip(bank):
    rows, path = bank["transactions"], _scratch(bank, "csv")
    write_csv(rows, path)
    return read_csv(rows.sparkSession, path, schemas.TRANSACTIONS)


@_query
def serving_preview_cards(bank):
    return serving.preview(bank["cards"], schemas.PRIMARY_KEYS["cards"])


@_query
def serving_preview_customers(bank):
    return serving.preview(bank["customers"], schemas.PRIMARY_KEYS["customers"])


@_query
def serving_preview_transactions(bank):
    return serving.preview(bank["transactions"], schemas.PRIMARY_KEYS["transactions"])
