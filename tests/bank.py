"""Small bank tables, and the authorisation rules once more in plain floats."""

import datetime
import re

from tallycard import schemas
from tallycard.operators.rules import BOOKED

NOON = datetime.datetime(2024, 1, 5, 12)
HOME = "4 Elm Rd, Delta, WA 31472"
NEAR = "7 Quay, Delta, WA 36905"
FAR = "7 Quay, Ocala, FL 81472"


def customers(spark, *rows):
    """(customer_id, address[, credit_score])"""
    full = [(r[0], "n", "p", r[1], "e", r[2] if len(r) > 2 else 700, 1.0) for r in rows]
    return spark.createDataFrame(full, schemas.CUSTOMERS)


def cards(spark, *rows):
    """(card_id, customer_id, limit, balance)"""
    day = datetime.date(2024, 1, 1)
    full = [(r[0], r[1], 1, "c", "01/27", r[2], r[3], day) for r in rows]
    return spark.createDataFrame(full, schemas.CARDS)


def transactions(spark, *rows):
    """(id, card_id, amount[, type[, location[, minute]]])"""
    full = []
    for row in rows:
        number, card, amount, kind, place, minute = (*row, *("purchase", NEAR, None)[len(row) - 3 :])
        when = NOON + datetime.timedelta(minutes=number if minute is None else minute)
        full.append((number, card, "m", when, amount, place, kind, None))
    return spark.createDataFrame(full, schemas.TRANSACTIONS)


def step(balance, kind, cents, limit):
    """One transaction against a balance, in the rules' kinds: (approved, balance after it)."""
    total = balance + cents
    approved = kind >= BOOKED and total <= limit
    return approved, total if approved or kind == BOOKED else balance


def zip_of(address):
    found = re.search(r",\s[A-Z]{2}\s(\d{5})$", (address or "").strip())
    return found.group(1) if found else ""


def authorise(rows, limit, balance, home):
    """(status, pending balance) per (amount, type, location) row of one card, in order."""
    out = []
    for amount, kind, place in rows:
        exempt = kind in ("refund", "cancellation")
        ok = True
        if amount >= 0 and not exempt:
            shop, house = zip_of(place), zip_of(home)
            near = bool(shop and house) and shop[0] == house[0]
            ok = amount < limit / 2 and near
        ok = ok and round(balance + amount, 2) <= limit
        if ok or exempt:
            balance = round(balance + amount, 2)
        out.append(("pending" if ok else "declined", balance))
    return out
