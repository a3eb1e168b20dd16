import datetime
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import bank
from tallycard.operators.authorize import authorize, declined_report, unknown_card_declines
from tallycard.operators import ledger
from tallycard.operators.ledger import settle
from tallycard.operators.rules import BLOCKED, BOOKED, GUARDED


def judge(spark, cases, limit=1000.0, balance=0.0, home=bank.HOME):
    """(status, pending balance) of the transactions of each case, one card per case."""
    made = [(c * 100 + n, c, *row) for c, rows in enumerate(cases) for n, row in enumerate(rows)]
    judged = authorize(
        bank.transactions(spark, *made),
        bank.cards(spark, *[(c, 10, limit, balance) for c in range(len(cases))]),
        bank.customers(spark, (10, home)),
        heavy_rows=None,
    )
    found = [[] for _ in cases]
    for row in judged.orderBy("transaction_id").collect():
        found[row["card_id"]].append((row["status"], row["pending_balance"]))
    return found


RULES = [
    # half the limit is too much, a cent less is not
    ([(500.0,)], [("declined", 0.0)]),
    ([(499.99,)], [("pending", 499.99)]),
    # the limit itself may be reached
    ([(400.0,), (400.0,), (200.0,)], [("pending", 400.0), ("pending", 800.0), ("pending", 1000.0)]),
    ([(400.0,), (400.0,), (200.01,)], [("pending", 400.0), ("pending", 800.0), ("declined", 800.0)]),
    # far away, or nowhere
    ([(1.0, "purchase", bank.FAR)], [("declined", 0.0)]),
    ([(1.0, "purchase", "Online")], [("declined", 0.0)]),
    ([(1.0, "purchase", None)], [("declined", 0.0)]),
    # credits and exempt types skip both rules, whatever their sign
    ([(-600.0, "purchase", bank.FAR)], [("pending", -600.0)]),
    ([(-600.0, "refund", bank.FAR)], [("pending", -600.0)]),
    ([(600.0, "refund", bank.FAR)], [("pending", 600.0)]),
    ([(600.0, "cancellation", "Online")], [("pending", 600.0)]),
    # declined, and booked all the same
    ([(1200.0, "cancellation")], [("declined", 1200.0)]),
    ([(1200.0, "refund"), (-100.0, "refund")], [("declined", 1200.0), ("declined", 1100.0)]),
    # a credit that is no refund is not booked while the balance stays above the limit
    ([(1200.0, "refund"), (-100.0, "purchase")], [("declined", 1200.0), ("declined", 1200.0)]),
    ([(1200.0, "refund"), (-200.0, "purchase")], [("declined", 1200.0), ("pending", 1000.0)]),
    # types are matched by case, and need not be given
    ([(1.0, "Refund", bank.FAR)], [("declined", 0.0)]),
    ([(1.0, None, bank.FAR)], [("declined", 0.0)]),
    ([(1.0, None, bank.NEAR)], [("pending", 1.0)]),
    # an amount that is missing changes nothing
    ([(1.0,), (None,), (None, "refund"), (2.0,)],
     [("pending", 1.0), ("declined", 1.0), ("declined", 1.0), ("pending", 3.0)]),
]


def test_rules(spark):
    found = judge(spark, [case for case, _ in RULES])
    for (case, expected), result in zip(RULES, found):
        assert result == expected, case


def test_first_row_starts_from_the_balance_of_the_card(spark):
    assert judge(spark, [[(100.0,), (1.0,)]], balance=900.01) == [
        [("declined", 900.01), ("pending", 901.01)]
    ]


def test_home_without_zip_declines(spark):
    assert judge(spark, [[(1.0,)]], home=None) == [[("declined", 0.0)]]


def test_cents_do_not_drift(spark):
    assert judge(spark, [[(0.1,)] * 30])[0][-1] == ("pending", 3.0)


def test_order_is_time_then_number(spark, rows):
    late = bank.transactions(
        spark, (1, 1, 400.0, "purchase", bank.NEAR, 9), (2, 1, 350.0, "purchase", bank.NEAR, 5),
        (3, 1, 300.0, "purchase", bank.NEAR, 5),
    )
    judged = authorize(
        late, bank.cards(spark, (1, 10, 1000.0, 0.0)), bank.customers(spark, (10, bank.HOME))
    )
    assert rows(judged, "transaction_id", "status", "pending_balance") == [
        (1, "declined", 650.0), (2, "pending", 350.0), (3, "pending", 650.0),
    ]


def unknown(spark):
    return (
        bank.transactions(
            spark, (1, 1, 5.0), (2, 2, 5.0), (3, 99, 5.0), (4, None, 5.0, "refund"), (5, 99, 1.0),
            (6, None, 1.0), (7, 2, 1.0),
        ),
        bank.cards(spark, (1, 10, 1000.0, 0.0), (2, 77, 1000.0, 0.0)),
        bank.customers(spark, (10, bank.HOME)),
    )


@pytest.mark.parametrize("heavy_rows", [None, 1])
def test_unknown_cards_and_customers_are_declined(spark, rows, heavy_rows):
    judged = authorize(*unknown(spark), heavy_rows=heavy_rows)
    assert rows(judged, "transaction_id", "status", "pending_balance") == [
        (1, "pending", 5.0), (2, "declined", None), (3, "declined", None), (4, "declined", None),
        (5, "declined", None), (6, "declined", None), (7, "declined", None),
    ]


def test_columns_of_the_result(spark):
    judged = authorize(*unknown(spark), reasons=True)
    assert judged.columns[-3:] == ["status", "pending_balance", "decline_reason"]
    assert judged.columns[:8] == unknown(spark)[0].columns


def test_reasons(spark, rows):
    report = declined_report(
        bank.transactions(
            spark, (1, 1, 500.0), (2, 1, 1.0, "purchase", bank.FAR), (3, 1, 950.5, "refund"),
            (4, 1, 100.25), (5, 1, 600.0, "purchase", bank.FAR), (6, 2, 1.0), (7, 99, 1.0),
            (8, 1, None), (9, 1, 200.0, "cancellation"),
        ),
        bank.cards(spark, (1, 10, 1000.0, 0.0), (2, 77, 1000.0, 0.0)),
        bank.customers(spark, (10, bank.HOME)),
    )
    assert rows(report, "transaction_id", "decline_reason") == [
        (1, "Amount 500.0 exceeds 50% of credit limit 1000.0"),
        (2, f"Merchant location {bank.FAR} too far from customer address {bank.HOME}"),
        (4, "Total balance 1050.75 exceeds credit limit 1000.0"),
        # the limit is checked last and its reason stays
        (5, "Total balance 1550.5 exceeds credit limit 1000.0"),
        (6, "Customer ID 77 not found"),
        (7, "Card ID 99 not found"),
        (8, "Amount missing"),
        (9, "Total balance 1150.5 exceeds credit limit 1000.0"),
    ]


def test_unknown_card_report(spark, rows):
    transactions, cards, _ = unknown(spark)
    assert rows(unknown_card_declines(transactions, cards), "transaction_id", "decline_reason") == [
        (3, "Card ID 99 not found"), (4, "Card ID None not found"),
        (5, "Card ID 99 not found"), (6, "Card ID None not found"),
    ]


_ROW = st.tuples(st.sampled_from([BLOCKED, BOOKED, GUARDED]), st.integers(-60, 60))
_CARD = st.tuples(st.integers(-20, 120), st.integers(0, 100), st.lists(_ROW, min_size=1, max_size=30))


@settings(max_examples=300, deadline=None)
@given(st.lists(_CARD, min_size=1, max_size=5), st.integers(1, 12))
def test_settle_equals_the_walk_row_by_row(cards, batch):
    """Over several cards and any cut into batches."""
    starts, kind, cents, booked, limit, expected = [], [], [], [], [], []
    for opening, bound, rows in cards:
        balance = total = opening
        for number, (what, amount) in enumerate(rows):
            total += amount if what >= BOOKED else 0
            approved, balance = bank.step(balance, what, amount, bound)
            starts.append(number == 0)
            kind.append(what)
            cents.append(amount)
            booked.append(total)
            limit.append(bound)
            expected.append((approved, balance))
    columns = [np.array(c) for c in (starts, kind, cents, booked, limit)]
    shift, found = 0, []
    for at in range(0, len(kind), batch):
        approved, balance, shift = settle(*[c[at : at + batch] for c in columns], shift)
        found += zip(approved.tolist(), balance.tolist())
    assert found == expected


def long_card(name, count, seed=0):
    """(kind, cents, limit) of one card with many rows."""
    rng, at = np.random.default_rng(seed), np.arange(count)
    if name == "always at the limit":
        return np.full(count, GUARDED), 700 + rng.integers(0, 9000, count), 500_000
    if name == "refunds keep pace":
        refund = at % 7 == 0
        return np.where(refund, BOOKED, GUARDED), np.where(refund, -30_000, rng.integers(1000, 10_000, count)), 500_000
    if name == "rare refunds":
        refund = rng.random(count) < 0.002
        return np.where(refund, BOOKED, GUARDED), np.where(refund, -200_000, rng.integers(100, 5000, count)), 500_000
    if name == "credits that are declined":
        return np.full(count, GUARDED), rng.integers(-5000, 5000, count), -20_000
    kind = rng.choice([BLOCKED, BOOKED, GUARDED], count, p=[0.1, 0.1, 0.8])
    return kind, rng.integers(-2000, 9000, count), 500_000


LONG = ["always at the limit", "refunds keep pace", "rare refunds", "credits that are declined", "all kinds"]


@pytest.mark.parametrize("name", LONG)
@pytest.mark.parametrize("near, stretch, block", [(48, 512, 64), (0, 1, 64), (3, 5, 2), (10**9, 40, 64)])
def test_runs_equal_the_walk_row_by_row(monkeypatch, name, near, stretch, block):
    for name_of, value in (("NEAR", near), ("STRETCH", stretch), ("BLOCK", block), ("SHORT", 0)):
        monkeypatch.setattr(ledger, name_of, value)
    for count in (1, 63, 64, 65, 3000):
        kind, cents, limit = long_card(name, count)
        balance, expected = 100, []
        for what, amount in zip(kind.tolist(), cents.tolist()):
            approved, balance = bank.step(balance, what, amount, limit)
            expected.append((approved, balance))
        booked = 100 + np.cumsum(np.where(kind >= BOOKED, cents, 0))
        for batch in (count, 1000):
            shift, found = 0, []
            for at in range(0, count, batch):
                part = slice(at, at + batch)
                starts = np.arange(count)[part] == 0
                approved, after, shift = settle(
                    starts, kind[part], cents[part], booked[part], np.full(count, limit)[part], shift
                )
                found += zip(approved.tolist(), after.tolist())
            assert found == expected


def wild(seed, count, hot=0):
    """Random rows on 12 cards; a share of `hot` of them on card 1."""
    random.seed(seed)
    out = []
    for number in range(count):
        kind = random.choices(["purchase", "wire_transfer", "refund", "cancellation"], [8, 2, 2, 1])[0]
        amount = round(random.choice([1, 1, 1, -1]) * random.expovariate(1 / 60), 2)
        if kind == "refund":
            amount = -3 * abs(amount)
        place = random.choices([bank.NEAR, bank.FAR, "Online"], [8, 1, 1])[0]
        card = 1 if random.random() < hot else random.randint(1, 12)
        out.append((number, card, amount, kind, place, random.randint(0, count // 4)))
    return out


@pytest.mark.parametrize("seed, heavy_rows", [(1, None), (2, 10), (3, 60)])
def test_random_cards_equal_the_rules_in_plain_python(spark, rows, seed, heavy_rows):
    """Also with card 1 holding more than a third of all rows and cut into segments."""
    made = wild(seed, 600, hot=1 / 3)
    limits = {card: 200.0 + 100 * card for card in range(1, 13)}
    judged = authorize(
        bank.transactions(spark, *made),
        bank.cards(spark, *[(card, 10, limit, 50.0) for card, limit in limits.items()]),
        bank.customers(spark, (10, bank.HOME)),
        heavy_rows=heavy_rows,
    )
    expected = []
    for card, limit in limits.items():
        own = sorted((r for r in made if r[1] == card), key=lambda r: (r[5], r[0]))
        results = bank.authorise([r[2:5] for r in own], limit, 50.0, bank.HOME)
        expected += [(r[0], *result) for r, result in zip(own, results)]
    found = rows(judged, "transaction_id", "status", "pending_balance")
    assert sorted(found) == sorted(expected)


def test_join_and_ledger_share_one_exchange(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        judged = authorize(*unknown(spark), heavy_rows=None, columns=["transaction_id", "amount"])
        plan = judged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert judged.columns == ["transaction_id", "amount", "status", "pending_balance"]
    # One for the transactions, one for the cards.
    assert plan.count("Exchange hashpartitioning(card_id") == 2
    # What nobody asks for is not carried along.
    assert "merchant_name" not in plan.split("Exchange hashpartitioning(card_id")[0]


def test_microseconds_decide_the_order(spark, rows):
    made = bank.transactions(spark, (1, 1, 400.0), (2, 1, 350.0))
    same = bank.NOON + datetime.timedelta(seconds=1)
    times = {1: same + datetime.timedelta(microseconds=2), 2: same + datetime.timedelta(microseconds=1)}
    changed = spark.createDataFrame(
        [row.asDict() | {"timestamp": times[row["transaction_id"]]} for row in made.collect()],
        made.schema,
    )
    judged = authorize(
        changed, bank.cards(spark, (1, 10, 801.0, 100.0)), bank.customers(spark, (10, bank.HOME))
    )
    assert rows(judged, "transaction_id", "status") == [(1, "declined"), (2, "pending")]


def _judged(spark, rows, transactions, card):
    cards, customers = bank.cards(spark, card), bank.customers(spark, (10, bank.HOME))
    judged = authorize(bank.transactions(spark, *transactions), cards, customers, reasons=True)
    return rows(judged, "transaction_id", "status", "pending_balance", "decline_reason")


def test_very_large_amounts_are_amounts_like_others(spark, rows):
    assert _judged(spark, rows, [(1, 1, 5.0)], (1, 10, 1e13, 0.0)) == [(1, "pending", 5.0, None)]
    over = "Total balance 20000000000005.0 exceeds credit limit 1000.0"
    assert _judged(spark, rows, [(1, 1, 5.0)], (1, 10, 1000.0, 2e13)) == [(1, "declined", 2e13, over)]
    refund = [(1, 1, -2e13, "refund"), (2, 1, 5.0)]
    assert _judged(spark, rows, refund, (1, 10, 1000.0, 100.0)) == [
        (1, "pending", 100.0 - 2e13, None), (2, "pending", 105.0 - 2e13, None),
    ]


@pytest.mark.parametrize("card", [(1, 10, float("nan"), 1.0), (1, 10, 1.0, float("nan")), (1, 10, 1e17, 1.0)])
def test_no_number_of_cents_stops_the_job(spark, rows, card):
    with pytest.raises(Exception, match="not a number of cents"):
        _judged(spark, rows, [(1, 1, 5.0)], card)


def test_unknown_limits_and_balances_are_never_zero(spark, rows):
    assert _judged(spark, rows, [(1, 1, -5.0, "refund"), (2, 1, 1.0)], (1, 10, None, 7.0)) == [
        (n, "declined", None, "Credit limit of card ID 1 unknown") for n in (1, 2)
    ]
    assert _judged(spark, rows, [(1, 1, -5.0, "refund")], (1, 10, 10.0, None)) == [
        (1, "declined", None, "Balance of card ID 1 unknown")
    ]


@pytest.mark.parametrize("heavy_rows", [5_000_000, 2])
def test_numbers_beyond_four_bytes(spark, rows, heavy_rows):
    card, first = 3_000_000_000, 4_000_000_000
    made = bank.transactions(spark, *[(first + n, card, 300.0, "purchase", bank.NEAR, n) for n in range(6)])
    cards, customers = bank.cards(spark, (card, 10, 1000.0, 0.0)), bank.customers(spark, (10, bank.HOME))
    found = rows(
        authorize(made, cards, customers, heavy_rows=heavy_rows), "transaction_id", "card_id", "status"
    )
    assert found == [(first + n, card, "pending" if n < 3 else "declined") for n in range(6)]


def test_parts_of_a_cent_are_declined(spark):
    """No amount becomes another one: a hundred purchases of 0.004 leave the balance alone, and say why."""
    tiny = [(n, 1, 0.004) for n in range(100)]
    made = bank.transactions(spark, *tiny, (100, 1, 0.3), (101, 1, -0.001, "refund"), (102, 1, 0.1 + 0.2))
    cards, customers = bank.cards(spark, (1, 10, 1000.0, 100.0)), bank.customers(spark, (10, bank.HOME))
    judged = authorize(made, cards, customers, reasons=True).orderBy("transaction_id")
    found = list(map(tuple, judged.select("transaction_id", "status", "pending_balance", "decline_reason").collect()))
    assert found == [
        *[(n, "declined", 100.0, "Amount 0.004 is finer than a cent") for n in range(100)], (100, "pending", 100.3, None),
        (101, "declined", 100.3, "Amount -0.001 is finer than a cent"), (102, "pending", 100.6, None),
    ]
