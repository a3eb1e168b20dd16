"""Cards cut into segments."""

import pytest
from pyspark.sql import functions as F

import bank
from tallycard import fixtures
from tallycard.operators import heavy
from tallycard.operators.authorize import authorize

from conftest import DATA


@pytest.fixture
def rounds(monkeypatch):
    """Segments walked per round."""
    counts, walk = [], heavy._walk

    def counted(found, rows, entries, number):
        counts.append(entries.count())
        return walk(found, rows, entries, number)

    monkeypatch.setattr(heavy, "_walk", counted)
    return counts


def one_card(spark, amount, kind="purchase", limit=5000.0, count=2000):
    """A card with `count` rows; amount and type are expressions of the row number `id`."""
    transactions = spark.range(count).select(
        F.col("id").cast("int").alias("transaction_id"),
        F.lit(1).alias("card_id"),
        F.lit("m").alias("merchant_name"),
        F.expr("timestamp_ntz '2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, id div 50)").alias(
            "timestamp"
        ),
        F.expr(f"CAST({amount} AS DOUBLE)").alias("amount"),
        F.lit(bank.NEAR).alias("location"),
        F.expr(kind if "'" in kind else f"'{kind}'").alias("transaction_type"),
        F.lit(None).cast("string").alias("related_transaction_id"),
    )
    return (
        transactions,
        bank.cards(spark, (1, 10, limit, 100.0)),
        bank.customers(spark, (10, bank.HOME)),
    )


@pytest.mark.parametrize("name, amount, kind, most", [
    ("never near the limit", "0.01", "purchase", 1),
    ("always at the limit", "7 + id % 90", "purchase", 3),
    ("refunds keep pace", "IF(id % 7 = 0, -300, 10 + id % 90)", "IF(id % 7 = 0, 'refund', 'purchase')", 8),
    ("up and down", "(hash(id) % 200000) / 100", "purchase", 20),
    ("above the limit", "IF(id = 3, 9000, 5)", "IF(id = 3, 'cancellation', 'purchase')", 1),
])
def test_split_card_equals_whole_card(spark, rows, rounds, name, amount, kind, most):
    tables = one_card(spark, amount, kind)
    whole = rows(authorize(*tables, heavy_rows=None))
    split = authorize(*tables, heavy_rows=200)
    assert "broadcast" in split._jdf.queryExecution().analyzed().toString()
    assert rows(split) == whole
    assert 1 <= len(rounds) <= most
    assert rounds[0] >= 10


def test_many_heavy_cards_are_joined_by_shuffle(spark, rows, monkeypatch):
    transactions, cards, customers = one_card(spark, "7 + id % 90", count=600)
    several = transactions.withColumn("card_id", F.expr("transaction_id % 4"))
    whole = rows(authorize(several, cards, customers, heavy_rows=None))
    monkeypatch.setattr(heavy, "BROADCAST_ROWS", 0)
    split = authorize(several, cards, customers, heavy_rows=50)
    assert "broadcast" not in split._jdf.queryExecution().analyzed().toString()
    assert rows(split) == whole


def test_no_heavy_cards_no_extra_work(spark, rounds):
    authorize(*one_card(spark, "1", count=100), heavy_rows=100)
    assert rounds == []
    assert heavy.find(one_card(spark, "1", count=100)[0], 100) is None


def test_heavy_cards_are_found_by_sample(spark, rows, monkeypatch):
    monkeypatch.setattr(heavy, "SAMPLE_ROWS", 100)
    transactions, *_ = one_card(spark, "1", count=20_000)
    cards = transactions.withColumn(
        "card_id", F.expr("IF(transaction_id % 3 = 0, 1, transaction_id)")
    )
    found = heavy.find(cards, 1000)
    assert rows(found.cards, "card_id") == [(1,)]
    assert 5 <= found.segments <= 9
    assert heavy.find(cards, 20_000) is None


def test_rows_of_one_instant_are_split_too(spark, rows):
    transactions, cards, customers = one_card(spark, "7 + id % 90", count=1000)
    transactions = transactions.withColumn("timestamp", F.lit(bank.NOON).cast("timestamp_ntz"))
    whole = rows(authorize(transactions, cards, customers, heavy_rows=None))
    assert rows(authorize(transactions, cards, customers, heavy_rows=100)) == whole
    found = heavy.find(transactions, 100)
    assert found.segments == 10


def test_heavy_card_without_account(spark, rows):
    transactions, cards, customers = one_card(spark, "1", count=300)
    transactions = transactions.withColumn(
        "card_id", F.expr("IF(transaction_id % 2 = 0, NULL, IF(transaction_id % 3 = 0, 9, 1))")
    )
    whole = rows(authorize(transactions, cards, customers, heavy_rows=None))
    assert rows(authorize(transactions, cards, customers, heavy_rows=20)) == whole
    assert len(whole) == 300


def test_heavy_cards_are_found_once_for_several_runs(spark, rows):
    tables = fixtures.Bank(spark, DATA)
    given = [tables[name] for name in ("transactions", "cards", "customers")]
    found = heavy.find(tables["transactions"], 12)
    assert found is not None and found.segments > 2
    expected = rows(authorize(*given, heavy_rows=None))
    assert rows(authorize(*given, found=found)) == expected
    assert rows(authorize(*given, found=found)) == expected


def test_rounds_read_open_segments_only(spark, rows, monkeypatch):
    tables = one_card(spark, "(hash(id) % 200000) / 100")
    seen, walk = [], heavy._walk

    def watched(found, rows, entries, number):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        seen.append((entries.select("segment").distinct().count(), "PartitionFilters: [isnotnull(segment" in plan or "PartitionFilters: [segment" in plan))
        return walk(found, rows, entries, number)

    whole = rows(authorize(*tables, heavy_rows=None))
    monkeypatch.setattr(heavy, "_walk", watched)
    assert rows(authorize(*tables, heavy_rows=100)) == whole
    assert len(seen) > 1 and not seen[0][1]
    assert all(pruned for _, pruned in seen[1:])
    assert sum(count for count, _ in seen[1:]) < seen[0][0] * (len(seen) - 1)


def test_short_segments_share_parts(spark, rows, folder, monkeypatch):
    transactions, _, customers = one_card(spark, "7 + id % 90", count=2000)
    several = transactions.withColumn("card_id", F.expr("transaction_id % 40"))
    cards = bank.cards(spark, *[(n, 10, 900.0, 100.0) for n in range(40)])
    for part_rows, most in ((heavy.PART_ROWS, 1), (100, 21)):
        monkeypatch.setattr(heavy, "PART_ROWS", part_rows)
        found = heavy.find(several, 14)
        assert found.segments == 143
        cut = found.cut(several, f"{folder}/{most}")
        assert cut.select(heavy.PART).distinct().count() <= most
        sizes = cut.groupBy("segment").count()
        assert 143 <= sizes.count() <= 143 + most
        assert sizes.agg(F.max("count")).first()[0] == 14
        in_order = cut.orderBy("card_id", "timestamp", "transaction_id").select("segment").collect()
        assert in_order == sorted(in_order)
    whole = rows(authorize(several, cards, customers, heavy_rows=None))
    assert rows(authorize(several, cards, customers, heavy_rows=14)) == whole


def test_chain_goes_on_over_batches():
    import pyarrow as pa

    walks = [
        # card, segment, entry, opening, exit, up, down
        (1, 0, 100, 100, 150, None, None),
        (1, 2, 150, 100, 400, 5, 5),
        (1, 5, 390, 100, 500, 9, None),  # 400 is too far from 390
        (1, 5, 399, 100, 450, 1, 0),
        (1, 7, 9, 100, 77, 0, 0),  # and so is 451 from 9
        (1, 9, 77, 100, 80, 0, 0),
        (2, 9, 2**60, 2**60, 2**60 + 1, 0, 0),
    ]
    schema = pa.schema([(name, pa.int64()) for name in heavy._WALKED])
    whole = pa.RecordBatch.from_pylist([dict(zip(heavy._WALKED, walk)) for walk in walks], schema=schema)
    expected = [
        (1, 0, 100, True), (1, 2, 150, True), (1, 5, 400, True), (1, 7, 451, False), (1, 9, 77, True), (2, 9, 2**60, True)
    ]
    for size in (1, 2, 3, 7):
        batches = [whole.slice(at, size) for at in range(0, len(walks), size)]
        out = [tuple(row.values()) for batch in heavy._following(batches) for row in batch.to_pylist()]
        assert out == expected
