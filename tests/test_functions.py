import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallycard import schemas
from tallycard.functions import bands, messages, money, places


def apply(spark, column, schema, values):
    """The column's value for each tuple of values, in order."""
    numbered = [(n, *value) for n, value in enumerate(values)]
    df = spark.createDataFrame(numbered, f"n int, {schema}").coalesce(1)
    return [row[0] for row in df.orderBy("n").select(column).collect()]


def check(spark, column, schema, cases):
    """Cases are tuples of values with the expected result as the last item."""
    found = apply(spark, column, schema, [case[:-1] for case in cases])
    assert found == [case[-1] for case in cases]


def test_cents(spark):
    check(spark, money.cents(F.col("a")), "a double", [
        (2.67, 267), (1.15, 115), (-0.29, -29), (1e7 + 0.07, 1000000007), (None, None),
        (1e13, 10**15), (-2e13, -2 * 10**15),
    ])


@pytest.mark.parametrize("odd", [float("nan"), float("inf"), 1e300, -1e17])
def test_what_is_no_number_of_cents_stops_the_job(spark, odd):
    with pytest.raises(Exception, match="not a number of cents"):
        apply(spark, money.cents(F.col("a")), "a double", [(1.0,), (odd,)])


def test_money_text_is_the_shortest_with_a_decimal(spark):
    cases = [
        (690000, "6900.0"), (123456, "1234.56"), (123450, "1234.5"), (-705, "-7.05"), (0, "0.0"),
        (1234567890123, "12345678901.23"),
    ]
    assert [text for _, text in cases] == [repr(whole / 100) for whole, _ in cases]
    check(spark, money.money_text(F.col("a")), "a bigint", cases)


def test_off_cent(spark):
    check(spark, money.off_cent(F.col("a")), "a double", [
        (1.23, False), (1.234, True), (0.005, True), (float("nan"), True), (None, False), (99.0, False), (1e300, True),
    ])


def test_zip_code(spark):
    check(spark, places.zip_code(F.col("a")), "a string", [
        ("4 Elm Rd, Delta, WA 31472", "31472"), ("Online", ""), (None, ""), ("", ""),
        ("4 Elm Rd, Delta, WA 31472 \t\n", "31472"), ("4 Elm Rd, Delta, wa 31472", ""),
        ("4 Elm Rd, Delta, WA 31472-1234", ""), (", WA 31472", "31472"), ("WA 31472", ""),
        ("4 Elm Rd, Delta,\tWA\t31472", "31472"), ("4 Elm Rd, Delta, WA 3147", ""),
        ("4 Elm Rd, Delta, WA 314720", ""), ("Delta,  WA 31472", ""), ("Delta, WAC 31472", ""),
    ])


def test_zips_close(spark):
    check(spark, places.zips_close(F.col("a"), F.col("b")), "a string, b string", [
        ("", "31472", False), ("31472", "", False), ("31472", "36905", True),
        ("31472", "81472", False), ("31472", "31472", True), ("", "", False),
    ])


def test_score_change(spark):
    check(spark, bands.score_change(F.col("a")), "a double", [
        (-3.0, 15), (10.0, 15), (10.01, 10), (20.0, 10), (20.5, 5), (30.0, 5), (30.1, -5),
        (50.0, -5), (50.1, -15), (70.0, -15), (70.1, -25), (500.0, -25), (None, None),
    ])


def test_revised_limit(spark):
    check(spark, bands.revised_limit(F.col("a"), F.col("b")), "a double, b int", [
        (8500.0, -15, 7600.0), (2500.0, -15, 2200.0), (6900.0, -5, 6600.0), (3000.0, -25, 2600.0),
        (3000.0, -20, 2600.0), (3000.0, -19, 2700.0), (3000.0, -10, 2700.0), (3000.0, -9, 2800.0),
        (1234.56, 0, 1234.56), (1234.56, 15, 1234.56),
    ])


def test_utilisation_without_a_limit_is_unknown(spark):
    column = bands.utilisation(F.col("a"), F.col("b"))
    check(spark, column, "a double, b double", [(5.0, 0.0, None), (5.0, 20.0, 25.0)])


def test_message_text_and_back(spark):
    times = [datetime.datetime(2024, 1, 5, 10, 11, 12), datetime.datetime(2024, 3, 10, 2, 30, 0, 500)]
    rows = [(n, 7, "m", when, 1.5, None, "purchase", None) for n, when in enumerate(times)]
    df = spark.createDataFrame(rows, schemas.TRANSACTIONS)
    texts = df.select(messages.as_message(df.schema).alias("value"))
    found = [row["value"] for row in texts.collect()]
    for text, when in zip(found, times):
        assert f'"timestamp":"{when.isoformat()}"' in text
        assert '"location":null' in text
    assert messages.decode(texts, schemas.TRANSACTIONS).collect() == df.collect()


def test_message_turns_decimals_into_numbers(spark):
    schema = T.StructType([T.StructField("amount", T.DecimalType(10, 2))])
    df = spark.sql("SELECT CAST(12.50 AS DECIMAL(10,2)) AS amount")
    assert df.select(messages.as_message(schema)).first()[0] == '{"amount":12.5}'
