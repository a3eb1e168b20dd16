import datetime
import glob

import pytest

import bank
from tallycard import fixtures, schemas
from tallycard.functions.messages import decode
from tallycard.operators import checks, days, serving
from tallycard.sources import jdbc, log
from tallycard.sources.files import ingest_csv, read_csv, write_csv
from tallycard.sources.publish import publish
from tallycard.sources.scratch import scratch_dir

from conftest import DATA

CARDS = [
    "card_id,customer_id,card_type_id,card_number,expiration_date,credit_limit,current_balance,issue_date",
    "71,40,3,9001-0071,03/31,2750.5,18.4,2021-11-02",
    "72,40,1,9001-0072,08/29,640,0.75,2020-02-29",
]


def _file(folder, lines, end="\r\n"):
    path = f"{folder}/table.csv"
    with open(path, "w", newline="") as out:
        out.write(end.join(lines) + end)
    return path


def test_csv_with_windows_line_ends(spark, folder):
    table = ingest_csv(spark, _file(folder, CARDS), schemas.CARDS, f"{folder}/cards")
    assert table.dtypes == spark.createDataFrame([], schemas.CARDS).dtypes
    assert [row["credit_limit"] for row in table.orderBy("card_id").collect()] == [2750.5, 640.0]
    assert table.orderBy("card_id").first()["issue_date"].year == 2021


def test_csv_columns_are_matched_by_name(spark, folder):
    path = _file(folder, [
        "email,customer_id,address,name,phone_number,annual_income,credit_score",
        'a@b,7,"4 Elm Rd, Delta, WA 31472",Ann,555,1.5,700',
    ])
    row = read_csv(spark, path, schemas.CUSTOMERS).first()
    assert (row["customer_id"], row["address"], row["credit_score"]) == (7, bank.HOME, 700)


@pytest.mark.parametrize("bad", ["x,1,1,c,11/27,1,1,2020-02-17", "3,1,1,c,11/27,much,1,2020-02-17"])
def test_bad_csv_row_loads_nothing(spark, folder, bad):
    path = _file(folder, CARDS + [bad])
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        ingest_csv(spark, path, schemas.CARDS, f"{folder}/cards")
    assert glob.glob(f"{folder}/cards/*.parquet") == []


def test_csv_header_must_match(spark, folder):
    path = _file(folder, [line.rsplit(",", 1)[0] for line in CARDS])
    with pytest.raises(ValueError, match="issue_date"):
        read_csv(spark, path, schemas.CARDS)


def test_csv_export_of_a_small_table_is_one_file(spark, folder, rows):
    cards = fixtures.cards(spark, DATA).repartition(4)
    write_csv(cards, f"{folder}/cards", single_file=True)
    assert len(glob.glob(f"{folder}/cards/*.csv")) == 1
    assert rows(read_csv(spark, f"{folder}/cards", schemas.CARDS)) == rows(cards)


def test_csv_keeps_microseconds_quotes_and_nulls(spark, folder, rows):
    odd = datetime.datetime(2024, 3, 10, 2, 30, 0, 120)
    made = [
        (1, 1, 'a "b", c', odd, 1.5, None, "purchase", "7"),
        (2, 1, "back\\slash", odd, None, "x", "refund", None),
    ]
    table = spark.createDataFrame(made, schemas.TRANSACTIONS)
    write_csv(table, f"{folder}/t")
    assert rows(read_csv(spark, f"{folder}/t", schemas.TRANSACTIONS)) == rows(table)


def test_csv_with_doubled_quotes(spark, folder):
    header = ",".join(schemas.TRANSACTIONS.names)
    line = '1,1,"Joe ""the"" Shop, Inc",2024-01-05T10:11:12,1,x,purchase,'
    found = read_csv(spark, _file(folder, [header, line]), schemas.TRANSACTIONS).first()
    assert found["merchant_name"] == 'Joe "the" Shop, Inc'


def test_csv_reads_iso_and_plain_timestamps(spark, folder):
    header = ",".join(schemas.TRANSACTIONS.names)
    path = _file(folder, [
        header, "1,1,m,2024-01-05T10:11:12,1,x,purchase,", "2,1,m,2024-01-05 10:11:12.5,1,x,purchase,9",
    ])
    found = read_csv(spark, path, schemas.TRANSACTIONS).orderBy("transaction_id").collect()
    assert found[0]["timestamp"] == datetime.datetime(2024, 1, 5, 10, 11, 12)
    assert found[1]["timestamp"] == datetime.datetime(2024, 1, 5, 10, 11, 12, 500000)
    assert [row["related_transaction_id"] for row in found] == [None, "9"]


def test_database_options():
    database = jdbc.Database("jdbc:mysql://host/bank", "com.mysql.cj.jdbc.Driver", "me", "secret")
    assert "secret" not in repr(database)
    assert database.options()["url"] == "jdbc:mysql://host/bank"
    assert "url" not in database.properties()
    assert jdbc.split_options("card_id", 1, 900, 8) == {
        "partitionColumn": "card_id", "lowerBound": "1", "upperBound": "900", "numPartitions": "8",
    }
    assert jdbc.split_options("card_id", 1, 900, 1) == {}


def test_day_query_is_a_range():
    assert jdbc.day_query("transactions", datetime.date(2024, 2, 28), datetime.date(2024, 2, 29)) == (
        "(SELECT * FROM transactions WHERE timestamp >= '2024-02-28 00:00:00' "
        "AND timestamp < '2024-03-01 00:00:00') AS day_rows"
    )


def test_log_messages_are_keyed_by_card(spark, rows):
    table = fixtures.transactions(spark, DATA)
    sent = log.to_messages(table)
    assert sent.columns == ["key", "value"]
    assert sent.where("key <> get_json_object(value, '$.card_id')").isEmpty()
    # A consumer gets bytes.
    received = sent.selectExpr("CAST(value AS BINARY) AS value")
    assert rows(log.from_messages(received)) == rows(table)


def test_broken_message_stops_the_reader(spark):
    broken = spark.createDataFrame([('{"transaction_id": "x"}',)], "value string")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        decode(broken, schemas.TRANSACTIONS).collect()


def test_published_table_may_depend_on_itself(spark, rows):
    publish(spark.range(3).selectExpr("id", "id * 10 AS v"), "served")
    publish(spark.table("served").selectExpr("id", "v + 1 AS v"), "served")
    assert rows(spark.table("served")) == [(0, 1), (1, 11), (2, 21)]
    publish(spark.table("served"), "served")
    publish(spark.range(1), "served_v")
    versions = [t.name for t in spark.catalog.listTables() if t.name.startswith("served_v0")]
    assert len(versions) == 2 and rows(spark.table("served")) == [(0, 1), (1, 11), (2, 21)]


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "local-cluster[2,1,1024]", None])
def test_only_a_local_master_may_go_without_a_shared_folder(master):
    class Session:
        class conf:
            @staticmethod
            def get(name, default=None):
                return master if name == "spark.master" and master else default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(Session, "x")


def test_scratch_lies_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    one, other = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert one.startswith(f"{shared}/x-") and one != other


def test_day_filter_reaches_the_file_reader(spark):
    rows = days.transactions_by_date(fixtures.transactions(spark, DATA), datetime.date(1997, 6, 18))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan


def test_keys(spark, rows):
    table = bank.cards(spark, (1, 1, 1.0, 1.0), (1, 1, 1.0, 1.0), (None, 1, 1.0, 1.0), (2, 1, 1.0, 1.0))
    assert rows(checks.key_violations(table, "card_id")) == [(1, 2), (None, 1)]
    assert rows(checks.primary_key_check({"cards": table})) == [("cards", 4, 1, 1)]
    empty = bank.cards(spark).where("false")
    assert rows(checks.primary_key_check({"cards": empty})) == [("cards", 0, 0, 0)]


def test_off_cent_amounts(spark, rows):
    table = bank.transactions(spark, (1, 1, 1.005), (2, 1, 1.0), (3, 1, None))
    assert rows(checks.off_cent_amounts(table), "transaction_id") == [(1,)]


def test_previews(spark):
    tables = serving.preview_all({"cards": fixtures.cards(spark, DATA)}, rows=3)
    found = [row["card_id"] for row in tables["cards"].collect()]
    assert found == sorted(found) and len(found) == 3
