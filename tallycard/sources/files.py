"""CSV and parquet tables."""

from pyspark.sql import types as T

from tallycard.operators.days import DAY, with_day

# Quotes inside a field are doubled, as spreadsheets and most CSV writers do.
_READ = {"header": "true", "quote": '"', "escape": '"'}
SINGLE_FILE_ROWS = 5_000_000
CSV_DIALECT = _READ | {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def read_csv(spark, path, schema):
    """A CSV table with header and declared types.

    Columns are matched by header name in any order; a value that does not fit its type fails the
    read, as does a missing column. An empty field is NULL.
    """
    header = spark.read.options(**_READ).csv(path).columns
    unknown = set(schema.names) ^ set(header)
    if unknown:
        raise ValueError(f"{path}: header and schema differ in {sorted(unknown)}")
    ordered = T.StructType([schema[name] for name in header])
    rows = (
        spark.read.schema(ordered)
        .options(**_READ)
        .option("mode", "FAILFAST")
        .option("enforceSchema", False)
        .csv(path)
    )
    return rows.select(*schema.names)


def ingest_csv(spark, csv_path, schema, table_path, by_day=False):
    """Load a CSV file into a parquet table: all of it, or, where a row is bad, nothing.

    `by_day` stores transactions in a folder for each day, so that readers of some days read no other. Rows are dealt by day
    first, with large days over several tasks, so a day has few files.
    """
    rows = read_csv(spark, csv_path, schema)
    if not by_day:
        return write_table(rows, table_path)
    return write_table(with_day(rows).hint("rebalance", DAY), table_path, [DAY])


def write_csv(df, path, single_file=False):
    """Export as CSV with header.

    `single_file` writes in one task, so it takes tables up to SINGLE_FILE_ROWS rows only.
    """
    if single_file and df.limit(SINGLE_FILE_ROWS + 1).count() > SINGLE_FILE_ROWS:
        raise ValueError(f"more than {SINGLE_FILE_ROWS} rows do not go into a single file")
    out = df.coalesce(1) if single_file else df
    out.write.mode("errorifexists").options(**CSV_DIALECT).csv(path)


def write_table(df, path, partition_by=()):
    df.write.mode("errorifexists").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
