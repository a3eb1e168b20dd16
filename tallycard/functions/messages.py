"""JSON form of a transaction message: numbers as numbers, timestamps as ISO-8601 text."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

_WITH_MICROS = len("2024-01-05T10:11:12.000000")


def _iso(name):
    """ISO-8601 text; six digits of fraction where there is one. No time zone is involved."""
    text = F.replace(F.col(name).cast("string"), F.lit(" "), F.lit("T"))
    return F.when(text.contains("."), F.rpad(text, _WITH_MICROS, "0")).otherwise(text)


def as_message(schema):
    """Column with a row of this schema as JSON; a NULL field is written as null."""
    fields = []
    for field in schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            column = _iso(field.name)
        elif isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        fields.append(column.alias(field.name))
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


_BROKEN = "_broken"


def decode_with_broken(messages, schema, column="value"):
    """Typed columns, and next to them `broken`: the text of a message that does not fit the schema, else NULL.

    What is no JSON object, a missing message, and a value of a wrong type are broken. Fields that are missing are NULL.
    """
    text = F.col(column).cast("string")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN}
    parsed = F.from_json(text, T.StructType([*schema.fields, T.StructField(_BROKEN, T.StringType())]), options)
    # A text that is no object at all may come back as a row of NULL.
    is_object = F.coalesce(F.ltrim(text).startswith("{"), F.lit(False))
    fits = F.col("message").isNotNull() & F.col(f"message.{_BROKEN}").isNull() & F.col("is_object")
    read = messages.select(text.alias("text"), is_object.alias("is_object"), parsed.alias("message"))
    return read.select(
        *[F.col(f"message.{name}").alias(name) for name in schema.names],
        F.when(~fits, F.coalesce("text", F.lit(""))).alias("broken"),
    )


def decode(messages, schema, column="value"):
    """Typed columns back from a JSON text (or bytes) column."""
    parsed = F.from_json(F.col(column).cast("string"), schema, {"mode": "FAILFAST"})
    return messages.select(parsed.alias("message")).select("message.*")
