"""ZIP codes of US addresses and the distance rule built on them."""

from pyspark.sql import functions as F

# What an address must end with, and the white space ignored after it.
ZIP_ENDING = r",\s[A-Z]{2}\s(\d{5})$"
WHITE_SPACE = " \t\n\r\f\x0b"

_ENDING_LENGTH = len(", NY 12345")


def zip_code(address):
    """The five digits closing an address, or empty text.

    The ending has a fixed length, so the regex only ever sees the last ten characters.
    """
    ending = F.substring(F.rtrim(address, F.lit(WHITE_SPACE)), -_ENDING_LENGTH, _ENDING_LENGTH)
    return F.coalesce(F.regexp_extract(ending, ZIP_ENDING, 1), F.lit(""))


def zips_close(one, other):
    """True when both ZIP codes are known and lie in the same first-digit region."""
    return (one != "") & (other != "") & (F.left(one, F.lit(1)) == F.left(other, F.lit(1)))
