"""URL filter by the ratio of two character language models.

URLs which a rule decides teach two smoothed variable-order Markov models of characters, one of accepted and one
of rejected URLs. All others are judged by the difference of the log-likelihoods under both per character, against a
threshold calibrated on decided URLs that taught nothing (a fold of about a fifth, by a hash of the URL).

The models read what rules do not look at. A URL loses its scheme, the last labels of its host that are labels of
any rule's host, and the beginning of its path if any rule has it; else the models would learn the rules, and judge all
other URLs of a domain alike.

Characters are mapped to `SYMBOLS` = 32 classes, so a model of order 3 has at most 32^4 entries whatever the
input and may be broadcast; the counts in it come from all decided URLs. A model gives, per context of three symbols and next symbol,
the probability by the longest context that was seen at least `least` times, smoothed with the next shorter one:
(n(context, x) + strength * p(x | shorter)) / (n(context) + strength). Differences are stored as whole millionths, so
sums and thresholds do not depend on the order of addition.

Defined results
* A null URL, or one without `://`, has an empty host and path and fits no rule.
* A URL of which nothing is left to read has the difference 0. With no accepted or no rejected URL to calibrate on, the
  threshold is the least possible, and what no rule decides is allowed.
* Repeated rows, null ids and other columns are judged like others; an empty table gives an empty result.
"""

import re

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallycard.llm.tables import kept

SYMBOLS = 32
ORDER = 3
MICRO = 1_000_000
# Bins of the calibration, in millionths of a nat per character.
BIN = 10_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Symbols 1 to 31: letters, `0` for digits, `~` for all that is not listed.
ALPHABET = _LOWER + "0./-~"

_RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)


def host(url):
    """From behind the first `://` up to `/`, `?`, `#` or the end, A-Z in lower case; empty without `://`."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, _UPPER, _LOWER), F.lit(""))


def path(url):
    """What follows the host up to `?`, `#` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def ruled(pages, rules=_RULES):
    """Adds host, path, rule and rule_verdict of the longest rule that fits, else null, and `said`, what the models read."""
    parts = pages.select("*", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, at, begin in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((F.col("host") == at) | F.endswith("host", F.lit("." + at))) & F.startswith(
            "path", F.lit(begin)
        )
        rule = F.when(fits, at + begin).otherwise(rule)
        verdict = F.when(fits, decision).otherwise(verdict)
    return parts.select("*", rule.alias("rule"), verdict.alias("rule_verdict"), _said(rules).alias("said"))


def _said(rules):
    """The URL without what rules look at: the last labels of hosts, and beginnings of paths."""
    labels = "|".join(sorted({re.escape(label) for _, at, _ in rules for label in at.split(".")}))
    begins = "|".join(sorted({re.escape(begin) for _, _, begin in rules if begin != "/"}))
    rest = F.regexp_extract("url", r"(?s)^.*?://[^/?#]*[^?#]*(.*)$", 1)
    left = F.regexp_replace("host", rf"(^|\.)({labels})(\.({labels}))*$", "") if labels else F.col("host")
    after = F.regexp_replace("path", f"^({begins})", "/") if begins else F.col("path")
    whole = F.coalesce("url", F.lit(""))
    return F.when(F.contains(whole, F.lit("://")), F.concat(left, after, rest)).otherwise(whole)


def held_out():
    """Whether a decided URL is for the calibration and teaches nothing: three of sixteen."""
    return F.substring(F.md5(F.coalesce("url", F.lit(""))), 1, 1).isin("0", "1", "2")


def symbols(url):
    """Array of symbol numbers, by their place in `ALPHABET`; 0 is kept for what is before a URL."""
    plain = F.translate(F.coalesce(url, F.lit("")), _UPPER + "123456789", _LOWER + "000000000")
    plain = F.regexp_replace(plain, "[^a-z0./-]", "~")
    chars = F.filter(F.split(plain, ""), lambda char: char != "")
    return F.transform(chars, lambda char: F.call_function("locate", char, F.lit(ALPHABET)))


def grams(numbers):
    """Array with each symbol and the ORDER ones before it, as a number in base SYMBOLS.

    `numbers` has to be a column of its own, as each element reads several of it.
    """

    def gram(symbol, at):
        code = symbol
        for back in range(1, ORDER + 1):
            before = F.when(at >= back, F.get(numbers, at - back)).otherwise(0)
            code = code + before * SYMBOLS**back
        return code

    return F.transform(numbers, gram)


def counted(parts):
    """One row for each gram of any URL: gram, and how often accepted and rejected URLs have it.

    At most SYMBOLS ** (ORDER + 1) rows.
    """
    taught = F.when(~held_out(), F.col("rule_verdict"))
    read = parts.select(taught.alias("taught"), symbols(F.col("said")).alias("numbers"))
    found = read.select("taught", F.explode(grams(F.col("numbers"))).alias("gram"))
    verdict = F.coalesce("taught", F.lit(""))
    return found.groupBy("gram").agg(
        F.count_if(verdict == "allow").alias("accepted"),
        F.count_if(verdict == "block").alias("rejected"),
    )


def model(counts, least=4, strength=8.0):
    """The grams with `ratio`: log-likelihood of accepted less that of rejected URLs, in millionths."""
    shorter = {"accepted": F.lit(1.0 / SYMBOLS), "rejected": F.lit(1.0 / SYMBOLS)}
    table = counts.select("gram")
    for order in range(ORDER + 1):
        event, context = F.col("gram") % SYMBOLS ** (order + 1), F.col("event").cast("long")
        context = ((context - context % SYMBOLS) / SYMBOLS).cast("long")
        events = counts.groupBy(event.alias("event")).agg(
            *[F.sum(side).alias(f"{side}_n") for side in shorter]
        )
        totals = events.groupBy(context.alias("context")).agg(
            *[F.sum(f"{side}_n").alias(f"{side}_all") for side in shorter]
        )
        table = table.withColumn("event", event).withColumn("context", context)
        table = table.join(events, "event").join(totals, "context")
        for side, before in shorter.items():
            longer = (F.col(f"{side}_n") + strength * before) / (F.col(f"{side}_all") + strength)
            seen = F.col(f"{side}_all") >= least
            table = table.withColumn(f"{side}_{order}", F.when(seen, longer).otherwise(before))
        shorter = {side: F.col(f"{side}_{order}") for side in shorter}
        table = table.select("gram", *[column.alias(side) for side, column in shorter.items()])
        shorter = {side: F.col(side) for side in shorter}
    ratio = F.round(MICRO * (F.ln("accepted") - F.ln("rejected")))
    return table.select("gram", ratio.cast("long").alias("ratio"))


def scored(parts, ratios):
    """Adds `difference`: millionths of a nat per character, rounded down; 0 where there is nothing to read.

    Rows that are equal in all columns are summed up together, which changes neither the mean nor, as they are
    counted, their number. The model is broadcast: its size has a bound.
    """
    names = parts.columns
    read = parts.select("*", symbols(F.col("said")).alias("numbers"))
    found = read.select(*names, F.explode_outer(grams(F.col("numbers"))).alias("gram"))
    summed = (
        found.join(F.broadcast(ratios), "gram", "left")
        .groupBy(*names)
        .agg(
            F.sum("ratio").alias("total"), F.count("gram").alias("n"), F.count(F.lit(1)).alias("rows")
        )
    )
    mean = ((F.col("total") - F.pmod("total", "n")) / F.col("n")).cast("long")
    length = F.greatest(F.size(symbols(F.col("said"))), F.lit(1))
    return (
        summed.withColumn("difference", F.when(F.col("n") > 0, mean).otherwise(0).cast("long"))
        .withColumn("copy", F.explode(F.sequence(F.lit(1), (F.col("rows") / length).cast("int"))))
        .select(*names, "difference")
    )


def threshold(decided):
    """One row with the bin edge that errs least, in shares of the accepted plus of the rejected URLs."""
    half = 2000
    place = F.greatest(F.least(F.floor(F.col("difference") / BIN), F.lit(half)), F.lit(-half))
    bins = decided.groupBy(place.cast("bigint").alias("bin")).agg(
        F.count_if(F.col("rule_verdict") == "allow").cast("decimal(19,0)").alias("accepted"),
        F.count_if(F.col("rule_verdict") == "block").cast("decimal(19,0)").alias("rejected"),
    )
    # At most 2 * half + 1 rows.
    below = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    everywhere = Window.partitionBy(F.lit(0))
    errors = bins.select(
        "bin",
        F.coalesce(F.sum("accepted").over(below), F.lit(0)).alias("lost"),
        F.coalesce(F.sum("rejected").over(below), F.lit(0)).alias("caught"),
        F.sum("accepted").over(everywhere).alias("good"),
        F.sum("rejected").over(everywhere).alias("bad"),
    ).select(
        "bin", "good", "bad",
        (F.col("lost").cast("double") / F.col("good").cast("double")
         + (F.col("bad") - F.col("caught")).cast("double") / F.col("bad").cast("double")).alias("error"),
    )
    least = F.min_by(F.col("bin"), F.struct("error", "bin"))
    return errors.where((F.col("good") > 0) & (F.col("bad") > 0)).agg((least * BIN).alias("threshold"))


def judge(pages, rules=_RULES, least=4, strength=8.0):
    """page_id, host, path, rule, verdict, and the `difference` the method gives each URL."""
    parts = ruled(pages.select("page_id", "url"), rules)
    counts = kept(counted(parts), "url-counts")
    ratios = kept(model(counts, least, strength), "url-model")
    decided = parts.where(F.col("rule_verdict").isNotNull() & held_out()).select("said", "rule_verdict")
    bound = F.coalesce(threshold(scored(decided, ratios)).scalar(), F.lit(-(2**62)))
    by_model = F.when(F.col("difference") >= bound, "allow").otherwise("block")
    return scored(parts, ratios).select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("rule_verdict", by_model).alias("verdict"),
        "difference",
    )
