"""Quality rules: plain counts, and distribution divergence from a reference of the document's language.

The references come from all documents: for each language the shares of seven classes of characters, and the
shares of its `TOP_WORDS` most frequent words and of all others. A document is compared with its language's by the
Jensen-Shannon distance (base 2, from 0 to 1), for classes and for words. It fails if a distance is above
its bound, where the text is long enough for the histogram to mean something.

The bound for words depends on the text's length: by chance alone, the squared distance of a text of n words from its own
language is about 6 / n, while a text in another language, or of no words at all, is no farther off than the share of the
common words allows (0.36 to 0.37 for a share of a quarter).

Only DataFrame functions are used. All counts are made within a document's row; the references are sums that
are reduced before the shuffle, so a language or source with most of the rows sends a few rows per task.

Defined results
* A null text is the empty text. A null language is the empty language, with a reference of its own.
* Repeated rows count as often as they come and are judged alike; empty tables give empty results.
* Words are cut at white space (space, tab to carriage return). Three-word windows are told apart by a 64-bit hash.
* A text below the minimum lengths, or whose language has no words in the table, has no distance (null) and does
  not fail by it.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallycard.llm.tables import kept, text_of

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
TOP_WORDS = 32
MIN_WORDS = 50
MIN_CHARS = 200
MAX_CHAR_DISTANCE = 0.30
MAX_WORD_DISTANCE = 0.43
# The squared distance that a text's subject and style may cause, and, over its number of words, chance.
WORD_SPREAD = 0.04
WORD_NOISE = 8.0
# References are broadcast up to this number of languages; beyond it the join is Spark's choice.
BROADCAST_LANGUAGES = 2_000

CLASSES = ("lower", "upper", "digit", "space", "stop", "symbol", "other")
_LONG = "bigint"


def _chars(column):
    return F.char_length(column).cast(_LONG)


def words_of(text):
    spaced = F.translate(text, SPACES, " " * len(SPACES))
    return F.array_remove(F.split(spaced, " "), "")


def with_classes(rows):
    """Adds `classes`: numbers of the characters of `text` in each of CLASSES; `other` has the letters beyond ASCII.

    Each step works on what the one before has left over, which is short, and is a column, as two steps read it.
    """
    steps = {
        "lower": F.regexp_replace("text", "[a-z]+", ""),
        "space": F.translate("_lower", SPACES, ""),
        "stop": F.translate("_space", ".,;:!?'\"()-", ""),
        "upper": F.regexp_replace("_stop", "[A-Z]+", ""),
        "digit": F.translate("_upper", "0123456789", ""),
        "symbol": F.translate("_digit", SYMBOLS, ""),
    }
    before, counts = "text", {}
    for name, left in steps.items():
        rows = rows.withColumn(f"_{name}", left)
        counts[name] = _chars(F.col(before)) - _chars(F.col(f"_{name}"))
        before = f"_{name}"
    counts["other"] = _chars(F.col(before))
    rows = rows.withColumn("classes", F.array(*[counts[name] for name in CLASSES]))
    return rows.drop(*[f"_{name}" for name in steps])


def _language(name="lang"):
    return F.coalesce(F.col(name), F.lit(""))


def references(docs):
    """One row per language: lang, class_shares, top_words, top_shares (one more than words, for all others), and
    top_length, the length of the longest of top_words."""
    texts = docs.select(_language().alias("lang"), text_of().alias("text"))
    classes = with_classes(texts).groupBy("lang").agg(
        *[F.sum(F.col("classes")[at]).alias(name) for at, name in enumerate(CLASSES)]
    )
    said = texts.select("lang", F.explode(words_of(F.col("text"))).alias("word"))
    counts = said.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))
    counts = kept(counts, "quality-words")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("all_words"))
    frequent = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    top = (
        counts.withColumn("place", F.row_number().over(frequent))
        .where(F.col("place") <= TOP_WORDS)
        .groupBy("lang")
        .agg(F.sort_array(F.collect_list(F.struct("place", "word", "n"))).alias("top"))
    )
    joined = classes.join(top, "lang", "left").join(totals, "lang", "left")
    ns = F.coalesce(F.col("top.n"), F.array().cast("array<bigint>"))
    rest = F.coalesce(F.col("all_words"), F.lit(0).cast(_LONG)) - _total(ns)
    counted = joined.select(
        "lang",
        F.array(*CLASSES).alias("class_shares"),
        F.coalesce(F.col("top.word"), F.array().cast("array<string>")).alias("top_words"),
        F.concat(ns, F.array(rest)).alias("top_shares"),
        F.coalesce(F.array_max(F.transform("top.word", lambda w: F.char_length(w))), F.lit(0)).alias("top_length"),
    )
    return with_shares(counted, "class_shares", "top_shares")


def _total(counts):
    return F.aggregate(counts, F.lit(0).cast(_LONG), lambda a, b: a + b)


def with_shares(rows, *names):
    """Columns of counts turned into their shares; null where all are 0."""
    rows = rows.withColumns({f"_{name}": _total(F.col(name)) for name in names})

    def shares(name):
        total = F.col(f"_{name}")
        return F.when(total > 0, F.transform(name, lambda n: n / total))

    return rows.withColumns({name: shares(name) for name in names}).drop(*[f"_{name}" for name in names])


def distance(ours, theirs):
    """Jensen-Shannon distance of two arrays of shares."""

    def part(share, mean):
        return F.when(share > 0, share * F.log2(share / mean)).otherwise(F.lit(0.0))

    def both(a, b):
        return part(a, (a + b) / 2) + part(b, (a + b) / 2)

    total = F.aggregate(F.zip_with(ours, theirs, both), F.lit(0.0), lambda a, b: a + b)
    # Null stays null; rounding may leave a little less than 0.
    return F.sqrt(F.when(total < 0, F.lit(0.0)).otherwise(total / 2))


def _measured(texts):
    """Adds the base counts to rows with `text` and `classes`. Values that several steps read are columns."""
    text, classes = F.col("text"), F.col("classes")
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(SPACES)) != "")
    rows = texts.select(
        "*",
        words_of(text).alias("words"),
        lines.alias("lines"),
        (_chars(text) - classes[CLASSES.index("space")]).alias("word_chars"),
        classes[CLASSES.index("symbol")].alias("n_symbols"),
    )
    # The hash of the window that begins at each word.
    window = F.when(
        F.size("words") >= 3,
        F.transform(
            F.sequence(F.lit(0), F.size("words") - 3),
            lambda at: F.xxhash64(F.get("words", at), F.get("words", at + 1), F.get("words", at + 2)),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    rows = rows.select(
        "*",
        F.size("words").cast(_LONG).alias("n_words"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast(_LONG).alias("n_dup_lines"),
        window.alias("windows"),
    ).drop("lines")
    placed = F.sort_array(F.transform("windows", lambda w, at: F.struct(w.alias("w"), at.alias("at"))))
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    none = F.array().cast("array<struct<w:bigint,at:int>>")
    rows = rows.select("*", F.when(repeats, placed).otherwise(none).alias("placed")).drop("windows")

    def again(entry, at):
        before = F.when(at > 0, F.get("placed", at - 1)["w"])
        return F.coalesce(entry["w"] == before, F.lit(False)) | F.coalesce(
            entry["w"] == F.get("placed", at + 1)["w"], F.lit(False)
        )

    covered = F.flatten(
        F.transform(F.filter("placed", again), lambda e: F.array(e["at"], e["at"] + 1, e["at"] + 2))
    )
    return rows.select(
        "*", F.size(F.array_distinct(covered)).cast(_LONG).alias("n_repeat_words")
    ).drop("placed")


def word_bound(n_words):
    """The greatest word distance of a text of so many words in its own language."""
    return F.least(F.lit(MAX_WORD_DISTANCE), F.sqrt(F.lit(WORD_SPREAD) + F.lit(WORD_NOISE) / F.greatest(n_words, F.lit(1))))


def judged(docs):
    """The columns of `docs` in `row`, and n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    char_distance, word_distance, kept."""
    found = kept(references(docs), "quality-references")
    if found.count() <= BROADCAST_LANGUAGES:
        found = F.broadcast(found)
    rows = docs.select(F.struct("*").alias("row"), _language().alias("lang"), text_of().alias("text"))
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    measured = _measured(with_classes(rows)).join(found, "lang", "left")
    # Only words as short as the frequent ones are looked up.
    short = F.filter("words", lambda w: F.char_length(w) <= F.col("top_length"))
    measured = measured.withColumn("short", short).drop("words")
    seen = F.transform("top_words", lambda w: F.size("short") - F.size(F.array_remove(F.col("short"), w)))
    counted = measured.select(
        "*",
        base_failed.alias("base_failed"),
        F.when(F.col("n_words") >= MIN_WORDS, seen.cast("array<bigint>")).alias("seen"),
        (F.char_length("text") >= MIN_CHARS).alias("long_enough"),
    ).drop("short", "text")
    counted = counted.withColumns(
        {
            "word_shares": F.concat("seen", F.array(F.col("n_words") - _total(F.col("seen")))),
            "shares": F.when(F.col("long_enough"), F.col("classes")),
        }
    )
    distances = with_shares(counted, "word_shares", "shares").withColumns(
        {
            "char_distance": F.round(distance(F.col("shares"), F.col("class_shares")), 4),
            "word_distance": F.round(distance(F.col("word_shares"), F.col("top_shares")), 4),
        }
    )
    diverges = F.coalesce(F.col("char_distance") > MAX_CHAR_DISTANCE, F.lit(False)) | F.coalesce(
        F.col("word_distance") > word_bound(F.col("n_words")), F.lit(False)
    )
    return distances.select(
        "row",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & ~diverges).alias("kept"),
        "char_distance",
        "word_distance",
    )


def good_documents(docs):
    """The rows of `docs` that the rules keep."""
    rows = judged(docs).select("row", "kept")
    # A filter would be pushed down to the text and evaluate all of the above anew, lambda by lambda.
    once = F.filter(F.array("row"), lambda _: F.col("kept"))
    return rows.select(F.explode(once).alias("row")).select("row.*")
