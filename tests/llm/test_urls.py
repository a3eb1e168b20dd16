import math
from collections import Counter

from pyspark.sql import functions as F

from tallycard.llm import urls
from tallycard.llm.tables import table

from conftest import DATA

SCHEMA = "page_id long, url string, html string, gram int, total int, rule string"


def made(spark, values):
    return spark.createDataFrame([(n, url, "h", 1, 2, "clash") for n, url in enumerate(values)], SCHEMA)


def test_hosts_paths_and_rules(spark):
    cases = [
        (None, "", "", None), ("", "", "", None), ("no scheme/net/", "", "", None), ("HTTP://A.NET/x?y", "a.net", "/x", "net/"),
        ("x://Example.NET/en/1#/de/", "example.net", "/en/1", "example.net/en/"),
        ("x://b.example.net/de/", "b.example.net", "/de/", "net/"), ("x://notexample.net/en/", "notexample.net", "/en/", "net/"),
        ("x://example.com/de/a://b", "example.com", "/de/a://b", "example.com/de/"), ("x://a.net", "a.net", "", None),
        ("x://net?/", "net", "", None), ("x://org/fr/", "org", "/fr/", "org/fr/"), ("x://a.org/FR/", "a.org", "/FR/", None),
        ("x://\n/fr/", "\n", "/fr/", None),
    ]
    found = urls.judge(made(spark, [case[0] for case in cases])).orderBy("page_id").collect()
    assert [tuple(row)[1:4] for row in found] == [case[1:] for case in cases]
    verdicts = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
    assert all(row["verdict"] == verdicts[row["rule"]] for row in found if row["rule"])


def brute(rows, least=4, strength=8.0):
    """difference per text, from (text, the verdict that it teaches)."""
    letters = urls.ALPHABET

    def symbols(url):
        out = []
        for char in url or "":
            char = char.lower() if char.isascii() else "~"
            char = "0" if char.isdigit() else char
            out.append(letters.find(char) + 1 or 31)
        return out

    def contexts(url):
        numbers = [0] * 3 + symbols(url)
        return [tuple(numbers[at - 3 : at + 1]) for at in range(3, len(numbers))]

    counts = {side: Counter() for side in ("allow", "block")}
    for url, decided in rows:
        if decided:
            for gram in contexts(url):
                for order in range(4):
                    counts[decided][gram[3 - order :]] += 1
                    counts[decided][gram[3 - order : 3], "all"] += 1

    def p(side, gram):
        value = 1.0 / 32
        for order in range(4):
            event, context = gram[3 - order :], (gram[3 - order : 3], "all")
            if counts[side][context] >= least:
                value = (counts[side][event] + strength * value) / (counts[side][context] + strength)
        return value

    def difference(url):
        grams = contexts(url)
        ratios = [round(1e6 * (math.log(p("allow", g)) - math.log(p("block", g)))) for g in grams]
        return sum(ratios) // len(grams) if grams else 0

    return difference


def said(url):
    """What the models read of a URL, for the rules' hosts and paths."""
    if "://" not in (url or ""):
        return url or ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(mark) for mark in "/?#" if mark in rest] or [len(rest)])
    host, rest = rest[:cut].translate({code: code + 32 for code in range(65, 91)}), rest[cut:]
    labels = host.split(".")
    while labels and labels[-1] in ("net", "example", "com", "org"):
        labels.pop()
    for begin in ("/en/", "/de/", "/fr/"):
        if rest.startswith(begin):
            rest = rest[len(begin) - 1 :]
            break
    return ".".join(labels) + rest


def test_differences_equal_brute_force(spark):
    pages = table(spark, DATA, "pages").limit(60)
    values = [row["url"] for row in pages.collect()] + [
        None, "", "x://ÄÖ.example/Ü?1", "x://ÄÖ.example/Ü?1", "no scheme", "x://example.com", "x://org.spam.example.org/en/?a://b",
    ]
    parts = urls.ruled(made(spark, values).select("page_id", "url"))
    rows = parts.withColumn("held_out", urls.held_out()).collect()
    assert [row["said"] for row in rows] == [said(row["url"]) for row in rows]
    taught = [(row["said"], None if row["held_out"] else row["rule_verdict"]) for row in rows]
    assert any(row["held_out"] and row["rule_verdict"] for row in rows)
    difference = brute(taught)
    found = urls.judge(made(spark, values)).collect()
    assert len(found) == len(values)
    for row in found:
        assert abs(row["difference"] - difference(said(values[row["page_id"]]))) <= 1


def test_the_domain_does_not_decide(spark):
    """Accepted URLs are about gardens and rejected ones about casinos; URLs that no rule decides are judged by that."""
    words = {"org/fr": ["garden-rose", "tulip", "botany"], "net/de": ["casino-win", "jackpot", "poker"]}
    values = []
    for place, kinds in words.items():
        end, begin = place.split("/")
        values += [f"https://a.{kind}.example.{end}/{begin}/{kind}/{n}.html" for n in range(40) for kind in kinds]
    undecided = [f"https://a.{kind}.example.com/en/{kind}/7.html" for kinds in words.values() for kind in kinds]
    found = urls.judge(made(spark, values + undecided)).orderBy("page_id").collect()[len(values) :]
    assert [row["verdict"] for row in found] == ["allow"] * 3 + ["block"] * 3
    assert all(row["rule"] is None for row in found)


def test_without_both_kinds_of_urls_all_others_are_allowed(spark):
    found = urls.judge(made(spark, ["x://a.example/1", "x://b.net/", None])).orderBy("page_id").collect()
    assert [row["verdict"] for row in found] == ["allow", "block", "allow"]
    assert urls.judge(made(spark, [])).collect() == []


def test_threshold_errs_least(spark):
    rows = [(n, "allow" if n > 30_000 else "block") for n in range(0, 60_000, 5_000)]
    df = spark.createDataFrame(rows, "difference long, rule_verdict string")
    assert urls.threshold(df).first()[0] == 30_000
    assert urls.threshold(df.where(F.col("rule_verdict") == "allow")).first()[0] is None
