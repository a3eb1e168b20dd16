import hashlib

from pyspark.sql import functions as F

from tallycard.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, example int, body string"
ROWS = [
    (1, 0, "system", "s"), (1, 1, "user", "</s>[INST] ok [/INST]"), (1, 2, "assistant", "\\l\\\\b<s>[x]"),
    (1, 3, "user", "again\n"), (1, 4, "assistant", "é🙂"), (1, 5, "user", "left over"),
    (2, 0, "user", "no answer"), (3, 1, "assistant", None), (3, 0, None, None), (None, 0, "assistant", "n"),
    (4, 0, "user", "same"), (4, 0, "user", "same"), (4, None, "we]ird[", "x" * 5000), (4, 1, "assistant", ""),
    (5, 0, "assistant", "one"), (5, 1, "assistant", "two"),
]


def made(spark, rows):
    return spark.createDataFrame([(*row, 7, "clash") for row in rows], SCHEMA)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def ordered(rows, conv):
    own = [(t is not None, t or 0, r or "", x or "") for c, t, r, x in rows if c == conv]
    return [(role, text) for _, _, role, text in sorted(own)]


def test_digest_reads_back_what_went_in(spark):
    found = {row["conv_id"]: row for row in chat.digest(chat.examples(made(spark, ROWS))).collect()}
    assert set(found) == {row[0] for row in ROWS}
    for conv, row in found.items():
        turns = ordered(ROWS, conv)
        said = "".join(text for role, text in turns if role == "assistant")
        assert row["n_turns"] == len(turns)
        assert row["turns_sha256"] == sha("".join(f"{role}\n{text}\n" for role, text in turns))
        assert (row["loss_chars"], row["loss_sha256"]) == (len(said), sha(said))


def test_each_answer_is_an_example_with_all_before_it(spark):
    rows = chat.examples(made(spark, ROWS)).where("conv_id = 1").orderBy("example").collect()
    assert [row["example"] for row in rows] == [0, 1, 2]
    masked = [row["formatted"][row["mask_start"] : row["mask_end"]] for row in rows]
    assert masked == ["\\\\l\\\\\\\\b\\ls>\\bx\\e", "é🙂", ""]
    for shorter, longer in zip(rows, rows[1:]):
        assert longer["formatted"].startswith(shorter["formatted"])
    assert rows[0]["formatted"].count("</s>") == 3
    assert rows[0]["formatted"].endswith(masked[0] + "</s>")


def test_escaping_leaves_no_control_string_and_comes_back(spark):
    texts = ["", "\\", "\\\\", "<", "\\<", "[]", "\\l", "\\\\l", "a\\\\\\[b", "</s>", "\\e]"]
    df = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n int, t string").coalesce(1)
    rows = df.select("n", chat.escaped(F.col("t")).alias("e")).select("e", chat.unescaped(F.col("e")).alias("b"))
    found = rows.collect()
    assert [row["b"] for row in found] == texts
    assert not any(mark in row["e"] for row in found for mark in "<[]")


def test_no_turns_no_examples(spark):
    assert chat.digest(chat.examples(made(spark, []))).collect() == []
