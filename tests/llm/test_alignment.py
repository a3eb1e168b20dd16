import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__
from tallycard.llm import alignment
from tallycard.llm.tables import table

from conftest import DATA

PATHS = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
SCHEMA = "doc_id long, text string, row int, links string, a int, no int, count int, n_a int"


def letters():
    """Byte-level letters by the rule that GPT-2 made public."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [byte for byte in range(256) if byte not in plain]
    return {chr(byte): byte for byte in plain} | {chr(256 + at): byte for at, byte in enumerate(hidden)}


def brute(texts):
    """(n_a, n_b, n_groups, n_links, n_best, count_sum, groups) of each text, byte by byte."""
    first, second = Tokenizer.from_file(PATHS[0]), sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    first.encode_special_tokens = True
    byte_of, links, shown = letters(), [], []
    for text in texts:
        raw = (" " + (text or "")).encode()
        a = first.encode(" " + (text or ""), add_special_tokens=False).ids
        b = second.encode(text or "")
        raw_a = [bytes(byte_of[letter] for letter in first.id_to_token(i)) for i in a]
        raw_b = [
            bytes([int(second.id_to_piece(i)[3:5], 16)]) if second.is_byte(i)
            else second.id_to_piece(i).replace("▁", " ").encode()
            for i in b
        ]
        if not text or b"".join(raw_a) != raw or b"".join(raw_b) != raw:
            links.append([])
            shown.append((0, 0, []))
            continue
        owner_a = [i for i, piece in enumerate(raw_a) for _ in piece]
        owner_b = [i for i, piece in enumerate(raw_b) for _ in piece]
        touching = sorted(set(zip(owner_a, owner_b)))
        links.append([(a[i], b[j]) for i, j in touching])
        groups, own_a, own_b = [], [], []
        for at in range(len(raw)):
            own_a += [owner_a[at]] * (owner_a[at] not in own_a)
            own_b += [owner_b[at]] * (owner_b[at] not in own_b)
            last = at + 1 == len(raw)
            if last or owner_a[at + 1] != owner_a[at] and owner_b[at + 1] != owner_b[at]:
                groups.append(([a[i] for i in own_a], [b[j] for j in own_b]))
                own_a, own_b = [], []
        shown.append((len(a), len(b), groups))
    counts, highest = Counter(link for own in links for link in own), {}
    for (_, b), count in counts.items():
        highest[b] = max(highest.get(b, 0), count)
    return [
        (
            n_a, n_b, len(groups), len(own), sum(counts[link] == highest[link[1]] for link in own),
            sum(counts[link] for link in own), ";".join("|".join(",".join(map(str, s)) for s in g) for g in groups),
        )
        for own, (n_a, n_b, groups) in zip(links, shown)
    ]


TEXTS = [
    "The cat sat on the mat.", "The cat sat on the mat.", None, "", " ", "  two  spaces\n\n\tand\ttabs ", "naïve café, jalapeño",
    "日本語のテキスト and 한국어", "🙂🙃 family: 👩‍👩‍👧", "a▁b", "<|endoftext|></s><s><0x41><unk>", "\u0000\u0001", "x" * 3000, "ab " * 700,
    "é ﬁ 　 wide", "0123456789 3.14159 1,000,000", "don't we'll I'M", "ß nbsp",
]


@pytest.mark.parametrize("common", [alignment.COMMON_PAIRS, 20, 0])
def test_equals_brute_force(spark, monkeypatch, common):
    monkeypatch.setattr(alignment, "COMMON_PAIRS", common)
    rows = [(i if i != 5 else None, text, 0, "x", 1, 2, 3, 4) for i, text in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = alignment.with_counts(alignment.align(docs, *PATHS))
    numbers = [*(f"n_{name}" for name in ("a", "b", "groups", "links", "best")), "count_sum", "groups"]
    ours = Counter((row.row.doc_id, row.row.text, *(row[name] for name in numbers)) for row in found.collect())
    theirs = Counter((row[0], row[1], *numbers) for row, numbers in zip(rows, brute(TEXTS)))
    assert ours == theirs


def test_groups_are_read_back(spark):
    docs = spark.createDataFrame([(0, TEXTS[7]), (1, None)], "doc_id long, text string")
    aligned = alignment.align(docs, *PATHS).select("row.doc_id", "groups", alignment.groups_of().alias("read")).collect()
    for row in aligned:
        assert ";".join("|".join(",".join(map(str, side)) for side in group) for group in row["read"]) == row["groups"]


def test_long_chains_are_followed_to_their_end():
    # Tokens of two bytes against tokens of two bytes that are one byte off: one group of all.
    ends_a, ends_b = np.append(np.arange(2, 10000, 2), 10001), np.append(np.arange(1, 10000, 2), 10001)
    last_a, last_b = alignment.group_ends(ends_a, ends_b)
    assert set(last_a) == set(last_b) == {len(ends_b) - 1}


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.with_counts(alignment.align(empty, *PATHS)).collect() == []


def test_query_equals_brute_force(spark):
    docs = table(spark, DATA, "documents").select("doc_id", "text").collect()
    expected = {}
    for doc, (*numbers, groups) in zip(docs, brute([doc["text"] for doc in docs])):
        expected[doc["doc_id"]] = (*numbers, hashlib.sha256(groups.encode()).hexdigest() if groups else "")
    found = __spark_entry__.queries()["op11_token_alignment"](spark, DATA)
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert {row["doc_id"]: tuple(row[name] for name in names) for row in found.collect()} == expected
    assert dict(found.dtypes) | dict.fromkeys(["doc_id", *names[:-1]], "bigint") == dict(found.dtypes)


def test_columns_to_keep(spark):
    docs = spark.createDataFrame([(0, "a b", 7)], "doc_id long, text string, groups int")
    row = alignment.align(docs, *PATHS, keep=["groups"]).select("row.*").collect()
    assert [tuple(r) for r in row] == [(7,)]
    assert alignment.align(docs, *PATHS).select(F.col("row.text")).first()[0] == "a b"
