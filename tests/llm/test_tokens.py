import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallycard.llm import packing, token_counts

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    None, "", " ", "a", "  two  spaces \n\n and\tlines \r\n", "it's we'll I'D don't", "x" * 300, "Ünïcödé ß ÿ × ÷ é",
    "e\u0301 combining", "日本語 текст 한국어", "<|endoftext|>", "a <|endoftext|> b<|endoftext|>", "<|startoftext|> <|ENDOFTEXT|>",
    "\x1c \x1d a\x1eb", "\u00a0nb\u2003sp", "1234 5.6 7,8", "emoji 🤦🏼‍♂️ 🙂", "Σίσυφος ΣΑΣ", "İstanbul", "the, the. THE", "\x00\x01",
    "very " * 3000 + "long", "nospaces" * 2000,
]


def docs(spark, texts):
    rows = [(n, text, "x", 1, 2) for n, text in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, tie string, n_tokens int, length int")


@pytest.fixture(scope="module")
def byte_bpe():
    return Tokenizer.from_file(BYTE_BPE)


def test_counts_are_the_librarys(spark, byte_bpe):
    found = token_counts.count_tokens(docs(spark, ODD + ODD), BYTE_BPE).orderBy("doc_id").collect()
    expected = [
        (len((t or "").encode()), len(byte_bpe.encode(t or "", add_special_tokens=False).ids)) for t in ODD + ODD
    ]
    assert [(row["n_bytes"], row["n_tokens"]) for row in found] == expected
    assert token_counts.count_tokens(docs(spark, []), BYTE_BPE).collect() == []


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=40))
def test_any_text(text):
    tokenizer = Tokenizer.from_file(BYTE_BPE) if not hasattr(test_any_text, "t") else test_any_text.t
    test_any_text.t = tokenizer
    expected = len(tokenizer.encode(text, add_special_tokens=False).ids)
    table = token_counts.prefix_counter(BYTE_BPE).table(text)
    assert len(table) == len(text.encode()) + 1 and table[-1] == expected


def test_every_prefix_of_a_piece_has_its_own_encodings_count(byte_bpe):
    counter = token_counts.prefix_counter(BYTE_BPE)
    for piece in ("Ġinternationalisation", "Ġthhaatststinn", "!!!!????....", "ĠÃ©Ã©Ã¨re"):
        expected = [0] + [len(byte_bpe.model.tokenize(piece[:n])) for n in range(1, len(piece) + 1)]
        assert counter.prefix_counts(piece) == expected


def test_budgets_are_looked_up(spark):
    counted = token_counts.count_tokens(docs(spark, ["one two three four"]), BYTE_BPE, with_table=True)
    row = counted.select(
        token_counts.tokens_within(7).alias("t"), token_counts.bytes_within(2).alias("b"),
        token_counts.tokens_within(999).alias("all"), token_counts.bytes_within(0).alias("none"),
    ).first()
    assert tuple(row) == (2, 7, 4, 0)


def test_best_fit_takes_the_tightest(spark):
    rng = np.random.default_rng(3)
    for capacity in (1, 7, 64, 100):
        lengths = sorted(rng.integers(1, capacity + 1, 200).tolist(), reverse=True)
        sequences, offsets = packing.best_fit(lengths, capacity)
        rooms = []
        for length, sequence, offset in zip(lengths, sequences, offsets):
            fitting = [room for room in rooms if room >= length]
            if fitting:
                assert rooms[sequence] == min(fitting)
            else:
                assert sequence == len(rooms)
                rooms.append(capacity)
            assert offset == capacity - rooms[sequence]
            rooms[sequence] -= length


@pytest.mark.parametrize("shard_pieces", [1 << 16, 5])
def test_documents_are_packed_whole(spark, shard_pieces):
    tokenizer = Tokenizer.from_file(WORD_BPE)
    texts = ODD + ["again"] * 3
    rows = packing.pack_documents(docs(spark, texts), WORD_BPE, capacity=64, shard_pieces=shard_pieces).collect()
    pieces, sequences = {}, {}
    for row in rows:
        pieces.setdefault(row["doc_id"], []).append(row)
        sequences.setdefault(row["sequence_id"], []).append((row["offset"], row["length"]))
    for number, text in enumerate(texts):
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], dtype="<u4")
        expected = [
            (n, start, len(ids[start : start + 64]), zlib.crc32(ids[start : start + 64].tobytes()))
            for n, start in enumerate(range(0, len(ids), 64))
        ]
        own = sorted(tuple(row[name] for name in ("piece", "start", "length", "ids_crc32")) for row in pieces[number])
        assert own == expected
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    least = -(-sum(row["length"] for row in rows) // 64)
    assert len(sequences) <= least + (1 if shard_pieces > 100 else 20)


def test_no_documents_no_sequences(spark):
    assert packing.pack_documents(docs(spark, []), WORD_BPE).collect() == []


def test_ids_come_with_the_pieces(spark):
    row = packing.pack_documents(docs(spark, ["hello there"]), WORD_BPE, with_ids=True).first()
    expected = Tokenizer.from_file(WORD_BPE).encode("hello there", add_special_tokens=False).ids + [0]
    assert row["ids"] == expected
