import random

import public_tokenizers
import pytest

from tallycard.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    None, "", " ", "a", "  lead and  inner   spaces ", "line\nbreak\ttab", "Ünïcödé ß", "日本語 🙂🙂", "</s> <s> <unk> <0x41>",
    "the cat sat on the mat", "x" * 60, "\x00 \x1c", "word " * 2000,
]


@pytest.fixture(scope="module")
def lattice():
    return pieces.piece_lattice(PATH)


def every(lattice, string):
    """All segmentations of a string by pieces that do not cross words, as scores in falling order."""
    if not string:
        return [0]
    out = []
    for end in range(1, len(string) + 1):
        arc = lattice.arcs.get(string[:end])
        step = arc[0] if arc else lattice.unknown if end == 1 else None
        if step is not None:
            out += [step + rest for rest in every(lattice, string[end:])]
    return sorted(out, reverse=True)


def test_n_best_of_words_and_texts_are_the_best_of_all(lattice):
    rng = random.Random(3)
    for _ in range(60):
        text = "".join(rng.choice("theaniro  🙂é") for _ in range(rng.randrange(1, 11)))
        scores = every(lattice, lattice.normalize(text))
        found = list(pieces.segmentations(lattice, text, 6))
        assert [score for score, _ in found] == scores[:6]
        assert len({packed for _, packed in found}) == len(found)
        for _, packed in found:
            assert lattice.decode(packed) == text.encode()


def test_forward_scores_are_exact_and_so_is_the_second_best(lattice):
    for word in ("▁the", "▁international", "▁🙂a", "▁", "▁aa"):
        scores = every(lattice, word)
        best, _, second = lattice.forward(word)
        assert best[-1] == scores[0]
        assert second == (scores[1] if len(scores) > 1 else None)
        assert [score for score, _ in lattice.n_best(word, 50)] == scores[:50]


def docs(spark, texts):
    rows = [(n, text, 1, "clash") for n, text in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, rank int, score string")


def test_documents(spark, lattice):
    texts = ODD + ["one two", "one two"]
    rows = pieces.encode(docs(spark, texts), PATH, with_ids=True).collect()
    for number, text in enumerate(texts):
        own = sorted((row for row in rows if row["doc_id"] == number), key=lambda row: row["rank"])
        expected = list(pieces.segmentations(lattice, text or "", 4))
        assert [(row["rank"], row["score"]) for row in own] == [(r, s) for r, (s, _) in enumerate(expected, 1)]
        assert all(row["restored"] and row["n_pieces"] == len(row["ids"]) for row in own)
    assert pieces.encode(docs(spark, []), PATH).collect() == []


def test_a_mark_in_the_text_comes_back_as_a_space(spark):
    row = pieces.encode(docs(spark, ["a▁b"]), PATH, n=1).first()
    assert not row["restored"]


def test_scores_that_are_not_whole_are_an_error(tmp_path):
    import sentencepiece

    rng = random.Random(1)
    words = ["".join(rng.choice("abcdef") for _ in range(rng.randrange(2, 6))) for _ in range(300)]
    sentencepiece.SentencePieceTrainer.train(
        sentence_iterator=iter([" ".join(rng.choices(words, k=8)) for _ in range(300)]), model_type="unigram",
        model_prefix=str(tmp_path / "unigram"), vocab_size=60, hard_vocab_limit=False, num_threads=1, minloglevel=2,
    )
    with pytest.raises(ValueError, match="whole number"):
        pieces.PieceLattice(str(tmp_path / "unigram.model"))
