import itertools
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tallycard.llm import toxicity
from tallycard.llm.tables import table

SCHEMA = "doc_id long, text string, score double, row string, toxic int"


def made(spark, rows):
    return spark.createDataFrame([(n, text, 9.0, "clash", 1) for n, text in rows], SCHEMA)


def brute(left, right, order=3, decay=0.6):
    total = 0.0
    for one in itertools.combinations(range(len(left)), order):
        for two in itertools.combinations(range(len(right)), order):
            if all(left[a] == right[b] for a, b in zip(one, two)):
                total += decay ** (one[-1] - one[0] + 1 + two[-1] - two[0] + 1)
    return total


def codes(word):
    return np.array([list(map(ord, word))])


def test_kernel_is_the_sum_over_common_subsequences():
    for left, right in [("idiot", "id-iot"), ("clown", "clown"), ("aaaa", "aaa"), ("abc", "xyz"), ("ab", "abc")]:
        assert toxicity.kernel(codes(left), codes(right))[0] == pytest.approx(brute(left, right))


def test_landmark_kernels_are_normalised_kernels():
    landmarks = toxicity.Landmarks(["idiot", "clown", "éclair"])
    words = ["idiot", "idxiot", "crown", "zzz", "ab", "éclairs", "cloclown"]
    for word, row in zip(words, landmarks(words)):
        for landmark, value in zip(landmarks.words, row):
            own = brute(word, word) * brute(landmark, landmark)
            assert value == pytest.approx(brute(word, landmark) / own**0.5 if own else 0.0)


def test_gaps_and_inserted_letters_are_tolerated():
    similar = toxicity.Landmarks(["\x02worthless"])(["\x02worthxless", "\x02woorthless", "\x02weather"])[:, 0]
    assert similar[0] > 0.5 and similar[1] > 0.5 and similar[2] < 0.1


@pytest.fixture(scope="module")
def data():
    return "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark, data):
    return toxicity.train(table(spark, data, "documents"), table(spark, data, "labels"))


def test_held_out_accuracy(spark, data, model):
    docs, labels = table(spark, data, "documents"), table(spark, data, "labels")
    scored = toxicity.scored(docs.join(labels.select("doc_id", "toxic"), "doc_id"), model)
    rows = scored.select("row.doc_id", "row.toxic", "score", toxicity.held_out("row.doc_id").alias("out")).collect()
    assert all(row["out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0) for row in rows)
    held = [row for row in rows if row["out"]]
    right = sum((row["score"] >= 0.5) == bool(row["toxic"]) for row in held)
    clean = [row for row in held if not row["toxic"]]
    assert right / len(held) > 0.93
    assert sum(row["score"] >= 0.5 for row in clean) / len(clean) < 0.05


def test_odd_texts_have_scores(spark, model):
    texts = [None, "", " \n", "x" * 100_000, "i d i o t " * 3, "idiot " * 3, "IDIOT!! Idiot... (idiot)", "a b", "é ü ß", "id-iot id_iot i.diot"]
    scored = toxicity.scored(made(spark, list(enumerate(texts)) + [(5, texts[5]), (None, "")]), model)
    assert scored.columns == ["row", "score"]
    found = {}
    for row in scored.collect():
        assert 0 <= row["score"] <= 1
        assert found.setdefault(row["row"]["text"], row["score"]) == row["score"]
    assert found[None] == found[""] == found[" \n"] < 0.5
    assert all(found[text] > 0.5 for text in texts[4:7] + texts[9:])
    # Scores do not depend on what else is in the batch.
    alone = toxicity.scored(made(spark, [(1, texts[4])]), model).first()
    assert alone["score"] == pytest.approx(found[texts[4]])


def test_without_both_labels_all_scores_are_zero(spark, model):
    docs = made(spark, [(n, "you idiot") for n in range(20)])
    labels = spark.createDataFrame([(n, 1, 1) for n in range(20)], "doc_id long, quality int, toxic int")
    assert toxicity.train(docs, labels) is None
    assert {row["score"] for row in toxicity.scored(docs, None).collect()} == {0.0}
    assert toxicity.clean_documents(docs, labels).columns == docs.columns
    assert toxicity.scored(made(spark, []), model).collect() == []


def test_sample_is_bounded_and_agreed(spark):
    docs = made(spark, [(n, f"t{n}" if n != 8 else "x" * 99) for n in range(40)] + [(None, "n")])
    rows = [(n, 1, n % 2) for n in range(30)] + [(1, 1, 0), (2, 1, 0), (3, 1, None), (None, 1, 1), (31, 1, 7)]
    labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    found = toxicity.sample(docs, labels, most=5, most_chars=50).collect()
    usable = {f"t{n}": n % 2 for n in range(30) if n not in (1, 8) and zlib.crc32(str(n).encode()) % 5}
    assert all(usable[row["text"]] == row["toxic"] for row in found)
    assert 8 <= len(found) <= 10


def test_the_fit_looks_at_bounded_slices_of_words(monkeypatch):
    rng = np.random.default_rng(3)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))

    def words(count):
        return ["".join(rng.choice(letters, 7)) for _ in range(count)]

    toxic = [i % 2 for i in range(60)]
    texts = [" ".join([*words(20), *(["vermin", words(1)[0]] if bad else [])]) + "." for bad in toxic]
    whole = toxicity.fit(texts, toxic)
    sizes, call = [], toxicity.Landmarks.__call__

    def watched(self, words):
        sizes.append(len(words))
        return call(self, words)

    monkeypatch.setattr(toxicity.Landmarks, "__call__", watched)
    monkeypatch.setattr(toxicity, "TOGETHER", 64)
    sliced = toxicity.fit(texts, toxic)
    assert max(sizes) <= 64 < sum(sizes)
    assert np.allclose(sliced.weights, whole.weights) and np.allclose(sliced.curve, whole.curve)
    judged = sliced.score(pa.array([texts[0], "you vermin of the worst kind", ""]))
    assert judged[1] >= 0.5 > judged[0]
