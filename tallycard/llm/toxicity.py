"""Toxicity by a support vector machine on a subsequence string kernel, with Nyström landmarks.

The gap-weighted subsequence kernel counts common subsequences of three letters, each weighted by DECAY to the
power of the length it spans in either word, so an insult with letters put in between keeps most of its likeness.
A word's beginning counts as a letter. The words that tell toxic sentences from others best are the landmarks. A
word's feature vector is its normalised kernel with each landmark, whitened by the landmarks' own kernel matrix
(Nyström). A linear support vector machine judges words, from the worst words of every document of the sample: each
round takes those by the machine so far and fits again (multiple instances). A document's score is a logistic curve, fitted
on the same sample, of the margins of its TOP worst words and of the number and share of its words on the toxic side.

The sample is bounded, and one task fits it: at most TRAIN_DOCS documents of each label, those with the smallest hash of the id, and of them the
ones of at most TRAIN_CHARS characters. Scoring reads whole texts; each distinct word of a batch is looked at once.

Defined results
* Words are cut at white space, lower-cased and freed of all marks; runs of three and more single letters
  are read as one word too. Longer words than PIECE are read in pieces that overlap by half.
* A null or empty text scores like a text whose words resemble no landmark. Repeated rows score alike.
* Labels that are null, or disagree about a document, are not learnt from. If one of the two labels is not there
  to learn from, every score is 0.
"""

import itertools
import pickle

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallycard.llm.tables import held, release, slices, text_of

TRAIN_DOCS = 1500
TRAIN_CHARS = 8000
LANDMARKS = 64
# What a landmark needs: so many different places in toxic sentences, so many times the share it has of others, and
# a likelihood ratio far beyond chance.
MIN_PLACES = 4
MIN_RATIO = 5
MIN_GAIN = 12.0
ORDER = 3
DECAY = 0.6
PIECE = 16
BEGIN = "\x02"
TOP = 3
SLICE_BYTES = 1 << 20
KEPT_WORDS = 250_000
TOGETHER = 1 << 14


def kernel(left, right, decay=DECAY, order=ORDER):
    """Gap-weighted subsequence kernel of equally many words: two integer matrices, one row a word."""
    n_words, wide = left.shape
    high = right.shape[1]
    equal = left[:, :, None] == right[:, None, :]
    prefix = np.ones((n_words, wide + 1, high + 1))
    for _ in range(order - 1):
        longer = np.zeros_like(prefix)
        for i in range(1, wide + 1):
            ending = np.zeros(n_words)
            for j in range(1, high + 1):
                ending = decay * ending + decay**2 * equal[:, i - 1, j - 1] * prefix[:, i - 1, j - 1]
                longer[:, i, j] = decay * longer[:, i - 1, j] + ending
        prefix = longer
    return decay**2 * np.einsum("nij,nij->n", equal, prefix[:, :-1, :-1])


def _codes(words):
    """Matrix of code points of words of one length."""
    return np.array([list(map(ord, word)) for word in words], dtype=np.int32).reshape(len(words), -1)


def _by_length(words):
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    for length in np.unique(lengths):
        if length >= ORDER:
            yield length, np.flatnonzero(lengths == length)


def pieces_of(word):
    """A word with its beginning marked, or its overlapping pieces of at most PIECE letters."""
    word = BEGIN + word
    if len(word) <= PIECE:
        return [word]
    return [word[at : at + PIECE] for at in range(0, len(word) - PIECE // 2, PIECE // 2)]


class Landmarks:
    """Normalised kernels of words with the landmark words."""

    def __init__(self, words):
        self.words = list(words)
        letters = sorted(set("".join(self.words)))
        self.letters = np.array([ord(letter) for letter in letters], dtype=np.int32)
        size = len(letters) + 1
        # Subsequences of the landmarks by number; 0 stands for all others.
        features, self.table = {}, np.zeros((size,) * ORDER, dtype=np.int32)
        entries = []
        for column, word in enumerate(self.words):
            for places in itertools.combinations(range(len(word)), ORDER):
                key = tuple(letters.index(word[at]) + 1 for at in places)
                row = features.setdefault(key, len(features) + 1)
                entries.append((row, column, DECAY ** (places[-1] - places[0] + 1)))
        self.weights = np.zeros((len(features) + 1, len(self.words)))
        for key, row in features.items():
            self.table[key] = row
        for row, column, weight in entries:
            self.weights[row, column] += weight
        self.norms = np.array([self._own([word])[0] for word in self.words])

    @staticmethod
    def _own(words):
        codes = _codes(words)
        return np.sqrt(kernel(codes, codes))

    def __call__(self, words):
        """Matrix of kernels, one row a word. Subsequences of a word that no landmark has add nothing."""
        out = np.zeros((len(words), len(self.words)))
        for length, rows in _by_length(words):
            codes = _codes([words[row] for row in rows])
            place = np.searchsorted(self.letters, codes).clip(max=len(self.letters) - 1)
            known = np.where(self.letters[place] == codes, place + 1, 0)
            shared = np.zeros((len(rows), len(self.words)))
            for places in itertools.combinations(range(length), ORDER):
                found = self.table[tuple(known[:, at] for at in places)]
                hit = np.flatnonzero(found)
                shared[hit] += DECAY ** (places[-1] - places[0] + 1) * self.weights[found[hit]]
            near = np.flatnonzero(shared.any(axis=1))
            if len(near):
                own = self._own([words[rows[at]] for at in near])
                out[rows[near]] = shared[near] / own[:, None] / self.norms
        return out


class Model:
    """Scores words, and documents by their worst words. Margins are cut off at -1 and 1."""

    def __init__(self, landmarks, weights, bias):
        self.landmarks, self.weights, self.bias, self.known = landmarks, weights, bias, {}
        self.curve = np.zeros(TOP + 3)

    def of_words(self, words):
        """Margins of distinct words."""
        known = self.known
        if len(known) > KEPT_WORDS:
            known.clear()
        new = [word for word in words if word not in known]
        pieces = [pieces_of(word) for word in new]
        flat = list(itertools.chain.from_iterable(pieces))
        margins = np.empty(len(flat))
        for start in range(0, len(flat), TOGETHER):
            part = slice(start, start + TOGETHER)
            margins[part] = np.clip(self.landmarks(flat[part]) @ self.weights + self.bias, -1, 1)
        at = 0
        for word, own in zip(new, pieces):
            known[word] = float(margins[at : at + len(own)].max())
            at += len(own)
        return np.array([known[word] for word in words], dtype=float)

    def features(self, words, codes, offsets):
        """One row per text: the TOP highest margins of its words, the number above 0 in TOPths up to 1, the share above 0
        in fiftieths up to 1, and 1."""
        margins = self.of_words(words)[codes] if len(words) else np.empty(0)
        sizes = np.diff(offsets)
        out = np.full((len(sizes), TOP + 3), max(-1.0, min(1.0, self.bias)))
        out[:, TOP + 2] = 1
        near = np.flatnonzero(margins > out[0, 0]) if len(sizes) else np.empty(0, dtype=np.int64)
        owner = np.searchsorted(offsets, near, side="right") - 1
        order = np.lexsort((-margins[near], owner))
        near, owner = near[order], owner[order]
        first = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=len(sizes)))))[:-1]
        place = np.arange(len(near)) - first[owner]
        top = place < TOP
        out[owner[top], place[top]] = margins[near[top]]
        above = np.bincount(owner[margins[near] > 0], minlength=len(sizes))
        out[:, TOP] = np.minimum(1, above / TOP)
        out[:, TOP + 1] = np.minimum(1, 50 * above / np.maximum(1, sizes))
        return out

    def score(self, texts):
        """Scores of an Arrow array of texts."""
        if not len(texts):
            return np.empty(0)
        return _curve(self.features(*words_of(texts)) @ self.curve)


def _curve(x):
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def words_of(texts):
    """(words, codes, offsets): distinct words of an Arrow array of texts, each word's number, and where texts begin."""
    lists = pc.utf8_split_whitespace(pc.utf8_lower(texts).cast(pa.large_string()))
    raw = lists.flatten().dictionary_encode()
    bare = pc.replace_substring_regex(raw.dictionary, r"[^\pL\pN]+", "").dictionary_encode()
    words, codes = bare.dictionary.to_pylist(), bare.indices.to_numpy()[raw.indices.to_numpy()]
    offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    spelt = _spelt_out(words, codes, offsets)
    if not spelt:
        return words, codes, offsets
    # Runs of single letters, as words behind those of their text.
    numbers = {word: at for at, word in enumerate(words)}
    parts = []
    for row in range(len(offsets) - 1):
        parts.append(codes[offsets[row] : offsets[row + 1]])
        parts.append([numbers.setdefault(word, len(numbers)) for word in spelt.get(row, [])])
    sizes = [len(a) + len(b) for a, b in zip(parts[::2], parts[1::2])]
    merged = np.concatenate([np.asarray(part, dtype=np.int64) for part in parts])
    return list(numbers), merged, np.concatenate(([0], np.cumsum(sizes)))


def _spelt_out(words, codes, offsets):
    """Row -> words that its runs of three and more single letters spell."""
    single = np.array([len(word) == 1 for word in words], dtype=bool)
    marks = np.concatenate(([False], single[codes], [False])) if len(codes) else np.zeros(2, dtype=bool)
    starts = np.flatnonzero(~marks[:-1] & marks[1:])
    ends = np.flatnonzero(marks[:-1] & ~marks[1:])
    found = {}
    for start, end in zip(starts.tolist(), ends.tolist()):
        if end - start < ORDER:
            continue
        while start < end:
            row = int(np.searchsorted(offsets, start, side="right")) - 1
            stop = min(end, int(offsets[row + 1]))
            if stop - start >= ORDER:
                found.setdefault(row, []).append("".join(words[codes[at]] for at in range(start, stop)))
            start = stop
    return found


def _landmarks(words, codes, offsets, toxic, n):
    """The words that toxic sentences have much more often than others, by the likelihood ratio.

    `offsets` are of sentences, each with its document's label in `toxic`. What counts is in how many different
    places a word stands, each told by the words on both sides, so copies of a document count once.
    """
    owner = np.repeat(toxic, np.diff(offsets))
    codes = codes[offsets[0] : offsets[-1]].astype(np.int64)
    edge = len(words)
    before, after = np.concatenate(([edge], codes[:-1])), np.concatenate((codes[1:], [edge]))
    starts = offsets[:-1][np.diff(offsets) > 0]
    before[starts] = edge
    after[starts[1:] - 1] = edge
    size = edge + 1
    around = before * size + after
    order = np.lexsort((around, codes, owner))
    new = np.zeros(len(codes), dtype=bool)
    new[:1] = True
    for key in (owner, codes, around):
        own = key[order]
        new[1:] |= own[1:] != own[:-1]
    counts = np.zeros((2, len(words)))
    np.add.at(counts, (owner[order[new]], codes[order[new]]), 1)
    (clean, bad), all_places = counts, np.maximum(counts.sum(axis=1), 1)
    rate = (clean + bad) / all_places.sum()
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = 2 * (
            np.where(bad > 0, bad * np.log(bad / (rate * all_places[1])), 0)
            + np.where(clean > 0, clean * np.log(clean / (rate * all_places[0])), 0)
        )
    usable = np.array([ORDER <= len(word) <= PIECE for word in words], dtype=bool)
    more = bad / all_places[1] > MIN_RATIO * clean / all_places[0]
    gain = np.where(usable & more & (bad >= MIN_PLACES), gain, 0)
    best = np.argsort(-gain, kind="stable")[:n]
    return [words[at] for at in best if gain[at] > MIN_GAIN]


def _svm(features, labels, weights, bias, steps=300, penalty=1e-3):
    """Linear support vector machine by subgradient steps over all rows, both labels weighted alike."""
    share = np.where(labels > 0, 0.5 / max(1, (labels > 0).sum()), 0.5 / max(1, (labels < 0).sum()))
    for step in range(1, steps + 1):
        rate = 1.0 / (penalty * (step + 1000))
        active = share * labels * (labels * (features @ weights + bias) < 1)
        weights = (1 - rate * penalty) * weights + rate * (active @ features)
        bias += rate * active.sum() * 0.1
    return weights, bias


def _logistic(features, labels, steps=100, penalty=0.05):
    """Coefficients of a logistic regression, by Newton's method; the last feature, the constant, is not penalised."""
    y, at = (labels > 0).astype(float), np.zeros(features.shape[1])
    ridge = penalty * np.append(np.ones(features.shape[1] - 1), 1e-6)
    for _ in range(steps):
        p = _curve(features @ at)
        gradient = features.T @ (p - y) + ridge * at
        curve = (features * (p * (1 - p))[:, None]).T @ features + np.diag(ridge + 1e-9)
        at = at - np.clip(np.linalg.solve(curve, gradient), -1, 1)
    return at


def fit(texts, toxic, n_landmarks=LANDMARKS, rounds=8):
    """A Model of texts with labels 0 and 1, or None if a label or any landmark is missing."""
    toxic = np.asarray(toxic, dtype=np.int64)
    if not len(toxic) or toxic.min() == toxic.max():
        return None
    split = [_sentences(text) for text in texts]
    owners = np.repeat(np.arange(len(split)), [len(own) for own in split])
    words, codes, offsets = words_of(pa.array(list(itertools.chain.from_iterable(split)), pa.string()))
    chosen = _landmarks(words, codes, offsets, toxic[owners], n_landmarks)
    if not chosen:
        return None
    landmarks = Landmarks([BEGIN + word for word in chosen])
    values, vectors = np.linalg.eigh(landmarks(landmarks.words))
    whitening = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-2))) @ vectors.T
    pieces = [pieces_of(word) for word in words]
    flat = list(itertools.chain.from_iterable(pieces))
    known = np.empty((len(flat), len(chosen)), dtype=np.float32)
    for at in range(0, len(flat), TOGETHER):
        known[at : at + TOGETHER] = landmarks(flat[at : at + TOGETHER]) @ whitening
    firsts = np.cumsum([0] + [len(own) for own in pieces])
    # A document is the pieces of its words, each word as often as it comes.
    ends = np.searchsorted(owners, np.arange(len(split)), side="right")
    limits = np.concatenate(([0], offsets[ends]))
    bags = []
    for begin, end in zip(limits[:-1], limits[1:]):
        own = codes[begin:end]
        spans = [np.arange(firsts[at], firsts[at + 1]) for at in own.tolist()]
        bags.append(np.concatenate(spans) if spans else np.empty(0, dtype=np.int64))
    labels = np.where(toxic == 1, 1.0, -1.0)
    weights, bias = whitening @ np.ones(len(chosen)) / 2, -0.5
    for _ in range(rounds):
        # By slices, as the product is made of wider numbers than are held.
        starts = range(0, len(known), TOGETHER)
        margins = np.concatenate([known[at : at + TOGETHER] @ weights for at in starts])
        rows, owner = [], []
        for number, bag in enumerate(bags):
            worst = bag[np.argsort(-margins[bag], kind="stable")[:TOP]]
            rows.append(worst)
            owner.append(np.full(len(worst), number))
        rows, owner = np.concatenate(rows), np.concatenate(owner)
        weights, bias = _svm(known[rows], labels[owner], weights, bias)
    model = Model(landmarks, whitening @ weights, float(bias))
    # What the rounds read is dropped before the documents are read once more, a slice at a time.
    del words, codes, split, pieces, flat, known, bags
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])
    parts = [model.features(*words_of(part.column("text"))) for part in slices(batch, "text", SLICE_BYTES)]
    model.curve = _logistic(np.concatenate(parts), labels)
    model.known = {}
    return model


def _sentences(text):
    for mark in "!?\n":
        text = text.replace(mark, ".")
    return text.split(".")


def held_out(doc_id="doc_id"):
    """True for the fifth of the ids that is never learnt from."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 5 == 0


def sample(docs, labels, most=TRAIN_DOCS, most_chars=TRAIN_CHARS):
    """The bounded training sample: text, toxic."""
    agreed = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out())
        .groupBy("doc_id")
        .agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("other"))
        .where(F.col("toxic") == F.col("other"))
    )
    drawn = Window.partitionBy("toxic").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = agreed.withColumn("place", F.row_number().over(drawn)).where(F.col("place") <= most)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    texts = texts.where((F.char_length("text") > 0) & (F.char_length("text") <= most_chars))
    # At most twice `most` ids.
    return texts.join(F.broadcast(chosen.select("doc_id", "toxic")), "doc_id").select("text", "toxic")


def _fitting(batches):
    release()
    texts, toxic = [], []
    for batch in batches:
        texts += batch.column("text").to_pylist()
        toxic += batch.column("toxic").to_pylist()
    model = fit(texts, toxic)
    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])


def train(docs, labels):
    """A Model from the bounded sample, fitted in one task; None if there is nothing to learn from."""
    rows = sample(docs, labels).distinct().repartition(1).sortWithinPartitions("text", "toxic")
    found = rows.mapInArrow(_fitting, "model binary").collect()
    return pickle.loads(found[0]["model"]) if found else None


def _unpickled(pickled):
    return pickle.loads(pickled)


def _scoring(pickled, keep):
    def task(batches):
        model = held(_unpickled, pickled)
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                texts = part.column("text")
                scores = np.zeros(len(texts)) if model is None else model.score(texts)
                columns = [part.column(name) for name in keep]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(scores)], names=[*keep, "score"])

    return task


def scored(docs, model):
    """The columns of `docs` in `row`, and `score`."""
    rows = docs.select(F.struct("*").alias("row"), text_of().alias("text"))
    schema = rows.select("row").schema.add("score", "double")
    return rows.mapInArrow(_scoring(pickle.dumps(model), ["row"]), schema)


def predicted(score="score"):
    return (F.col(score) >= 0.5).cast("int")


def clean_documents(docs, labels):
    """The rows of `docs` that are not predicted to be toxic."""
    return scored(docs, train(docs, labels)).where(predicted() == 0).select("row.*")
