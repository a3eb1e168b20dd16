"""Alignment of two tokenizers' tokens over the same bytes, by pointer jumping.

Both tokenizers cut the bytes of a text, each at places of its own; where both cut, the tokens fall into groups.
Every token points to its farthest-right overlapping token: the one of the other tokenizer that holds its last byte,
or itself if no token of the other reaches further. Pointers are then replaced by the pointers of where they point
to, for all tokens at once, until nothing changes; the steps double each time. What a token points to at last is the
last token of its group and labels it. Texts of a slice are laid end to end, since both tokenizers end with a text.

Where both tokenizers always cut at a single space between other characters (checked when they are read), each
distinct chunk between such spaces is encoded once.

Each two tokens that overlap are a link. Links are counted for pairs of ids over all documents. Pairs that are
common, at most `COMMON_PAIRS` by count, are broadcast to the links; the others are joined by shuffle, and none
of them has more than a small share of the links.

Defined results
* A text that is null or empty, or whose bytes one of the tokenizers does not give back, has no tokens: all its
  numbers are 0 and its `groups` are empty. A file of pieces adds a space before the text, so the other one
  reads the text with a space before it.
* Strings of special tokens inside a text are plain text.
* Repeated rows and null ids are documents like others. All columns of `docs` pass in `row`, so their names cannot
  clash with the new ones.
* An empty table, or one without any token, gives no counts.
* The groups of one text, written out, have to fit in a string of Spark (2 GB), so a text may have about 300 MB.
"""

import json
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallycard.llm.bytewords import LETTERS
from tallycard.llm.tables import held, kept, slices, text_of
from tallycard.llm.token_counts import chunk_codes

SLICE_BYTES = 1 << 20
KEPT_CHUNKS = 200_000
MARK = "▁"
# Letters that normalising would change.
_PROBE = " a  ﬁ Å e\u0301 \u3000\t\n x "
# Pairs of ids whose counts are broadcast: this many at most, counted before.
COMMON_PAIRS = 1 << 18
# What follows a token in `groups`: another one of its side, the other side, another group, nothing.
_MARKS = (",", "|", ";", "")
_NEXT, _SIDE, _GROUP, _END = range(4)

ALIGNED = "n_a long, n_b long, n_groups long, n_links long, groups string, links array<struct<a:int,b:int,n:long>>"


class Tokens:
    """One tokenizer: ids of texts, and the bytes of each id."""

    def __init__(self, path):
        if path.endswith(".model"):
            self._read_pieces(path)
        else:
            self._read_byte_level(path)
        self.lengths = np.array([len(raw) for raw in self.raw], dtype=np.int64)
        self.names = np.array([f"{number}{mark}" for number in range(len(self.raw)) for mark in _MARKS], dtype=object)
        self.known = {}

    def _read_pieces(self, path):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.encode = lambda texts: model.encode(texts, num_threads=1)
        self.raw = [self._piece(model, number) for number in range(model.vocab_size())]
        # No piece reaches over the beginning of a word, and texts are read as they are.
        self.by_chunk = model.normalize(_PROBE) == (" " + _PROBE).replace(" ", MARK) and not any(
            MARK in model.id_to_piece(number).lstrip(MARK) for number in range(model.vocab_size())
        )

    @staticmethod
    def _piece(model, number):
        if model.is_control(number):
            return b""
        piece = model.id_to_piece(number)
        return bytes([int(piece[1:-1], 16)]) if model.is_byte(number) else piece.replace(MARK, " ").encode()

    def _read_byte_level(self, path):
        # Tasks run side by side as it is.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        model = Tokenizer.from_file(path)
        model.encode_special_tokens = True
        self.encode = lambda texts: [
            found.ids for found in model.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)
        ]
        byte_of = {letter: byte for byte, letter in LETTERS.items()}
        self.raw = [b""] * (1 + max(model.get_vocab().values()))
        for token, number in model.get_vocab().items():
            if not set(token) <= byte_of.keys():
                raise ValueError(f"{path} has a token that is not in byte letters: {token!r}")
            self.raw[number] = bytes(byte_of[letter] for letter in token)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        splitter = spec["pre_tokenizer"] or {}
        # The splitting by kinds of characters always cuts at a single space.
        self.by_chunk = spec["normalizer"] is None and splitter.get("type") == "ByteLevel" and splitter.get("use_regex", True)

    def learn(self, chunks):
        """Ids of each chunk, or None where they do not give it back."""
        new = [chunk for chunk in chunks if chunk not in self.known]
        if len(self.known) + len(new) > KEPT_CHUNKS:
            self.known, new = {}, chunks
        for chunk, ids in zip(new, self.encode(new)):
            given_back = b"".join(map(self.raw.__getitem__, ids)) == (" " + chunk).encode()
            self.known[chunk] = ids if given_back else None
        found = [self.known[chunk] for chunk in chunks]
        if len(self.known) > KEPT_CHUNKS:
            self.known = {}
        return found


class Both:
    def __init__(self, paths):
        self.a, self.b = map(Tokens, paths)


def _chunks(both, texts):
    """Chunks of an Arrow array of texts that both tokenizers read one by one, each with a space before it.

    Distinct chunks, the chunks of all texts as places among them, and where each text's begin and end.
    """
    if both.a.by_chunk and both.b.by_chunk:
        return chunk_codes(texts)
    places = np.arange(len(texts) + 1)
    return texts.to_pylist(), places[:-1], places


def _joined(lists, codes, bounds):
    """The ids of the chunks `codes` one after the other, and where each text's begin and end."""
    sizes = np.array([len(ids) for ids in lists], dtype=np.int64)
    flat = np.array([number for ids in lists for number in ids], dtype=np.int64)
    starts, counts = (np.cumsum(sizes) - sizes)[codes], sizes[codes]
    ends = np.concatenate(([0], np.cumsum(counts)))
    places = np.arange(ends[-1]) + np.repeat(starts - ends[:-1], counts)
    return flat[places], ends[bounds]


def _encoded(both, texts):
    """(ids, bounds) of the texts for each tokenizer; no ids where one of them does not give the text back."""
    chunks, codes, bounds = _chunks(both, texts)
    lists_a, lists_b = both.a.learn(chunks), both.b.learn(chunks)
    lost = np.array([a is None or b is None for a, b in zip(lists_a, lists_b)], dtype=bool)
    counts, empty = np.diff(bounds), pc.equal(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    text = np.repeat(np.arange(len(counts)), counts)
    usable = ~empty & (np.bincount(text[lost[codes]], minlength=len(counts)) == 0)
    codes = codes[usable[text]]
    bounds = np.concatenate(([0], np.cumsum(np.where(usable, counts, 0))))
    return [_joined([ids or () for ids in lists], codes, bounds) for lists in (lists_a, lists_b)]


def group_ends(ends_a, ends_b):
    """For each token of a and b the last token of its group, as a place among b's tokens.

    `ends_*` are the places where the tokens end; both end with the same place.
    """
    reach_a = np.searchsorted(ends_b, ends_a)
    reach_b = np.searchsorted(ends_a, ends_b)
    size = len(ends_a)
    own = np.arange(len(ends_b)) + size
    # Where both end at once, b's token is the last of its group and points to itself.
    to = np.concatenate((reach_a + size, np.where(ends_a[reach_b] == ends_b, own, reach_b)))
    while True:
        further = to[to]
        if np.array_equal(further, to):
            return to[:size] - size, to[size:] - size
        to = further


def overlaps(ends_a, lengths_a, ends_b):
    """All overlapping tokens as two arrays of places, in order."""
    first = np.searchsorted(ends_b, ends_a - lengths_a, side="right")
    counts = np.searchsorted(ends_b, ends_a) - first + 1
    places = np.repeat(np.arange(len(ends_a)), counts)
    within = np.arange(len(places)) - np.repeat(np.cumsum(counts) - counts, counts)
    return places, np.repeat(first, counts) + within


def _written(both, ids_a, ids_b, group_a, group_b, last_b, bounds_a, bounds_b):
    """The groups of each text as `a1,a2|b1;a3|b2,b3`."""
    groups = int(last_b.sum())
    until_a, until_b = (np.cumsum(np.bincount(group, minlength=groups)) for group in (group_a, group_b))
    marks_a = np.full(len(ids_a), _NEXT)
    marks_a[until_a - 1] = _SIDE
    marks_b = np.where(last_b, _GROUP, _NEXT)
    text_ends = bounds_b[1:][np.diff(bounds_b) > 0] - 1
    marks_b[text_ends] = _END
    before_b = np.concatenate(([0], until_b))
    shown = np.empty(len(ids_a) + len(ids_b), dtype=object)
    shown[np.arange(len(ids_a)) + before_b[group_a]] = both.a.names[ids_a * len(_MARKS) + marks_a]
    shown[np.arange(len(ids_b)) + until_a[group_b]] = both.b.names[ids_b * len(_MARKS) + marks_b]
    shown, bounds = shown.tolist(), (bounds_a + bounds_b).tolist()
    return ["".join(shown[start:end]) for start, end in zip(bounds, bounds[1:])]


def _summed(texts, a, b, rows):
    """Links of each text as an Arrow list of (a, b, n): the distinct pairs of ids and how often they are linked."""
    pairs, codes = np.unique(a << 32 | b, return_inverse=True)
    keys, counts = np.unique(texts * max(len(pairs), 1) + codes, return_counts=True)
    text, code = np.divmod(keys, max(len(pairs), 1))
    found = pairs[code]
    structs = pa.StructArray.from_arrays(
        [
            pa.array((found >> 32).astype(np.int32)),
            pa.array((found & 0xFFFFFFFF).astype(np.int32)),
            pa.array(counts.astype(np.int64)),
        ],
        names=["a", "b", "n"],
    )
    offsets = np.searchsorted(text, np.arange(rows + 1))
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), structs)


def aligned_texts(both, texts):
    """Arrow columns of ALIGNED for an Arrow array of texts."""
    (ids_a, bounds_a), (ids_b, bounds_b) = _encoded(both, texts)
    lengths_a = both.a.lengths[ids_a]
    ends_a, ends_b = np.cumsum(lengths_a), np.cumsum(both.b.lengths[ids_b])
    label_a, label_b = group_ends(ends_a, ends_b)
    last_b = label_b == np.arange(len(ids_b))
    numbers = np.cumsum(last_b) - 1
    group_a, group_b = numbers[label_a], numbers[label_b]
    where_a, where_b = overlaps(ends_a, lengths_a, ends_b)
    text_of_link = np.searchsorted(bounds_a, where_a, side="right") - 1
    before = np.concatenate(([0], np.cumsum(last_b)))[bounds_b]
    return [
        pa.array(np.diff(bounds_a)),
        pa.array(np.diff(bounds_b)),
        pa.array(np.diff(before)),
        pa.array(np.bincount(text_of_link, minlength=len(texts)).astype(np.int64)),
        pa.array(_written(both, ids_a, ids_b, group_a, group_b, last_b, bounds_a, bounds_b), pa.string()),
        _summed(text_of_link, ids_a[where_a], ids_b[where_b], len(texts)),
    ]


def _aligning(paths):
    names = T.StructType.fromDDL(ALIGNED).names

    def task(batches):
        both = held(Both, paths)
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                columns = aligned_texts(both, part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column("row"), *columns], names=["row", *names])

    return task


def align(docs, path_a, path_b, text="text", keep=None):
    """Tokens of both tokenizers aligned, for each document: the columns of `docs` in `row`, and ALIGNED.

    `groups` holds the groups in order as `a1,a2|b1;a3|b2,b3`, by the ids of both; `groups_of` reads it. `links` holds
    the distinct pairs of ids that overlap and how often they do. The paths name files that every executor
    has: byte-level ones of tokenizers (.json) or ones of sentencepiece (.model). `keep` names the columns
    that go into `row`, by default all.
    """
    row = F.struct(*[F.col(name) for name in keep or docs.columns])
    rows = docs.select(row.alias("row"), text_of(text).alias("text"))
    kinds = T.StructType(rows.select("row").schema.fields + T.StructType.fromDDL(ALIGNED).fields)
    return rows.mapInArrow(_aligning((path_a, path_b)), kinds)


def groups_of(groups="groups"):
    """`groups` as an array of structs with two arrays of ids, a and b."""
    sides = F.transform(
        F.when(F.length(groups) > 0, F.split(groups, ";")).otherwise(F.array().cast("array<string>")),
        lambda group: F.split(group, "[|]"),
    )
    return F.transform(
        sides,
        lambda side: F.struct(
            F.split(side[0], ",").cast("array<int>").alias("a"), F.split(side[1], ",").cast("array<int>").alias("b")
        ),
    )


def pair_counts(links):
    """For rows (a, b, n): the sum of n of each pair as `count`, and whether it is the highest of its b, as `best`.

    The highest counts are one row for each id of b, as many as its vocabulary has, and are broadcast.
    """
    counts = kept(links.groupBy("a", "b").agg(F.sum("n").alias("count")), "pair-counts")
    highest = counts.groupBy("b").agg(F.max("count").alias("highest"))
    return counts.join(F.broadcast(highest), "b").select("a", "b", "count", (F.col("count") == F.col("highest")).alias("best"))


def _common(counts):
    """The least power of two that at most COMMON_PAIRS pairs reach with their count."""
    power = F.length(F.bin("count")) - 1
    reached, bound = 0, 1 << 62
    for row in counts.groupBy(power.alias("power")).agg(F.count("*").alias("pairs")).orderBy(F.desc("power")).collect():
        reached += row["pairs"]
        if reached > COMMON_PAIRS:
            break
        bound = 1 << row["power"]
    return F.col("count") >= bound


def with_counts(aligned):
    """Aligned documents without their links, but with `n_best` and `count_sum`.

    `n_best`: the links whose pair of ids has the highest count of all pairs with its id of b, over all documents.
    `count_sum`: the counts of the links' pairs, added up over the links.
    """
    stored = kept(aligned.withColumn("no", F.monotonically_increasing_id()), "alignment")
    links = stored.select("no", F.inline("links"))
    counts = pair_counts(links.select("a", "b", "n"))
    is_common = _common(counts)
    common, rare = F.broadcast(counts.where(is_common)), counts.where(~is_common)
    found = [
        links.join(common, ["a", "b"]),
        links.join(common.select("a", "b"), ["a", "b"], "left_anti").join(rare, ["a", "b"]),
    ]
    sums = [F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)), F.sum(F.col("n") * F.col("count"))]
    added = [
        part.groupBy("no").agg(sums[0].alias("n_best"), sums[1].alias("count_sum")) for part in found
    ]
    total = added[0].unionByName(added[1]).groupBy("no").agg(
        F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")
    )
    return stored.drop("links").join(total, "no", "left").drop("no").fillna(0, ["n_best", "count_sum"])
