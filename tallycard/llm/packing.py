"""Best-fit-decreasing packing of documents into token sequences.

A document is its token ids and an end id. Only what is longer than a sequence is cut, into pieces that fill one
each and a last shorter one. Pieces go, longest first, into the open sequence with the least room that still
takes them; a segment tree over the possible rooms, with the number of open sequences in each, finds it in
logarithmic time. Pieces are dealt at random into shards of bounded size, which are packed apart from each other: a shard
leaves only its last few sequences with room to spare, whatever the number of shards.

Defined results
* A null text is the empty text: one piece that is the end id alone.
* Repeated rows and null ids are documents like others; a piece is placed once for each row.
* Ties of length are taken in the order of (doc_id, piece, ids_crc32), and sequences of equal room last opened first.
* An empty table gives an empty result.
"""

import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallycard.llm.bytewords import LOWER_WORD, shown
from tallycard.llm.tables import blocks, held, kept, slices, text_of

SLICE_BYTES = 4 << 20
SHARD_PIECES = 1 << 16
KEPT_WORDS = 500_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class OpenSequences:
    """Open sequences by room left: a segment tree of counts over the rooms, and the sequences of each room."""

    def __init__(self, capacity):
        self.leaves = 1 << capacity.bit_length()
        self.counts = [0] * (2 * self.leaves)
        self.at = [[] for _ in range(capacity + 1)]

    def _add(self, room, number):
        node = room + self.leaves
        while node:
            self.counts[node] += number
            node >>= 1

    def open(self, room, sequence):
        self.at[room].append(sequence)
        self._add(room, 1)

    def take(self, length):
        """Removes the sequence with the least room of at least `length`: (room, sequence), or None."""
        counts, node = self.counts, length + self.leaves
        while not counts[node]:
            # Up until there is a right neighbour with open sequences.
            while node & 1 or not counts[node + 1]:
                node >>= 1
                if node <= 1:
                    return None
            node += 1
        while node < self.leaves:
            node = 2 * node if counts[2 * node] else 2 * node + 1
        room = node - self.leaves
        self._add(room, -1)
        return room, self.at[room].pop()


def best_fit(lengths, capacity):
    """Sequence number and offset of pieces whose lengths come in falling order."""
    rooms, sequences, offsets, opened = OpenSequences(capacity), [], [], 0
    for length in lengths:
        found = rooms.take(length)
        if found is None:
            found, opened = (capacity, opened), opened + 1
        room, sequence = found
        sequences.append(sequence)
        offsets.append(capacity - room)
        if room > length:
            rooms.open(room - length, sequence)
    return sequences, offsets


class WordEncoder:
    """Token ids of texts for a tokenizer whose words never span white space.

    Each distinct word is encoded once by the library; the ids of a text are put together from those.
    """

    def __init__(self, path):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known = {}
        self.marks = {mark: self._whole(mark) for mark in ".,"} | {"": b""}

    def _whole(self, string):
        ids = self.tokenizer.encode(string, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _new(self, words):
        tokenize, marks = self.tokenizer.model.tokenize, self.marks
        for word in words:
            # The tokenizer's own normalising and splitting leave these as they are.
            plain = LOWER_WORD(word)
            if plain is None:
                yield self._whole(word)
                continue
            stem, mark = plain.groups()
            ids = [token.id for token in tokenize(shown(stem))]
            yield struct.pack(f"<{len(ids)}I", *ids) + marks[mark]

    def encode(self, texts):
        """The ids of each of an Arrow array of texts, as bytes of little-endian 32-bit numbers."""
        # Control strings and the separators on which libraries differ are left to the tokenizer as they are.
        special = pc.match_substring_regex(texts, r"<\||[\x1c-\x1f]").to_pylist()
        # ASCII letters are lower-cased here already, which spares the library many words.
        lists = pc.utf8_split_whitespace(pc.ascii_lower(texts).cast(pa.large_string()))
        coded = lists.flatten().dictionary_encode()
        words, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy().tolist()
        offsets = lists.offsets.to_numpy().tolist()
        known = self.known
        if len(known) > KEPT_WORDS:
            known.clear()
        new = [word for word in words if word not in known]
        known.update(zip(new, self._new(new)))
        ids_of = [known[word] for word in words].__getitem__
        for row, whole in enumerate(special):
            if whole:
                yield self._whole(texts[row].as_py())
            else:
                yield b"".join(map(ids_of, codes[offsets[row] : offsets[row + 1]]))


def word_encoder(path):
    """One encoder for all tasks of a Python worker."""
    return held(WordEncoder, path)


def _cutting(path, capacity, end_id, with_ids):
    def task(batches):
        encoder = word_encoder(path)
        end = struct.pack("<I", end_id)
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                rows = []
                for doc_id, ids in zip(part.column("doc_id").to_pylist(), encoder.encode(part.column("text"))):
                    ids += end
                    for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                        held = ids[at : at + 4 * capacity]
                        listed = np.frombuffer(held, dtype="<i4") if with_ids else None
                        rows.append((doc_id, piece, at // 4, len(held) // 4, zlib.crc32(held), listed))
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()))
                columns = [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)]
                names = [*(field.name for field in _schema(False)), "ids"]
                yield pa.RecordBatch.from_arrays(columns[: 5 + with_ids], names=names[: 5 + with_ids])

    return task


def _schema(with_ids):
    fields = [T.StructField(*pair) for pair in zip(
        ("doc_id", "piece", "start", "length", "ids_crc32"),
        (T.LongType(), T.IntegerType(), T.LongType(), T.LongType(), T.LongType()),
    )]
    return T.StructType(fields + [T.StructField("ids", T.ArrayType(T.IntegerType()))] * with_ids)


def cut(docs, path, capacity=2048, end_id=0, with_ids=False):
    """The pieces of all documents: doc_id, piece, start, length, ids_crc32, and `ids` if asked for."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(_cutting(path, capacity, end_id, with_ids), _schema(with_ids))


def _packing(capacity, schema):
    def shard(key, table):
        table = table.sort_by(
            [("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")]
        )
        sequences, offsets = best_fit(table.column("length").to_pylist(), capacity)
        step, number = table.column("n_shards")[0].as_py(), key[0].as_py()
        ids = np.array(sequences, dtype=np.int64) * step + number
        columns = [table.column(name) for name in schema.names[:-2]]
        return pa.table([*columns, pa.array(ids), pa.array(offsets, pa.int64())], names=schema.names)

    return shard


def pack(pieces, capacity=2048, shard_pieces=SHARD_PIECES):
    """Adds `sequence_id` and `offset` to pieces with the columns of `cut`; others are kept.

    `pieces` is read twice, so it should be a stored table.
    """
    shards = blocks(pieces.count(), shard_pieces)
    dealt = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id()), F.lit(shards))
    schema = T.StructType(
        pieces.schema.fields
        + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    )
    sharded = pieces.withColumns({"n_shards": F.lit(shards), "shard": dealt.cast("int")})
    return sharded.groupBy("shard").applyInArrow(_packing(capacity, schema), schema)


def pack_documents(docs, path, capacity=2048, end_id=0, shard_pieces=SHARD_PIECES, with_ids=False):
    """All documents cut and packed. Each is encoded once; the pieces are stored before they are dealt.

    With `with_ids` each piece has its `ids`. They are joined to the packed pieces, so no shard holds any.
    """
    pieces = cut(docs, path, capacity, end_id, with_ids)
    if not with_ids:
        return pack(kept(pieces, "pieces"), capacity, shard_pieces)
    pieces = kept(pieces.withColumn("no", F.monotonically_increasing_id()), "pieces")
    packed = pack(pieces.drop("ids"), capacity, shard_pieces)
    return packed.join(pieces.select("no", "ids"), "no").drop("no")
