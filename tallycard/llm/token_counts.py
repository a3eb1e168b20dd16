"""Exact token counts of every prefix, by dynamic programming over byte-pair merges.

A byte-pair encoding is right exactly if each two neighbouring tokens encode to themselves, and every prefix of a
piece has one encoding. So the encoding of a prefix is that of a shorter prefix and one more token, the only one
that gets on with the last token before it; its count is one more. One pass over a piece finds the count at each
of its prefixes. Pieces come from the tokenizer's own splitting, and no token spans two of them, so the counts of
a text are those of its pieces added up. Truncation and budget questions are then answered by looking up counts.

A text is first cut at single spaces between other characters, where the splitting always cuts; each distinct
chunk of a batch is looked at once. What is kept between batches is bounded by `KEPT_PIECES`.

Defined results
* A null text is the empty text: no bytes, no tokens.
* The string of a special token inside a text is one token, as the library does by default; neither the
  begin nor the end of a text adds any.
* Rows are independent of each other: repeated rows, null ids and other columns change nothing.
"""

import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallycard.llm.bytewords import SPACE, SPACED_WORD, shown
from tallycard.llm.tables import held, slices, text_of

SLICE_BYTES = 4 << 20
KEPT_PIECES = 1_000_000
# A place where the splitting always cuts: a single space with other characters on both sides.
_CUT = re.compile(r"(?<=\S) (?=\S)")
_SPACES = r"  | [\t\n\x0b\x0c\r\x1c-\x1f\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]|[\t\n\x0b\x0c\r\x1c-\x1f\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}] |^ | $"


class PrefixCounter:
    """Token counts at every prefix of strings, for a byte-level byte-pair tokenizer file."""

    def __init__(self, path):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        merges = (m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"])
        self.ranks = {tuple(pair): rank for rank, pair in enumerate(merges)}
        self.split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self.specials = [token["content"] for token in spec["added_tokens"]]
        # Tokens that the merges reach, by number; others never come up.
        vocabulary = [t for t in spec["model"]["vocab"] if len(t) == 1 or len(self.merged(t)) == 1]
        self.numbers, self.names = {t: at for at, t in enumerate(vocabulary)}, vocabulary
        # Lengths of the tokens of three letters and more by their last three, longest first.
        by_end = {}
        for token in vocabulary:
            if len(token) > 2:
                by_end.setdefault(token[-3:], set()).add(len(token))
        self.lengths = {end: (*sorted(found, reverse=True), 2, 1) for end, found in by_end.items()}
        self.neighbours, self.pieces = {}, {}

    def merged(self, symbols):
        """Encoding by merging the pair of lowest rank, again and again: the definition, for short strings."""
        symbols, ranks = list(symbols), self.ranks
        while len(symbols) > 1:
            pairs = [ranks.get(pair, len(ranks)) for pair in zip(symbols, symbols[1:])]
            rank = min(pairs)
            if rank == len(ranks):
                break
            at = pairs.index(rank)
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols

    def _fits(self, left, right):
        """Whether two tokens encode to themselves, one after the other."""
        known = self.neighbours
        if len(known) > KEPT_PIECES // 2:
            known.clear()
        pair = [self.names[left], self.names[right]]
        found = known[left << 32 | right] = self.merged("".join(pair)) == pair
        return found

    def prefix_counts(self, piece):
        """counts[i]: tokens of the first i bytes of a piece, which is given in the tokenizer's byte letters."""
        number_of, lengths, known = self.numbers.get, self.lengths.get, self.neighbours.get
        counts, last = [0], [None]
        for end in range(1, len(piece) + 1):
            for length in lengths(piece[end - 3 : end], (2, 1)) if end > 2 else (2, 1):
                start = end - length
                if start < 0:
                    continue
                token = number_of(piece[start:end])
                if token is None:
                    continue
                if start:
                    before = last[start]
                    fits = known(before << 32 | token)
                    if fits is None:
                        fits = self._fits(before, token)
                    if not fits:
                        continue
                counts.append(counts[start] + 1)
                last.append(token)
                break
        return counts

    def _pieces(self, chunk):
        """Pieces of a chunk in byte letters."""
        plain = SPACED_WORD(chunk)
        if plain is None:
            return [piece for piece, _ in self.split(chunk)]
        word, mark = plain.groups()
        return (SPACE + shown(word), mark) if mark else (SPACE + shown(word),)

    def count(self, chunk):
        """Tokens of a whole chunk: the last entries of its pieces' tables, which are kept."""
        if any(special in chunk for special in self.specials):
            return self.table(chunk)[-1]
        pieces, total = self.pieces, 0
        for piece in self._pieces(chunk):
            found = pieces.get(piece)
            if found is None:
                if len(pieces) > KEPT_PIECES:
                    pieces.clear()
                found = pieces[piece] = self.prefix_counts(piece)[-1]
            total += found
        return total

    def _add_up(self, string):
        """Counts at the prefixes of a string without special tokens."""
        total = [0]
        for piece, _ in self.split(string):
            base = total[-1]
            total.extend([base + count for count in self.prefix_counts(piece)[1:]])
        return total

    def table(self, string):
        """counts[i]: tokens that end within the first i bytes, or that those bytes of their piece take.

        counts[-1] is the count of the whole string. Inside a special token the count stays as before it.
        """
        if not any(special in string for special in self.specials):
            return self._add_up(string)
        total = [0]
        for part in re.split("(" + "|".join(map(re.escape, self.specials)) + ")", string):
            if part in self.specials:
                total.extend([total[-1]] * (len(part.encode()) - 1) + [total[-1] + 1])
            else:
                base = total[-1]
                total.extend([base + count for count in self._add_up(part)[1:]])
        return total


def prefix_counter(path):
    """One counter for all tasks of a Python worker."""
    return held(PrefixCounter, path)


def chunks_of(texts):
    """Lists of chunks of an Arrow array of texts; a chunk but the first of its text has lost a space before it."""
    odd = pc.match_substring_regex(texts, _SPACES)
    if not pc.any(odd).as_py():
        return pc.split_pattern(texts, " ")
    return pa.array([_CUT.split(text) for text in texts.to_pylist()], pa.list_(pa.string()))


def chunk_codes(texts):
    """Distinct chunks as text will have them, with the code of each chunk in a row and the offsets of the texts."""
    lists = chunks_of(texts).cast(pa.list_(pa.large_string()))
    coded = lists.flatten().dictionary_encode()
    offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy(), offsets


def _counting(path, keep, with_table):
    def task(batches):
        counter = prefix_counter(path)
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                texts = part.column("text")
                words, codes, offsets = chunk_codes(texts)
                after = np.array([counter.count(" " + word) for word in words], dtype=np.int64)
                counts = after[codes]
                # The first chunk of a text has no space before it.
                for row in np.flatnonzero(np.diff(offsets)):
                    counts[offsets[row]] = counter.count(words[codes[offsets[row]]])
                sums = np.concatenate(([0], np.cumsum(counts)))
                columns = [part.column(name) for name in keep] + [
                    pc.binary_length(texts).cast(pa.int64()),
                    pa.array(sums[offsets[1:]] - sums[offsets[:-1]]),
                ]
                names = [*keep, "n_bytes", "n_tokens"]
                if with_table:
                    columns.append(
                        pa.array([counter.table(text) for text in texts.to_pylist()], pa.list_(pa.int32()))
                    )
                    names.append("prefix_tokens")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return task


def count_tokens(docs, path, keep=("doc_id",), text="text", with_table=False):
    """Rows of `docs` with `n_bytes` and `n_tokens` of the whole text, next to the columns in `keep`.

    `with_table` adds `prefix_tokens`: the count after each byte from 0 to all, for `tokens_within` and
    `bytes_within`. `path` names a file that every executor has.
    """
    keep = list(keep)
    rows = docs.select(*keep, text_of(text).alias("text"))
    schema = rows.select(*keep).schema.add("n_bytes", "long").add("n_tokens", "long")
    if with_table:
        schema = schema.add("prefix_tokens", T.ArrayType(T.IntegerType()))
    return rows.mapInArrow(_counting(path, keep, with_table), schema)


def tokens_within(n_bytes, prefix_tokens="prefix_tokens"):
    """Tokens of the first `n_bytes` bytes of a text."""
    last = F.size(prefix_tokens) - 1
    return F.get(prefix_tokens, F.least(F.lit(n_bytes), last))


def bytes_within(budget, prefix_tokens="prefix_tokens"):
    """The most bytes from the start whose count stays within a budget of tokens."""
    return F.size(F.filter(prefix_tokens, lambda count: count <= budget)) - 1
