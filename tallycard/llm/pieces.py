"""N-best segmentation into pieces of a sentencepiece vocabulary, and back.

A segmentation's score is the sum of its pieces' scores. The forward pass over the lattice of pieces (Viterbi) finds
the best score up to each letter, which is exactly what is left of the way for a search from the end: A* over backward
paths, with these scores as the heuristic, completes segmentations in the order of their scores and looks at nothing else.

No piece reaches over the beginning of a word (a `▁` behind another letter; checked when the vocabulary is
read), so the lattice of a text is a chain of the lattices of its words. Each distinct word of a batch gets one forward
pass, which also gives the score of its second best segmentation. The n best of a text differ from the best in at most
n - 1 words, and only in those that lose least by it; these are searched, and a second search over their lists finds
the text's n best.

Defined results
* A null text is the empty text: it has one segmentation, of no pieces.
* A text with fewer than n segmentations has as many as there are. Of equal scores, the one comes first whose last
  different piece is longer, and over several words that which differs in the earlier word.
* A letter outside the vocabulary is one step of the lattice, at a cost beyond all pieces, and is written as its bytes.
* Strings of control pieces inside a text are text. A `▁` in the text itself comes back as a space.
* Rows are independent of each other; an empty table gives an empty result.
"""

import heapq
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tallycard.llm.tables import held, slices, text_of

MARK = "▁"
SLICE_BYTES = 4 << 20
KEPT_WORDS = 900_000
KEPT_LISTS = 50_000
# Words up to this length are looked at together, so many at a time.
LONG_WORD = 32
TOGETHER = 1 << 14
# Beyond all losses.
NO_LOSS = 1 << 60
# Beyond what any piece that is meant to be used costs.
UNUSED = -100_000_000
_WORD_START = re.compile(f"(?<=[^{MARK}])(?={MARK})")


class PieceLattice:
    """Segmentations by the pieces of a model file."""

    def __init__(self, path):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.normalize = model.normalize
        self.arcs, self.bytes_of, byte_ids = {}, {}, {}
        for number in range(model.get_piece_size()):
            piece = model.id_to_piece(number)
            if model.is_byte(number):
                byte_ids[int(piece[3:5], 16)] = number
                self.bytes_of[number] = bytes([int(piece[3:5], 16)])
            elif not (model.is_control(number) or model.is_unknown(number) or model.is_unused(number)):
                score = model.get_score(number)
                if score != int(score):
                    raise ValueError(f"{path}: the score of a piece is not a whole number")
                self.arcs[piece] = (int(score), number)
                self.bytes_of[number] = piece.replace(MARK, " ").encode()
        if any(MARK in piece.lstrip(MARK) for piece in self.arcs):
            raise ValueError(f"{path}: some pieces reach over the beginning of a word")
        self.byte_ids = byte_ids
        self.longest = max(map(len, self.arcs))
        self.unknown = min(score for score, _ in self.arcs.values() if score > UNUSED) - 10
        self._trie()
        # The pieces' bytes by number, for decoding.
        self.table = [self.bytes_of.get(number, b"") for number in range(model.get_piece_size())]
        self.known, self.lists = {}, {}

    def _trie(self):
        """The pieces as a trie: sorted keys (node, letter), the node each leads to, and the piece that ends in a node."""
        nodes, self.piece_at, self.score_at = {}, [-1], [0]
        for piece, (score, number) in self.arcs.items():
            node = 0
            for letter in piece:
                key = node << 21 | ord(letter)
                if key not in nodes:
                    nodes[key] = len(self.piece_at)
                    self.piece_at.append(-1)
                    self.score_at.append(0)
                node = nodes[key]
            self.piece_at[node], self.score_at[node] = number, score
        self.keys = np.array(sorted(nodes), dtype=np.int64)
        self.child = np.array([nodes[key] for key in self.keys.tolist()], dtype=np.int64)
        self.piece_at, self.score_at = np.array(self.piece_at), np.array(self.score_at, dtype=np.int64)

    def _ending(self, word, end):
        """Steps (start, score) that end at a letter, longer ones first."""
        for start in range(max(0, end - self.longest), end):
            arc = self.arcs.get(word[start:end])
            if arc is not None:
                yield start, arc[0]
            elif start == end - 1:
                yield start, self.unknown

    def forward(self, word):
        """(best score up to each letter, where its last step begins, the second best score of the whole)."""
        arcs, longest = self.arcs.get, self.longest
        best, back, second = [0], [0], [None]
        for end in range(1, len(word) + 1):
            top, runner, begin = None, None, 0
            for start in range(end - longest if end > longest else 0, end):
                arc = arcs(word[start:end])
                if arc is None:
                    if start < end - 1:
                        continue
                    step = self.unknown
                else:
                    step = arc[0]
                score = best[start] + step
                if top is None or score > top:
                    top, runner, begin = score, top, start
                elif runner is None or score > runner:
                    runner = score
                other = second[start]
                if other is not None and (runner is None or other + step > runner):
                    runner = other + step
            best.append(top)
            back.append(begin)
            second.append(runner)
        return best, back, second[-1]

    def n_best(self, word, n):
        """The n best segmentations, as (score, list of cuts): backward A* with the forward scores as the heuristic."""
        kept = self.lists.get((word, n))
        if kept is not None:
            return kept
        best, _, _ = self.forward(word)
        heap, found, pushed = [(-best[-1], 0, len(word), 0, None)], [], 1
        while heap and len(found) < n:
            _, _, at, behind, path = heapq.heappop(heap)
            if at == 0:
                cuts = [0]
                while path is not None:
                    cuts.append(path[0])
                    path = path[1]
                found.append((behind, cuts))
                continue
            for start, score in self._ending(word, at):
                heapq.heappush(heap, (-(best[start] + score + behind), pushed, start, behind + score, (at, path)))
                pushed += 1
        if len(self.lists) > KEPT_LISTS:
            self.lists.clear()
        self.lists[word, n] = found
        return found

    def ids(self, word, cuts):
        """Numbers of the pieces between cuts; unknown letters as the numbers of their bytes."""
        out = []
        for start, end in zip(cuts, cuts[1:]):
            arc = self.arcs.get(word[start:end])
            out += [arc[1]] if arc else [self.byte_ids[byte] for byte in word[start:end].encode()]
        return out

    def learn(self, words):
        """Forward passes of the words that are not known yet: (score, packed ids, loss of the second best)."""
        if len(self.known) > KEPT_WORDS:
            self.known.clear()
        new = [word for word in words if word not in self.known]
        for word in new:
            if len(word) > LONG_WORD:
                best, back, second = self.forward(word)
                cuts = [len(word)]
                while cuts[-1]:
                    cuts.append(back[cuts[-1]])
                packed = _packed(self.ids(word, cuts[::-1]))
                self.known[word] = (best[-1], packed, NO_LOSS if second is None else best[-1] - second)
        short = sorted((word for word in new if len(word) <= LONG_WORD), key=len)
        for at in range(0, len(short), TOGETHER):
            self._learn(short[at : at + TOGETHER])

    def _learn(self, words):
        """`forward` for many words of similar length, step by step together."""
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        wide = int(sizes.max())
        letters = np.zeros((len(words), wide), dtype=np.int64)
        letters[np.arange(wide) < sizes[:, None]] = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4")
        best = np.full((len(words), wide + 1), -NO_LOSS, dtype=np.int64)
        # The last step of the best way to each letter: where it begins, and the piece's number and one, or 0.
        second, last = best.copy(), np.zeros((len(words), wide + 1), dtype=np.int32)
        best[:, 0] = 0

        def step(rows, start, end, score, number):
            one, held = best[rows, start] + score, best[rows, end]
            rest = np.maximum(second[rows, start] + score, np.minimum(one, held))
            second[rows, end] = np.maximum(second[rows, end], rest)
            better = np.flatnonzero(one > held)
            rows = rows[better]
            best[rows, end] = one[better]
            last[rows, end] = number[better] + 1 << 6 | start

        for start in range(wide):
            rows = np.flatnonzero(sizes > start)
            node = np.zeros(len(rows), dtype=np.int64)
            for end in range(start + 1, min(wide, start + self.longest) + 1):
                long = sizes[rows] >= end
                rows, node = rows[long], node[long]
                key = node << 21 | letters[rows, end - 1]
                place = np.searchsorted(self.keys, key).clip(max=len(self.keys) - 1)
                there = self.keys[place] == key
                node = np.where(there, self.child[place], 0)
                number = np.where(there, self.piece_at[node], -1)
                ends = number >= 0
                step(rows[ends], start, end, self.score_at[node[ends]], number[ends])
                if end == start + 1:
                    strange = rows[~ends]
                    step(strange, start, end, self.unknown, np.full(len(strange), -1))
                rows, node = rows[there], node[there]
                if not len(rows):
                    break
        row = np.arange(len(words))
        score, loss = best[row, sizes], best[row, sizes] - second[row, sizes]
        loss = np.where(second[row, sizes] < -NO_LOSS // 2, NO_LOSS, loss)
        known, byte_ids = self.known, self.byte_ids
        for word, at, total, lost, steps in zip(words, sizes.tolist(), score.tolist(), loss.tolist(), last.tolist()):
            ids = []
            while at:
                number = steps[at] >> 6
                if number:
                    ids.append(number - 1)
                else:
                    ids += [byte_ids[byte] for byte in reversed(word[at - 1].encode())]
                at = steps[at] & 63
            ids.reverse()
            known[word] = (total, _packed(ids), lost)

    def decode(self, packed):
        """The bytes of a text from the packed ids of all of it; the space before its first word goes."""
        raw = b"".join(map(self.table.__getitem__, np.frombuffer(packed, dtype="<u4").tolist()))
        return raw[1:] if raw[:1] == b" " else raw


def _packed(ids):
    return struct.pack(f"<{len(ids)}I", *ids)


def piece_lattice(path):
    """One lattice for all tasks of a Python worker."""
    return held(PieceLattice, path)


def _words(normalized):
    """Arrow lists of the words of texts, without the mark that each begins with."""
    if not any(MARK + MARK in text for text in normalized):
        return pc.split_pattern(pa.array([text[1:] for text in normalized], pa.large_string()), MARK)
    return pa.array([[word[1:] for word in _WORD_START.split(text)] for text in normalized], pa.list_(pa.large_string()))


def _text_n_best(options, n):
    """The n combinations of options with the least loss: (loss, one choice per place).

    `options[i]` are losses in rising order, from 0 on.
    """
    first = (0,) * len(options)
    heap, seen, found = [(0, first)], {first}, []
    while heap and len(found) < n:
        loss, choice = heapq.heappop(heap)
        found.append((loss, choice))
        for at, rank in enumerate(choice):
            if rank + 1 < len(options[at]):
                following = (*choice[:at], rank + 1, *choice[at + 1 :])
                if following not in seen:
                    seen.add(following)
                    heapq.heappush(heap, (loss - options[at][rank] + options[at][rank + 1], following))
    # Of equal losses, changes of earlier words come first.
    return sorted(found, key=lambda item: (item[0], [-rank for rank in item[1]]))


def _least(losses, n):
    """Places of the n smallest losses, in rising order of places; of equal losses the first."""
    if len(losses) > n:
        bound = np.partition(losses, n - 1)[n - 1] if n else -1
        less = np.flatnonzero(losses < bound)
        equal = np.flatnonzero(losses == bound)[: n - len(less)]
        places = np.sort(np.concatenate((less, equal))) if n else less[:0]
    else:
        places = np.arange(len(losses))
    return places[losses[places] < NO_LOSS].tolist()


class _Text:
    """What is known of the distinct words of some texts, for the n best segmentations of each."""

    def __init__(self, lattice, distinct):
        self.lattice, self.words = lattice, [MARK + word for word in distinct]
        lattice.learn(self.words)
        known = [lattice.known[word] for word in self.words]
        self.scores = np.array([score for score, _, _ in known], dtype=np.int64)
        self.losses = np.array([loss for _, _, loss in known], dtype=np.int64)
        self.packed = [packed for _, packed, _ in known]
        self.sizes = np.array([len(packed) for packed in self.packed], dtype=np.int64)

    def n_best(self, codes, n):
        """(score, packed ids, whether they decode like those of the best) of the text of these words."""
        lattice = self.lattice
        base, total = b"".join(map(self.packed.__getitem__, codes.tolist())), int(self.scores[codes].sum())
        chosen = _least(self.losses[codes], n - 1)
        words = [self.words[codes[at]] for at in chosen]
        lists = [lattice.n_best(word, n) for word in words]
        options = [[own[0][0] - score for score, _ in own] for own in lists]
        ends = np.cumsum(self.sizes[codes])
        for loss, choice in _text_n_best(options, n):
            packed, alike = base, True
            for at, rank, own, word in reversed(list(zip(chosen, choice, lists, words))):
                if rank:
                    other, end = _packed(lattice.ids(word, own[rank][1])), int(ends[at])
                    packed = packed[: end - int(self.sizes[codes[at]])] + other + packed[end:]
                    alike = alike and lattice.decode(other) == lattice.decode(self.packed[codes[at]])
            yield total - loss, packed, alike


def segmentations(lattice, text, n):
    """The n best segmentations of a text: (score, packed ids)."""
    normalized = lattice.normalize(text)
    words = [word[1:] for word in _WORD_START.split(normalized)] if normalized else []
    return [found[:2] for found in _Text(lattice, words).n_best(np.arange(len(words)), n)]


def _encoding(path, n, with_ids):
    def task(batches):
        lattice = piece_lattice(path)
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                texts = part.column("text").to_pylist()
                normalized = [lattice.normalize(text) for text in texts]
                lists = _words(normalized)
                offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
                coded = lists.flatten().dictionary_encode()
                known, codes = _Text(lattice, coded.dictionary.to_pylist()), coded.indices.to_numpy()
                rows = []
                for row, doc_id in enumerate(part.column("doc_id").to_pylist()):
                    own = codes[offsets[row] : offsets[row + 1]] if normalized[row] else codes[:0]
                    raw = texts[row].encode()
                    for rank, (score, packed, alike) in enumerate(known.n_best(own, n), 1):
                        # The best comes first; the others differ from it in a few words.
                        restored = lattice.decode(packed) == raw if rank == 1 else restored and alike
                        rows.append(
                            (
                                doc_id, rank, score, len(packed) // 4, zlib.crc32(packed), restored,
                                np.frombuffer(packed, dtype="<u4") if with_ids else None,
                            )
                        )
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.list_(pa.int64()))
                names = ["doc_id", "rank", "score", "n_pieces", "ids_crc32", "restored", "ids"]
                columns = [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays(columns[: 6 + with_ids], names=names[: 6 + with_ids])

    return task


def encode(docs, path, n=4, with_ids=False):
    """The n best segmentations of each text: doc_id, rank (from 1), score, n_pieces, ids_crc32 and restored.

    `restored` tells whether decoding gives the text back. `with_ids` adds the numbers of the pieces.
    """
    rows = docs.selectExpr("CAST(doc_id AS long) AS doc_id", "text").select("doc_id", text_of().alias("text"))
    schema = "doc_id long, rank int, score long, n_pieces long, ids_crc32 long, restored boolean"
    return rows.mapInArrow(_encoding(path, n, with_ids), schema + ", ids array<long>" * with_ids)
