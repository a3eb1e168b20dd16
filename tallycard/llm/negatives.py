"""Hard negatives by exact matrix products: Strassen's recursion on tiles, and mergeable heaps.

Anchors and candidates are dealt into blocks of bounded size, and each block of anchors meets each block of
candidates once. There the scores are whole tiles of a matrix product, found by Strassen's recursion on 64-bit
integers: tiles are padded with zeros to an even size, halved in every direction, and seven products stand in for
eight. Additions of 64-bit integers wrap, and wrapping is undone by the end, so every score that fits is exact;
tiles whose scores might not fit are multiplied in whole numbers of any size.

Each anchor keeps a small heap of its best rows: tiles are merged into it one after the other, and the heaps of
the blocks are merged by a window. A first pass finds the positives (best rows of the anchor's label), a second one
fills a heap for each positive with rows of other labels whose score lies in a window below the positive's.

Defined results
* A row takes no part if its id, label or vector is null or a component is null or not finite.
* Components that a vector lacks count as 0, so vectors of different or no length are comparable.
* Higher scores come first, ties by smaller id. Rows that repeat an id are candidates of their own, but none for an
  anchor with that id. Equal anchors give one result; different labels or vectors under one anchor's id give one
  result each, and a positive that is there twice gives its negatives twice.
* A component beyond BIGINT takes the end of its range, and so does a score, before scores are compared.
* An anchor without a positive, and a positive without a row in its window, give no rows.
* An empty table gives an empty result.
"""

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallycard.llm.tables import blocks, kept

# Below this size in any direction a product is computed as it is.
LEAF = 16
ANCHOR_TILE, CANDIDATE_TILE = 128, 2048
_LOW, _HIGH = -(2**63), 2**63 - 1

POSITIVES = "anchor_id long, anchor_no long, positive_id long, positive_score long"
NEGATIVES = (
    "anchor_id long, anchor_no long, positive_id long, positive_rank int, positive_score long, "
    "negative_id long, negative_score long"
)


def quantised(rows, scale=256, row_id="vec_id", label="label", vector="embedding"):
    """Rows (id, label, weights) with weights floor(scale * component); rows that take no part are left out."""
    usable = F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & ~F.exists(
        "v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    )
    whole = F.transform("v", lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("bigint"))
    named = rows.select(
        F.col(row_id).cast("bigint").alias("id"), F.col(label).cast("bigint").alias("label"), F.col(vector).alias("v")
    )
    return named.where(usable).select("id", "label", whole.alias("weights"))


def _even(matrix):
    """With a row and a column of zeros where their number is odd."""
    rows, columns = matrix.shape
    if rows % 2 == columns % 2 == 0:
        return matrix
    padded = np.zeros((rows + rows % 2, columns + columns % 2), dtype=matrix.dtype)
    padded[:rows, :columns] = matrix
    return padded


def strassen(left, right):
    """The product of two matrices of integers, 64-bit ones modulo 2**64."""
    rows, inner, columns = *left.shape, right.shape[1]
    if min(rows, inner, columns) <= LEAF:
        return left @ right
    left, right = _even(left), _even(right)
    i, j, k = (size // 2 for size in (*left.shape, right.shape[1]))
    a, b, c, d = left[:i, :j], left[:i, j:], left[i:, :j], left[i:, j:]
    e, f, g, h = right[:j, :k], right[:j, k:], right[j:, :k], right[j:, k:]
    diagonal = strassen(a + d, e + h)
    lower, upper = strassen(c + d, e), strassen(a, f - h)
    back, front = strassen(d, g - e), strassen(a + b, h)
    product = np.empty((2 * i, 2 * k), dtype=left.dtype)
    product[:i, :k] = diagonal + back - front + strassen(b - d, g + h)
    product[:i, k:] = upper + front
    product[i:, :k] = lower + back
    product[i:, k:] = diagonal - lower + upper + strassen(c - a, e + f)
    return product[:rows, :columns]


class BestRows:
    """A heap of the `size` best (score, id) of one anchor, higher scores and then smaller ids first."""

    def __init__(self, size):
        self.size, self.heap = size, []

    def merge(self, scores, ids):
        """Take in rows, of which the best `size` count. `ids` rise, so ties go to the front."""
        if len(self.heap) == self.size and len(scores):
            # What is worse than all that is held does not get in.
            above = scores >= self.heap[0][0]
            scores, ids = scores[above], ids[above]
        if len(scores) > self.size:
            bound = np.partition(scores, len(scores) - self.size)[len(scores) - self.size]
            more = np.flatnonzero(scores > bound)
            equal = np.flatnonzero(scores == bound)[: self.size - len(more)]
            places = np.concatenate((more, equal))
            scores, ids = scores[places], ids[places]
        for score, row in zip(scores.tolist(), ids.tolist()):
            if len(self.heap) < self.size:
                heapq.heappush(self.heap, (score, -row))
            else:
                heapq.heappushpop(self.heap, (score, -row))

    def rows(self):
        return [(score, -row) for score, row in sorted(self.heap, reverse=True)]


def _matrix(column, width):
    """Lists of integers as rows of a matrix, filled up with zeros."""
    lists = column.combine_chunks()
    lengths = np.diff(lists.offsets.to_numpy())
    rows = np.repeat(np.arange(len(lists)), lengths)
    places = np.arange(len(rows)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    matrix = np.zeros((len(lists), width), dtype=np.int64)
    matrix[rows, places] = lists.flatten().to_numpy(zero_copy_only=False)
    return matrix


def _width(column):
    return int(np.diff(column.combine_chunks().offsets.to_numpy()).max(initial=1))


def _largest(matrix):
    """The largest size of a component."""
    return max(abs(int(matrix.max(initial=0))), abs(int(matrix.min(initial=0))))


def tiles(anchors, candidates):
    """Scores of blocks, tile by tile: (first anchor, first candidate, scores)."""
    width = max(_width(anchors.column("weights")), _width(candidates.column("weights")))
    left = _matrix(anchors.column("weights"), width)
    right = _matrix(candidates.column("weights"), width)
    fits = width * _largest(left) * _largest(right) < 2**63
    for begin in range(0, len(right), CANDIDATE_TILE):
        part = right[begin : begin + CANDIDATE_TILE].T
        for first in range(0, len(left), ANCHOR_TILE):
            tile = left[first : first + ANCHOR_TILE]
            if fits:
                yield first, begin, strassen(tile, part)
            else:
                yield first, begin, np.clip(strassen(tile.astype(object), part.astype(object)), _LOW, _HIGH)


def _columns(found, schema):
    kinds = {"long": pa.int64(), "int": pa.int32()}
    fields = [field.split(" ") for field in schema.split(", ")]
    columns = list(zip(*found)) if found else [[] for _ in fields]
    return pa.table(
        [pa.array(column, kinds[kind]) for column, (_, kind) in zip(columns, fields)], names=[name for name, _ in fields]
    )


def _numbers(table, name):
    return table.column(name).to_numpy()


def _positives(count):
    """The best rows of the anchor's label, in one pair of blocks."""

    def cell(anchors, candidates):
        candidates = candidates.sort_by("id")
        ids, labels = _numbers(candidates, "id"), _numbers(candidates, "label")
        own, numbers, own_labels = (_numbers(anchors, name) for name in ("id", "number", "label"))
        heaps = [BestRows(count) for _ in own]
        for first, begin, scores in tiles(anchors, candidates):
            span = slice(begin, begin + scores.shape[1])
            for at, row in enumerate(scores, first):
                allowed = (labels[span] == own_labels[at]) & (ids[span] != own[at])
                heaps[at].merge(row[allowed], ids[span][allowed])
        found = [
            (int(own[at]), int(numbers[at]), row, score) for at, heap in enumerate(heaps) for score, row in heap.rows()
        ]
        return _columns(found, POSITIVES)

    return cell


def _negatives(count, low, high):
    """For each positive of an anchor the best rows of other labels within its window, in one pair of blocks."""

    def cell(anchors, candidates):
        candidates = candidates.sort_by("id")
        ids, labels = _numbers(candidates, "id"), _numbers(candidates, "label")
        own, numbers, own_labels = (_numbers(anchors, name) for name in ("id", "number", "label"))
        positives = anchors.column("positives").to_pylist()
        heaps = [[BestRows(count) for _ in row] for row in positives]
        for first, begin, scores in tiles(anchors, candidates):
            span = slice(begin, begin + scores.shape[1])
            for at, row in enumerate(scores, first):
                allowed = (labels[span] != own_labels[at]) & (ids[span] != own[at])
                row, others = row[allowed], ids[span][allowed]
                for positive, heap in zip(positives[at], heaps[at]):
                    least, most = window(positive["score"], low, high)
                    within = (row >= least) & (row <= most)
                    heap.merge(row[within], others[within])
        found = [
            (int(own[at]), int(numbers[at]), positive["id"], positive["rank"], positive["score"], row, score)
            for at, lists in enumerate(heaps)
            for positive, heap in zip(positives[at], lists)
            for score, row in heap.rows()
        ]
        return _columns(found, NEGATIVES)

    return cell


def window(score, low, high):
    """The least and the highest whole score s with low * score <= 100 * s <= high * score."""
    return -(-low * score // 100), high * score // 100


def _paired(anchors, candidates, wide, high):
    """Blocks of both sides, each of the one next to each of the other."""
    left = anchors.select("*", F.explode(F.sequence(F.lit(0), F.lit(wide - 1))).alias("wide"))
    right = candidates.select("*", F.explode(F.sequence(F.lit(0), F.lit(high - 1))).alias("high"))
    return left.groupBy("wide", "high").cogroup(right.groupBy("wide", "high"))


def hard_negatives(
    anchors, rows, positives=5, negatives=5, low=80, high=100, anchor_block=2048, row_block=16384
):
    """For each anchor and each of its best `positives` rows of the same label, the best `negatives` rows of other
    labels whose score is from `low` to `high` percent of the positive's.

    Both sides are rows (id, label, weights) as `quantised` makes them. Returns anchor_id, positive_id, rank (from 1),
    negative_id, positive_score, negative_score.
    """
    number = F.xxhash64("label", "weights")
    anchors = kept(anchors.dropDuplicates(["id", "label", "weights"]).withColumn("number", number), "anchors")
    wide, tall = blocks(rows.count(), row_block), blocks(anchors.count(), anchor_block)
    # Dealt round robin, so that repeated ids spread like others.
    dealt = rows.withColumn("wide", F.pmod(F.monotonically_increasing_id(), F.lit(wide)).cast("int"))
    anchors = anchors.withColumn("high", F.pmod(F.xxhash64("id", "number"), F.lit(tall)).cast("int"))
    best = Window.partitionBy("anchor_id", "anchor_no").orderBy(F.desc("positive_score"), "positive_id")
    found = (
        _paired(anchors, dealt, wide, tall)
        .applyInArrow(_positives(positives), POSITIVES)
        .withColumn("positive_rank", F.row_number().over(best))
        .where(F.col("positive_rank") <= positives)
        .groupBy(F.col("anchor_id").alias("id"), F.col("anchor_no").alias("number"))
        .agg(
            F.collect_list(
                F.struct(
                    F.col("positive_id").alias("id"),
                    F.col("positive_score").alias("score"),
                    F.col("positive_rank").alias("rank"),
                )
            ).alias("positives")
        )
    )
    judged = anchors.join(found, ["id", "number"])
    first = Window.partitionBy("anchor_id", "anchor_no", "positive_rank").orderBy(F.desc("negative_score"), "negative_id")
    return (
        _paired(judged, dealt, wide, tall)
        .applyInArrow(_negatives(negatives, low, high), NEGATIVES)
        .withColumn("rank", F.row_number().over(first))
        .where(F.col("rank") <= negatives)
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
