"""Exact Jaccard join of documents by word shingles, as a join in a metric space.

The Jaccard distance of sets is a metric. Pivots here are the sets of a single shingle: almost all documents
are at distance 1 from each other, so pivots taken from the documents would tell none apart, while a document is closer
than 1 to just the pivots of its own shingles. These are taken in one global order, rare ones first. A document lies in
the region of its first pivot, and windows copy it into those of the next ones: if y avoids the first k pivots of x, then
x has no point in common with y beyond the rest of x, which is at distance k / |x|, and by the triangle inequality y is
no closer than that. So past k > r |x| pivots no more copies are needed, and two documents within the radius r
share a region.

The order needs the frequencies of shingles. They are counted only among the smallest hashes of each document,
a share SKETCH of its shingles and LEAST_SKETCH at least: two linked documents have enough of those in common that the rarer ones of them are
still certain to meet (`_sketch_size`, `_window_size`).

Sizes are one more pivot: as the distance to the empty set tells nothing, the triangle inequality is taken for the
number of shingles itself, 1 - |x| / |y| <= d(x, y). Regions are cut into bands of sizes, and a document goes to its own band
and the next.

Regions that share documents are joined together as long as they stay small: each document is then sent to one
place only. Larger clusters are cut into blocks, those of one region side by side. Blocks are joined within themselves, and
a few nodes of each component found are joined too. Then blocks are cut once more by the components known; of those, each
two blocks that share a region meet, but for blocks of one and the same component. Within a place some sets are hubs that take
all that are near them, and a matrix product measures all pairs that may still join two components; what leaves a place is
at most one link for each document. Equal sets are one node from the start.

Defined results
* Words are cut at space, tab to carriage return, and A-Z are lower-cased. With fewer words than a shingle has, the
  sequence of all is the one shingle. Without words, or with a null text, a document has none and links with nothing.
* Repeated rows link with each other if they have words. Rows with a null id take part, but are never named by a
  component; one without a named document has a null component.
* Shingles and sets are told apart by 64-bit hashes.
"""

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallycard.llm.components import components
from tallycard.llm.tables import blocks, kept, release, slices, text_of

# Defaults: words of a shingle, and two documents link if 100 * intersection >= percent * union.
SHINGLE = 4
PERCENT = 85
# By how many more percent of its shingles than it may lack a document is compared for candidates.
SKETCH = 10
# Smaller sets are compared by all of their shingles: by a few, each would be copied to the pivots of common passages.
LEAST_SKETCH = 32
# What one place takes: shingles, and documents, as each counts for so many shingles at least.
MOST_SHINGLES = 1_500_000
LEAST_WEIGHT = 366
# Columns of the matrix at a time.
STRIPE = 2048
ROWS = 256
# Hubs go on while each takes one in so many of the sets left.
HUBS = 16
# Nodes of a known component that stand for it where components of different blocks meet.
STAND_INS = 8
SLICE_BYTES = 2 << 20
# Up to so many ids are broadcast.
BROADCAST_IDS = 1_000_000

_U = np.uint64


def _mix(values):
    values = (values ^ (values >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> _U(27))) * _U(0x94D049BB133111EB)
    return values ^ (values >> _U(31))


def shingle_sets(texts, size=SHINGLE):
    """The sorted distinct 64-bit hashes of the word shingles of each of an Arrow array of texts."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts).cast(pa.large_string()))
    coded = lists.flatten().dictionary_encode()
    words = coded.dictionary.to_pylist()
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    real = np.array([word != "" for word in words], dtype=bool)
    codes = coded.indices.to_numpy()
    offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    # Empty words, left by white space at either end, go.
    there = real[codes] if len(codes) else np.empty(0, dtype=bool)
    before = np.concatenate(([0], np.cumsum(there)))
    offsets, hashed = before[offsets], hashes[codes[there]] if len(codes) else np.empty(0, dtype=np.uint64)
    rolled = np.zeros(max(0, len(hashed) - size + 1), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for at in range(size):
            rolled = _mix(rolled * _U(0x9E3779B97F4A7C15) + hashed[at : at + len(rolled)])
        for begin, end in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            if end - begin >= size:
                yield np.unique(rolled[begin : end - size + 1])
            elif end > begin:
                short = np.array([end - begin], dtype=np.uint64)
                for word in hashed[begin:end]:
                    short = _mix(short * _U(0x9E3779B97F4A7C15) + word)
                yield short
            else:
                yield np.empty(0, dtype=np.uint64)


def _sketch_size(size, percent):
    """How many of its smallest hashes a set of this size is compared by; an array of sizes gives an array."""
    return np.minimum(size, np.maximum(LEAST_SKETCH, (100 - percent + SKETCH) * size // 100 + 2))


@lru_cache(maxsize=100_000)
def _shared(size, percent):
    """How many members the sketches of a set of this size and any linked one share at least.

    In a set that lacks m of the common shingles, the first (sketch - m) common ones are certainly in its sketch.
    """
    other = np.arange(-(-percent * size // 100), 100 * size // percent + 1)
    common = -(-percent * (size + other) // (100 + percent))
    found = [_sketch_size(n, percent) - n + common for n in (size, other)]
    return max(1, int(np.minimum(*found).min(initial=size)))


def _window_size(size, percent):
    """How many pivots a set of this size is copied to: by the rest alone it could not have enough in common."""
    return int(_sketch_size(size, percent)) - _shared(size, percent) + 1


def _as_long(values):
    return pa.array(values.view(np.int64))


def _sketching(size, percent):
    def task(batches):
        release()
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                sets = list(shingle_sets(part.column("text"), size))
                cut = [s[: _sketch_size(len(s), percent)] for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("text_hash"),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([_signature(s) for s in sets], pa.int64()),
                        pa.array([_window_size(len(s), percent) for s in sets], pa.int32()),
                        _lists(cut),
                    ],
                    names=["doc_id", "text_hash", "n_shingles", "node", "window", "sketch"],
                )

    return task


def _signature(hashes):
    """A set's hash; 0 for the empty set."""
    return np.uint64(xxhash.xxh3_64_intdigest(hashes.tobytes())).view(np.int64).item() if len(hashes) else 0


def _lists(sets):
    offsets = np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int32)
    flat = np.concatenate(sets) if sets else np.empty(0, dtype=np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), _as_long(flat))


def _texts(docs):
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_of()).alias("text_hash"), text_of().alias("text")
    )


def sketches(docs, size=SHINGLE, percent=PERCENT):
    """doc_id, text_hash, n_shingles, node (hash of the set), window, sketch (smallest hashes) of each document."""
    schema = "doc_id long, text_hash long, n_shingles long, node long, window int, sketch array<long>"
    return _texts(docs).mapInArrow(_sketching(size, percent), schema)


def _whole_sets(size):
    def task(batches):
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                sets = list(shingle_sets(part.column("text"), size))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_signature(s) for s in sets], pa.int64()), _lists(sets)],
                    names=["node", "shingles"],
                )

    return task


def regions(nodes, percent):
    """Rows (region, node, n_shingles): the windows of the nodes, for regions that two nodes and more share."""
    spare = F.size("sketch") - F.col("window")
    found = nodes.select("node", "n_shingles", spare.alias("spare"), F.explode("sketch").alias("pivot"))
    frequent = found.groupBy("pivot").agg(F.count(F.lit(1)).alias("frequency")).where("frequency > 1")
    shared = found.join(frequent, "pivot")
    # A node's pivots that are all its own come first, and are not among these rows.
    rare_first = Window.partitionBy("node").orderBy("frequency", "pivot")
    own = F.count(F.lit(1)).over(Window.partitionBy("node"))
    placed = shared.select(
        "pivot", "node", "n_shingles", "spare", own.alias("own"), F.row_number().over(rare_first).alias("nth")
    )
    # Sizes of linked nodes are in one band or in two that follow each other.
    band = F.floor(F.ln("n_shingles") / (1.0001 * math.log(100 / percent)))
    windows = placed.where(F.col("nth") + F.col("spare") <= F.col("own")).select(
        "pivot", "node", "n_shingles", F.explode(F.array(band, band + 1)).alias("band")
    )
    windows = windows.select(F.xxhash64("pivot", "band").alias("region"), "node", "n_shingles")
    windows = kept(windows, "jaccard-windows")
    met = windows.groupBy("region").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    return kept(windows.join(met.select("region"), "region"), "jaccard-regions")


def linked(sets, percent=PERCENT):
    """Links (position, position of the first of its component) among sets, as arrays of distinct hashes.

    One set after the other is a hub that takes all that are near it, as long as few hubs take many. Then a matrix has
    the pairs that may still join two components: those with a set that is neither a hub nor in the largest component.
    """
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, codes, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = counts[codes] > 1
    owner, codes = owner[shared], codes[shared]
    # Numbered anew, without those that a single set has.
    numbers = np.cumsum(counts > 1) - 1
    codes, wide = numbers[codes], int(numbers[-1]) + 1 if len(numbers) else 0
    root = np.full(len(sets), -1)
    is_hub = np.zeros(len(sets), dtype=bool)
    rest = np.arange(len(sets))
    while len(rest):
        hub = rest[0]
        own = np.zeros(wide, dtype=bool)
        own[codes[slice(*np.searchsorted(owner, (hub, hub + 1)))]] = True
        some = np.bincount(owner[own[codes]], minlength=len(sets))
        near = 100 * some >= percent * (sizes[hub] + sizes - some)
        near[hub] = is_hub[hub] = True
        known = np.unique(root[near & (root >= 0)])
        root[near | np.isin(root, known)] = known[0] if len(known) else hub
        before, rest = len(rest), np.flatnonzero(root < 0)
        if (before - len(rest)) * HUBS < before:
            break
    # Pairs within the largest component need no look, and those of hubs had one.
    root[rest] = rest
    largest = np.bincount(root).argmax() if len(root) else 0
    open_ = np.flatnonzero((root != largest) & ~is_hub)
    if len(open_):
        root = _joined(root, open_, _near_rest(sizes, owner, codes, wide, open_, percent))
    moved = np.flatnonzero(root != np.arange(len(sets)))
    return moved, root[moved]


def _near_rest(sizes, owner, codes, wide, rest, percent):
    """Which of all sets (columns) are near those at the positions `rest` (rows)."""
    if len(rest) < len(sizes) < 2 * len(rest):
        # The product of a matrix with itself takes half the time of one with another.
        return _near_rest(sizes, owner, codes, wide, np.arange(len(sizes)), percent)[rest]
    order = np.argsort(codes, kind="stable")
    owner, codes = owner[order], codes[order]
    row = np.full(len(sizes), -1)
    row[rest] = np.arange(len(rest))
    common = np.zeros((len(rest), len(sizes)), dtype=np.float32)
    for start in range(0, wide, STRIPE):
        low, high = np.searchsorted(codes, (start, start + STRIPE))
        columns, which = np.unique(owner[low:high], return_inverse=True)
        stripe = np.zeros((len(columns), min(STRIPE, wide - start)), dtype=np.float32)
        stripe[which, codes[low:high] - start] = 1
        if len(rest) == len(columns) == len(sizes):
            common += stripe @ stripe.T
        elif len(rest) == len(sizes):
            common[np.ix_(columns, columns)] += stripe @ stripe.T
        else:
            rows = row[columns]
            common[np.ix_(rows[rows >= 0], columns)] += stripe[rows >= 0] @ stripe.T
    near = np.empty(common.shape, dtype=bool)
    # A few rows at a time, as whole numbers of 64 bits take more than the matrix.
    for start in range(0, len(rest), ROWS):
        some = common[start : start + ROWS].astype(np.int64)
        either = sizes[rest[start : start + ROWS], None] + sizes[None, :] - some
        near[start : start + ROWS] = 100 * some >= percent * either
    return near


def _joined(root, rest, near):
    """`root` (each position's first of its component) when also those at `rest` (rows) are linked with those near them."""
    points, point = np.unique(root, return_inverse=True)
    order = np.argsort(point, kind="stable")
    near = np.logical_or.reduceat(near[:, order], np.searchsorted(point[order], np.arange(len(points))), axis=1)
    order = np.argsort(point[rest], kind="stable")
    which, start = np.unique(point[rest][order], return_index=True)
    among = np.eye(len(points), dtype=bool)
    among[which] |= np.logical_or.reduceat(near[order], start, axis=0)
    moved, roots = _hung(among | among.T)
    first = points.copy()
    first[moved] = points[roots]
    return first[point]


def _hung(near):
    """Each position's smallest reachable position, for a symmetric matrix of links; only where it is another."""
    root = np.full(len(near), -1)
    for start in range(len(near)):
        if root[start] >= 0:
            continue
        front = np.array([start])
        root[start] = start
        while len(front):
            found = np.flatnonzero(near[front].any(axis=0) & (root < 0))
            root[found] = start
            front = found
    moved = np.flatnonzero(root != np.arange(len(near)))
    return moved, root[moved]


def _joining(percent):
    def bin_(_, table):
        """Links within each place of a bin."""
        table = table.sort_by([("place", "ascending"), ("part", "ascending"), ("node", "ascending")])
        place, part, node = [table.column(name).to_numpy() for name in ("place", "part", "node")]
        cuts = np.flatnonzero((np.diff(place) != 0) | (np.diff(part) != 0)) + 1
        lists = table.column("shingles").combine_chunks()
        offsets = lists.offsets.to_numpy()
        values = lists.values.to_numpy(zero_copy_only=False)
        left, right = [], []
        for begin, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(node)]):
            own, first = np.unique(node[begin:end], return_index=True)
            if len(own) < 2:
                continue
            sets = [values[offsets[begin + at] : offsets[begin + at + 1]] for at in first.tolist()]
            moved, roots = linked(sets, percent)
            left.append(own[moved])
            right.append(own[roots])
        empty = np.empty(0, dtype=np.int64)
        return pa.table(
            [pa.array(np.concatenate(left) if left else empty), pa.array(np.concatenate(right) if right else empty)],
            names=["a", "b"],
        )

    return bin_


def _join_places(members, sets, percent):
    """Links (a, b) within places: `members` are rows (place, part, node, n_shingles), `sets` (node, shingles).

    Places are put into bins at random, of about MOST_SHINGLES each.
    """
    members = kept(members, "jaccard-members")
    weight = members.agg(F.sum("n_shingles")).first()[0] or 0
    bins = blocks(weight, MOST_SHINGLES)
    placed = members.select(
        "place", "part", "node", F.pmod(F.xxhash64("place", "part"), F.lit(bins)).cast("int").alias("bin")
    )
    rows = placed.join(sets, "node")
    return kept(rows.groupBy("bin").applyInArrow(_joining(percent), "a long, b long"), "jaccard-links")


def _weight():
    return F.greatest(F.col("n_shingles"), F.lit(LEAST_WEIGHT))


def _sets_of(docs, wanted, size):
    """(node, shingles) once for each wanted node. `wanted` are rows (node, doc_id, named) with one document of each."""
    ids = wanted.select("doc_id").distinct()
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    texts = _texts(docs)
    ids = ids.withColumnRenamed("doc_id", "wanted_id")
    texts = texts.join(ids, F.col("doc_id").eqNullSafe(F.col("wanted_id")), "left_semi").select("text")
    whole = texts.mapInArrow(_whole_sets(size), "node long, shingles array<long>")
    return whole.join(wanted.select("node"), "node", "left_semi").dropDuplicates(["node"])


def node_links(docs, rows, size, percent):
    """Links (a, b) between nodes that connect all that is within the radius. `rows` are the stored `sketches`."""
    nodes = rows.where(F.col("n_shingles") > 0).dropDuplicates(["node"])
    shared = regions(nodes, percent)
    hubs = shared.groupBy("region").agg(F.min("node").alias("b"))
    clusters = components(shared.join(hubs, "region").select(F.col("node").alias("a"), "b"), "jaccard-clusters")
    own = shared.select("node", "n_shingles").distinct().join(clusters, "node")
    own = kept(own.withColumnRenamed("root", "cluster"), "jaccard-clustered")
    docs_of = rows.groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    sets = kept(_sets_of(docs, docs_of.join(own.select("node"), "node", "left_semi"), size), "jaccard-sets")
    sizes = kept(own.groupBy("cluster").agg(F.sum(_weight()).alias("weight")), "jaccard-cluster-sizes")
    small = own.join(sizes.where(F.col("weight") <= MOST_SHINGLES), "cluster")
    links = _join_places(
        small.select(F.col("cluster").alias("place"), F.lit(0).alias("part"), "node", "n_shingles"), sets, percent
    )
    large = sizes.where(F.col("weight") > MOST_SHINGLES).select("cluster")
    if not large.limit(1).count():
        return links
    return links.unionByName(_large_links(own.join(large, "cluster"), shared, sets, percent))


def _blocks(rows, *order):
    """Adds `block`: consecutive nodes of a cluster with at most half of what fits, as two blocks meet in a place."""
    beside = Window.partitionBy("cluster").orderBy(*order, "node")
    so_far = F.sum(_weight()).over(beside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return rows.withColumn("block", F.floor(so_far / (MOST_SHINGLES // 2)).cast("int"))


def _parts(rows):
    return rows.select(F.col("cluster").alias("place"), F.col("block").alias("part"), "node", "n_shingles")


def _large_links(own, shared, sets, percent):
    """Links within clusters that are too large for one place: rows (cluster, node, n_shingles)."""
    first = shared.groupBy("node").agg(F.min("region").alias("first"))
    own = kept(own.join(first, "node"), "jaccard-large")
    near = _join_places(_parts(_blocks(own, "first")), sets, percent)
    # Blocks of one component are not compared any more, so first those of different blocks are joined by a few nodes.
    known = own.join(components(near, "jaccard-known"), "node")
    nth = F.row_number().over(Window.partitionBy("cluster", "root").orderBy("node"))
    standing = kept(known.withColumn("nth", nth).where(F.col("nth") <= STAND_INS), "jaccard-stand-ins")
    near = near.unionByName(_join_places(_parts(_blocks(standing, "first")), sets, percent))
    known = components(near, "jaccard-known")
    rooted = own.join(known, "node", "left").withColumn("root", F.coalesce("root", "node"))
    rooted = kept(_blocks(rooted, "root", "first"), "jaccard-blocks")
    held = kept(
        rooted.groupBy("cluster", "block").agg(F.min("root").alias("least"), F.max("root").alias("most")),
        "jaccard-block-roots",
    )
    met = shared.select("region", "node").join(rooted.select("node", "cluster", "block"), "node")
    met = kept(met.select("cluster", "region", "block").distinct(), "jaccard-block-regions")
    one, two = met.alias("one"), met.alias("two")
    pairs = one.join(
        two,
        (F.col("one.cluster") == F.col("two.cluster"))
        & (F.col("one.region") == F.col("two.region"))
        & (F.col("one.block") <= F.col("two.block")),
    ).select(F.col("one.cluster").alias("cluster"), F.col("one.block").alias("low"), F.col("two.block").alias("high"))
    low = held.select("cluster", F.col("block").alias("low"), "least", "most")
    high = held.select(
        "cluster", F.col("block").alias("high"), F.col("least").alias("high_least"), F.col("most").alias("high_most")
    )
    pairs = pairs.distinct().join(low, ["cluster", "low"]).join(high, ["cluster", "high"])
    same = (F.col("least") == F.col("most")) & (F.col("high_least") == F.col("high_most")) & (
        F.col("least") == F.col("high_least")
    )
    meetings = pairs.where(~same).select(
        "cluster",
        F.xxhash64("cluster", "low", "high").alias("place"),
        F.explode(F.array_distinct(F.array("low", "high"))).alias("block"),
    )
    members = rooted.join(meetings, ["cluster", "block"])
    across = _join_places(members.select("place", F.lit(1).alias("part"), "node", "n_shingles"), sets, percent)
    return near.unionByName(across)


def _named(docs, size, percent):
    """The stored sketches with `root` and `component_id`."""
    rows = kept(sketches(docs, size, percent), "jaccard-sketches")
    roots = components(node_links(docs, rows, size, percent), "jaccard-components")
    nodes = rows.where(F.col("n_shingles") > 0).groupBy("node").agg(F.min("doc_id").alias("least"))
    rooted = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    rooted = kept(rooted, "jaccard-rooted")
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows.drop("sketch", "window").join(rooted.join(named, "root"), "node", "left")


def classes(docs, size=SHINGLE, percent=PERCENT):
    """doc_id, n_shingles, component_id of each document: the smallest id that links lead to."""
    named = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return _named(docs, size, percent).select("doc_id", "n_shingles", named.alias("component_id"))


def one_of_each(docs, size=5, percent=80):
    """The rows of `docs` with the smallest id of their component, one row of each; and all without words."""
    rows = _named(docs, size, percent).where(F.col("n_shingles") > 0)
    least = rows.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    chosen = least.groupBy("root").agg(F.min("text_hash").alias("hash"))
    # Rows of one id that differ in text may be in one component; then one text stays.
    stay = least.join(chosen, (least.root == chosen.root) & (least.text_hash == chosen.hash)).groupBy(
        F.col("doc_id").alias("id"), "hash"
    ).agg(F.count(F.lit(1)).alias("copies"))
    stay = kept(stay, "jaccard-stay")
    if stay.count() <= BROADCAST_IDS:
        stay = F.broadcast(stay)
    texts = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.xxhash64("text") == F.col("hash"))
    found = texts.join(stay, same).select("row", "id", "hash", "copies")
    once = found.where("copies = 1").unionByName(found.where("copies > 1").dropDuplicates(["id", "hash"]))
    bare = texts.where(~F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return once.select("row.*").unionByName(bare.select("row.*"))
