"""Exact top-k search by exhaustive term-at-a-time accumulation.

Rows are sparse vectors: an id, the terms (dimensions) with a weight, and the weights as whole numbers. The
candidates are dealt into blocks of bounded size, the queries likewise, and each block of queries meets each
block of candidates once. There a query's terms, one after the other, scatter their weighted postings into a
dense array with one score per candidate; the best k are selected by partition. A window merges the blocks'
winners. Nothing is pruned, so the result is exact.

Defined results
* A vector that is null, or has null or non-finite components, takes no part; nor has a row with a null id.
* Components a vector lacks count as 0, so vectors of different or no length are comparable.
* Ties go to the smaller id. Rows that repeat an id are candidates of their own, but none for a query with that
  id. Equal query rows give one result; different vectors under one query id give one result each.
* A component beyond the range of BIGINT takes the end of the range, and so does a score in the output.
* An empty table gives an empty result.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallycard.llm.tables import blocks

SCORES = "query_id long, query_no long, vec_id long, score long"


def quantised(vectors, scale=1024, row_id="vec_id", vector="embedding"):
    """Sparse rows (id, terms, weights) of floor(scale * component), in the order of the dimensions."""
    usable = F.col("id").isNotNull() & F.col("v").isNotNull() & ~F.exists(
        "v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    )
    rows = vectors.select(F.col(row_id).cast("bigint").alias("id"), F.col(vector).alias("v")).where(usable)
    filled = F.filter(
        F.transform("v", lambda x, i: F.struct(i.alias("term"), _whole(x, scale).alias("weight"))),
        lambda posting: posting["weight"] != 0,
    )
    return rows.select("id", filled.alias("postings")).select(
        "id", F.col("postings.term").alias("terms"), F.col("postings.weight").alias("weights")
    )


def _whole(component, scale):
    return F.floor(component.cast("double") * F.lit(float(scale))).cast("bigint")


def _flat(column):
    """Values of a list column and the row of each."""
    lists = column.combine_chunks()
    lengths = np.diff(lists.offsets.to_numpy())
    return lists.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(lists)), lengths)


def _postings(table):
    """Inverted lists of a block: term -> (rows, weights)."""
    terms, rows = _flat(table.column("terms"))
    weights, _ = _flat(table.column("weights"))
    order = np.argsort(terms, kind="stable")
    terms, rows, weights = terms[order], rows[order], weights[order]
    cuts = np.flatnonzero(np.diff(terms)) + 1
    firsts = np.concatenate(([0], cuts)) if len(terms) else []
    lists = zip(np.split(rows, cuts), np.split(weights, cuts))
    return {int(terms[at]): posting for at, posting in zip(firsts, lists)}


def best(scores, k, allowed):
    """Positions of the k highest scores among the allowed ones, ties to the front, in no special order."""
    where = np.flatnonzero(allowed)
    if len(where) <= k:
        return where
    held = scores[where]
    bound = np.partition(held, len(held) - k)[len(held) - k]
    above = where[held > bound]
    return np.concatenate((above, where[held == bound][: k - len(above)]))


def _search(k):
    def cell(queries, candidates):
        candidates = candidates.sort_by("id")
        ids = candidates.column("id").to_numpy()
        postings = _postings(candidates)
        size = len(ids)
        widest = max((int(np.abs(w.astype(object)).max()) for _, w in postings.values()), default=0)
        found = []
        for query, number, terms, weights in zip(
            *(queries.column(name).to_pylist() for name in ("id", "number", "terms", "weights"))
        ):
            # Whole numbers of any size where 64 bits might not hold a sum.
            small = widest * sum(abs(weight) for weight in weights) < 2**62
            scores = np.zeros(size, dtype=np.int64 if small else object)
            for term, weight in zip(terms, weights):
                if term in postings:
                    rows, values = postings[term]
                    scores[rows] += weight * values.astype(scores.dtype, copy=False)
            for at in best(scores, k, ids != query):
                score = min(max(int(scores[at]), -(2**63)), 2**63 - 1)
                found.append((query, number, int(ids[at]), score))
        columns = list(zip(*found)) if found else [[], [], [], []]
        return pa.table(
            [pa.array(column, pa.int64()) for column in columns],
            names=["query_id", "query_no", "vec_id", "score"],
        )

    return cell


def top_k(queries, candidates, k=10, query_block=2048, candidate_block=16384):
    """The k candidates with the highest inner product for each query: query_id, rank, vec_id, score.

    Both sides are rows (id, terms, weights) as `quantised` makes them.
    """
    queries = queries.dropDuplicates(["id", "terms", "weights"])
    n_queries, n_candidates = queries.count(), candidates.count()
    wide, high = blocks(n_candidates, candidate_block), blocks(n_queries, query_block)
    # Dealt round robin, so that repeated ids spread like others.
    dealt = F.pmod(F.monotonically_increasing_id(), F.lit(wide)).cast("int")
    left = queries.select(
        "*",
        F.xxhash64("terms", "weights").alias("number"),
        F.pmod(F.xxhash64("id", "terms", "weights"), F.lit(high)).cast("int").alias("high"),
        F.explode(F.sequence(F.lit(0), F.lit(wide - 1))).alias("wide"),
    )
    right = candidates.select(
        "*", dealt.alias("wide"), F.explode(F.sequence(F.lit(0), F.lit(high - 1))).alias("high")
    )
    cells = left.groupBy("wide", "high").cogroup(right.groupBy("wide", "high"))
    scored = cells.applyInArrow(_search(k), SCORES)
    ranked = Window.partitionBy("query_id", "query_no").orderBy(F.desc("score"), "vec_id")
    return (
        scored.withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
