"""The registered queries of the training-data operators, and the digests they return."""

import public_tokenizers
from pyspark.sql import functions as F

from tallycard import session
from tallycard.llm import alignment, chat, jaccard, negatives, packing, permutations, pieces, quality, repeats, token_counts, topk, toxicity, urls
from tallycard.llm.tables import table

_REGISTRY = {}


def _query(function):
    def run(spark, folder):
        session.ship(spark)
        return function(spark, folder)

    _REGISTRY[function.__name__] = run
    return function


def queries():
    return dict(_REGISTRY)


@_query
def op1_quality_rules(spark, folder):
    judged = quality.judged(table(spark, folder, "documents").select("doc_id", "text", "lang"))
    return judged.select("row.doc_id", *[name for name in judged.columns if name != "row"])


@_query
def op2_topk_search(spark, folder):
    """The 10 best other vectors for each whose id is divisible by 100."""
    vectors = topk.quantised(table(spark, folder, "embeddings"))
    return topk.top_k(vectors.where(F.col("id") % 100 == 0), vectors, 10)


@_query
def op3_token_counts(spark, folder):
    docs = table(spark, folder, "documents")
    counted = token_counts.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 1024)


@_query
def op4_toxicity(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scored = toxicity.scored(docs, toxicity.train(docs, table(spark, folder, "labels")))
    return scored.select(
        "row.doc_id",
        toxicity.held_out("row.doc_id").alias("held_out"),
        "score",
        toxicity.predicted().alias("predicted"),
    )


@_query
def op5_best_fit_packing(spark, folder):
    docs = table(spark, folder, "documents")
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


@_query
def op6_suffix_array_dedup(spark, folder):
    return repeats.digests(repeats.repeated(table(spark, folder, "documents")))


@_query
def op7_url_filter(spark, folder):
    return urls.judge(table(spark, folder, "pages"))


@_query
def op8_ngram_jaccard_join(spark, folder):
    return jaccard.classes(table(spark, folder, "documents"))


@_query
def op9_sentencepiece_nbest(spark, folder):
    return pieces.encode(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@_query
def op10_chat_formatting(spark, folder):
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], turns.schema)
    return chat.digest(chat.examples(turns.unionByName(extra)))


@_query
def op11_token_alignment(spark, folder):
    paths = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    aligned = alignment.align(table(spark, folder, "documents"), *paths, keep=["doc_id"])
    written = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise("")
    found = alignment.with_counts(aligned.withColumn("groups_sha256", written).drop("groups"))
    return found.select("row.doc_id", *[name for name in found.columns if name != "row"])


@_query
def op12_nearest_neighbours(spark, folder):
    """The 20 nearest other vectors for each whose id is divisible by 20."""
    rows = permutations.usable(table(spark, folder, "embeddings"))
    return permutations.neighbours(rows.where(F.col("id") % 20 == 0), rows, 20)


@_query
def op13_hard_negatives(spark, folder):
    """Rows whose id is divisible by 7 have the next label; anchors are those whose id is divisible by 100."""
    label = F.col("label").cast("bigint")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    rows = negatives.quantised(table(spark, folder, "embeddings").withColumn("label", moved))
    return negatives.hard_negatives(rows.where(F.col("id") % 100 == 0), rows)
