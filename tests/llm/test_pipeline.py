import importlib
import struct
import sys
import zlib

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from tallycard.llm import toxicity
from tallycard.llm.tables import table

from conftest import DATA
from test_jaccard import brute as components
from test_quality import brute as counts
from test_repeats import brute as repeats


@pytest.fixture(scope="module")
def stages(spark):
    """The output of each stage over the smallest tables, from the input on."""
    docs = table(spark, DATA, "documents")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        rows = stage(spark, docs, DATA)
        docs = spark.createDataFrame(rows.collect(), rows.schema)
        out.append(docs)
    return out


def by_id(rows):
    return {row["doc_id"]: row["text"] for row in rows.collect()}


def test_stages_keep_the_columns(stages):
    assert [docs.columns for docs in stages[:5]] == [stages[0].columns] * 5
    assert stages[5].columns[:5] == ["doc_id", "piece", "start", "length", "ids_crc32"]


def test_each_stage_does_what_its_operator_says(spark, stages):
    docs, polite, good, single, cut, packed = stages
    model = toxicity.train(docs, table(spark, DATA, "labels"))
    scores = toxicity.scored(docs, model).where(toxicity.predicted() == 0).select("row.doc_id")
    assert sorted(by_id(polite)) == sorted(row["doc_id"] for row in scores.collect())
    assert set(by_id(good)) <= {n for n, text in by_id(polite).items() if not counts(text)[-1]}
    named = components(list(by_id(good).items()), 5, 80)
    assert sorted(by_id(single)) == sorted(n for n, size, least in named if not size or n == least)
    flags, texts = repeats(list(by_id(single).items())), by_id(cut)
    assert sorted(texts) == sorted(flags)
    for n, (raw, gone) in flags.items():
        if not any(gone):
            assert texts[n] == raw.decode()
        else:
            assert len(raw) - sum(gone) <= len(texts[n].encode()) < len(raw)
    assert {row["doc_id"] for row in packed.collect()} == set(texts)
    # The tokens are there, each sequence without a gap.
    sequences = {}
    for row in packed.collect():
        assert len(row["ids"]) == row["length"] and zlib.crc32(struct.pack(f"<{row['length']}I", *row["ids"])) == row["ids_crc32"]
        sequences.setdefault(row["sequence_id"], []).append((row["offset"], row["length"]))
    for places in sequences.values():
        assert sum(length for _, length in places) <= 2048
        ends = [0, *(offset + length for offset, length in sorted(places))]
        assert [offset for offset, _ in sorted(places)] == ends[:-1]


def test_run_is_the_stages_one_after_the_other(spark, stages):
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    found = corpus_pipeline.run(spark, DATA).select(*columns)
    assert found.exceptAll(stages[5].select(*columns)).count() == 0
    assert found.count() == stages[5].count()


def test_empty_tables_pass_through(spark):
    docs = table(spark, DATA, "documents").where(F.lit(False))
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, DATA)
        assert out.count() == 0
        docs = out if "text" in out.columns else docs


def test_all_queries_are_registered():
    names = set(__spark_entry__.queries())
    assert {name.split("_")[0] for name in names if name.startswith("op")} == {
        f"op{n}" for n in range(1, 14)
    }
    assert "pipeline" in names
    assert set(__spark_entry__.oracle_sql()) <= names


def test_the_rest_works_without_these_operators(monkeypatch):
    monkeypatch.setitem(sys.modules, "tallycard.llm", None)
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    try:
        entry = importlib.reload(__spark_entry__)
        assert not any(name.startswith("op") or name == "pipeline" for name in entry.queries())
    finally:
        monkeypatch.undo()
        importlib.reload(__spark_entry__)
