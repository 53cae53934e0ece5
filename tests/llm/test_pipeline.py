"""The stages in turn over small tables, each against its own input."""

from __future__ import annotations

import re
from collections import defaultdict

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from tests.llm.test_op8_near_dedup import brute
from tickloom.llm import op6_toxicity
from tickloom.llm.op3_mixing import targets
from tickloom.session import written

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """What goes into each stage and comes out, with a column that clashes with names inside."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    more = spark.createDataFrame(
        [(None, "null id", "en", "src0", 7), (90_000, None, "en", None, None), (90_001, "", "en", "src1", 0)],
        docs.schema,
    )
    now = docs.unionByName(more).withColumn("class", F.lit("kept"))
    found = {}
    for name, stage in pipeline.STAGES:
        out = written(stage(spark, now, SMALL), f"test-{name}")
        found[name] = (now, out)
        now = out
    return found


def test_the_stages():
    assert [name for name, _ in pipeline.STAGES] == ["toxicity", "near_dedup", "surrogates", "mixing", "tokens"]
    assert pipeline.PIPELINE_QUERIES == {"pipeline": pipeline.run}


def test_columns_are_kept(stages):
    for before, after in list(stages.values())[:-1]:
        assert before.columns == after.columns


def test_toxic_documents_go(spark, stages):
    before, after = stages["toxicity"]
    model = op6_toxicity.fit(before.select("doc_id", "text"), spark.read.parquet(f"{SMALL}/labels.parquet"))
    low = before.withColumn("p", op6_toxicity.score(F.col("text"), model, spark)).filter("p < 0.5").drop("p")
    assert sorted(map(repr, low.collect())) == sorted(map(repr, after.collect()))
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    left = {r.doc_id for r in after.collect()}
    clean = [i for i, y in labels.items() if y == 0]
    assert sum(i in left for i in clean) >= 0.97 * len(clean)


def test_one_document_of_each_group_stays(stages):
    before, after = stages["near_dedup"]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    kept = {i for i, _, home in brute(rows, pipeline.WORDS_OF_SHINGLE) if i == str(home) or home is None}
    assert sorted(str(r.doc_id) for r in after.collect()) == sorted(kept)


def test_repeated_rows_stay_once(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (1, "other words"), (2, "A b c d e f"), (None, "x"), (None, "x"), (3, None), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(str, (tuple(r) for r in pipeline.near_dedup(spark, docs, SMALL).collect())))
    want = [(1, "a b c d e f"), (1, "other words"), (None, "x"), (None, "x"), (3, None), (3, None)]
    assert got == sorted(map(str, want))


def test_personal_data_is_replaced(stages):
    before, after = stages["surrogates"]
    old = {r.doc_id: r.text for r in before.collect()}
    for r in after.collect():
        assert r.n_chars == (None if r.text is None else len(r.text))
        for found in re.findall(r"[\w.]+@[\w.]+\w|(?<!\d)\d{16}(?!\d)", old[r.doc_id] or ""):
            assert found not in r.text


def test_sources_come_to_their_targets(stages):
    before, after = stages["mixing"]
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    have, taken, times = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in before.collect():
        have[r.source] += size(r.text)
    for r in after.collect():
        taken[r.source] += size(r.text)
        times[r.doc_id] += 1
    goal = targets(dict(have), (5.0, 2.0, 1.0), 1.5, 2)
    assert max(times.values()) <= 2
    assert all(abs(taken[s] - goal[s]) <= max(0.06 * goal[s], 150) for s in goal)  # about ten documents each


def test_tokens_are_those_of_the_library(stages):
    before, after = stages["tokens"]
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = sorted((str(r.doc_id), library.encode(r.text or ""), len(r.text or "")) for r in before.collect())
    got = sorted((str(r.doc_id), r.ids, r.decoded_chars) for r in after.collect())
    assert got == want and all(r.n_pieces == len(r.ids) for r in after.collect())
