"""The pipeline stage by stage against brute force, on the smallest tables."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from tests.llm.conftest import prose
from tests.llm.test_dedup import brute_classes, brute_removed
from tidewatch.llm import repeats

DOCUMENT = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def test_stages(spark, sf_dir):
    stages = dict(pipeline.STAGES)
    assert [name for name, _ in pipeline.STAGES] == ["toxicity", "quality", "near_duplicates", "repeats", "packing"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, size = docs.columns, docs.count()
    for name in ("toxicity", "quality"):
        docs = spark.createDataFrame(stages[name](spark, docs, sf_dir).collect(), DOCUMENT)
        assert docs.columns == columns and 0 < docs.count() < size + 1
        size = docs.count()

    rows = [(r.doc_id, r.text) for r in docs.collect()]
    classes = brute_classes(rows)
    docs = spark.createDataFrame(stages["near_duplicates"](spark, docs, sf_dir).collect(), DOCUMENT)
    assert docs.columns == columns and sorted(r.doc_id for r in docs.collect()) == sorted(set(classes))

    before = {r.doc_id: r.text for r in docs.collect()}
    order = sorted(before)
    exact = dict(zip(order, brute_removed([before[i] for i in order])))
    cut = stages["repeats"](spark, docs, sf_dir)
    assert cut.columns == columns
    after = cut.collect()
    assert len(after) == len(before)
    for r in after:
        assert r.n_chars == len(r.text) and len(exact[r.doc_id][2]) - 6 * exact[r.doc_id][1] <= len(r.text.encode()) <= len(exact[r.doc_id][2])
        assert exact[r.doc_id][1] or r.text == before[r.doc_id]

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    packed = stages["packing"](spark, spark.createDataFrame(after, DOCUMENT), sf_dir).collect()
    held = {}
    for p in packed:
        held[p.doc_id] = held.get(p.doc_id, 0) + p.length
    assert held == {r.doc_id: len(library.encode(r.text, add_special_tokens=False).ids) + 1 for r in after}
    assert sum(r.length for r in pipeline.run(spark, sf_dir).collect()) == sum(held.values())


def test_awkward_documents_pass_every_stage(spark, sf_dir):
    rng = random.Random(22)
    texts = [None, None, "", "", " ", "!!!", prose(rng, 30_000), "é" * 400, "copy of a text here", "copy of a text here"]
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)] + [(None, "no id at all", "en", "s", 3), (8, texts[8], "en", "s", 1), (8, texts[8], "en", "s", 1)]
    docs = spark.createDataFrame(rows, DOCUMENT)
    for empty in (False, True):
        table = docs.where("false") if empty else docs
        for name, stage in pipeline.STAGES[:-1]:
            table = spark.createDataFrame(stage(spark, table, sf_dir).collect(), DOCUMENT)
            assert empty == (table.count() == 0), name
        kept = table.collect()
        assert empty or sorted(r.doc_id for r in kept if r.doc_id is not None) == [0, 4, 5, 6, 7, 8]
        assert sum(p.length for p in pipeline.STAGES[-1][1](spark, table, sf_dir).collect()) >= len(kept)


def test_own_columns_stay_in_filtering_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(40).selectExpr(
        "*", "doc_id + 0.5 AS Score", "doc_id AS _text", "doc_id AS spans", "doc_id AS kept", "doc_id AS marks"
    )
    for name in ("toxicity", "quality", "repeats"):
        got = dict(pipeline.STAGES)[name](spark, docs, sf_dir)
        assert got.columns == docs.columns
        rows = got.collect()
        assert rows and all((r.Score, r._text, r.spans, r.kept, r.marks) == (r.doc_id + 0.5, *[r.doc_id] * 4) for r in rows)


def test_widened_runs_hold_whole_characters():
    data = "aé日b".encode()  # a, two bytes, three bytes, b
    for start in range(len(data)):
        for end in range(start + 1, len(data) + 1):
            s, e = repeats.to_characters(data, np.array([start]), np.array([end]))
            assert s[0] <= start and e[0] >= end
            data[: s[0]].decode(), data[e[0] :].decode()
    s, e = repeats.to_characters(data, np.array([1, 2]), np.array([2, 4]))
    assert (s.tolist(), e.tolist()) == ([1], [6])


def test_texts_reach_the_workers_in_small_batches(spark):
    """A partition of many long texts is not one batch; a session's own size of batches stays."""
    docs = spark.range(0, 5000, 1, 1).selectExpr("id AS doc_id", "repeat('word ', 1000) AS text")

    @pipeline.stage
    def bytes_of_batches(spark, docs, sf_dir):
        def run(batches):
            for batch in batches:
                yield pa.RecordBatch.from_pydict({"n": pa.array([batch.nbytes], pa.int64())})

        return docs.mapInArrow(run, "n bigint")

    own = spark.conf.get(pipeline.BATCH_BYTES, None)
    try:
        spark.conf.unset(pipeline.BATCH_BYTES)
        assert max(r.n for r in bytes_of_batches(spark, docs, "").collect()) < 2 * pipeline.MOST_BYTES
        spark.conf.set(pipeline.BATCH_BYTES, 1 << 20)
        assert max(r.n for r in bytes_of_batches(spark, docs, "").collect()) < 2 << 20
    finally:
        spark.conf.unset(pipeline.BATCH_BYTES)
        if own is not None:
            spark.conf.set(pipeline.BATCH_BYTES, own)
