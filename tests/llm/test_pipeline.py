"""The pipeline's stages on a small folder of tables, each held against a plain version of its operator's rule."""

from __future__ import annotations

from collections import Counter

import pytest

import corpus_pipeline
from lamina.llm import decontaminate, mixing, ngram_join, quality
from tests.llm.test_operators import DOCS, corpus


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    rows = corpus(4, 40)
    spark.createDataFrame(rows, DOCS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, " ".join(rows[2][1].split()[2:16])), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame([(d, int(len((t or "").split()) > 60), 0) for d, t, *_ in rows], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels, bench = spark.read.parquet(f"{folder}/labels.parquet"), spark.read.parquet(f"{folder}/benchmark.parquet")
    out = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, out[-1], folder).write.parquet(f"{folder}/stage-{k}")
        out.append(spark.read.parquet(f"{folder}/stage-{k}"))
    ids = [Counter(r.doc_id for r in d.collect()) for d in out]
    assert all(tuple(d.columns) == corpus_pipeline.COLUMNS for d in out[1:-1])
    trees = quality.train(docs, labels)
    assert ids[1] == Counter(r.doc_id for r in quality.judge_documents(docs, trees).collect() if r.kept)
    assert ids[2] == Counter(r.doc_id for r in ngram_join.duplicate_classes(out[1]).collect() if r.doc_id == r.component_id)
    hit = {r.doc_id for r in decontaminate.find_contamination(out[2], bench).collect() if r["items"]}
    assert hit and ids[3] == Counter({d: n for d, n in ids[2].items() if d not in hit})
    assert ids[4] == Counter({r.doc_id: r.copies for r in mixing.mix_documents(out[3]).collect() if r.copies})
    assert ids[5] == ids[4]
    sizes = Counter(r.shard for r in out[5].collect())
    assert max(sizes.values()) - min(sizes.values()) <= 1
    text = {r.doc_id: r.text for r in docs.collect()}
    assert all(text[r.doc_id] == r.text for r in out[5].collect())


def test_run_is_the_stages_in_turn(spark, folder):
    rows = corpus_pipeline.run(spark, folder).collect()
    assert rows and {"doc_id", "text", "shard", "slot"} <= set(rows[0].asDict())
    again = corpus_pipeline.run(spark, folder).collect()
    key = lambda r: (r.shard, r.slot, r.doc_id)
    assert sorted(map(key, rows)) == sorted(map(key, again))


def test_mix_of_rows_without_or_with_repeated_ids(spark):
    """Each source's words come near its target whatever ids its rows have, and each row takes the copies of its place."""
    text = lambda i, n: " ".join(f"t{i}x{k}" for k in range(n))
    rows = [(None, text(i, 20), "en", "a", i) for i in range(40)] + [(100 + i, text(i, 20), "en", "b", i) for i in range(40)]
    rows += [(7, text(i % 5, 30), "en", "c", i) for i in range(30)] + [(None, None, None, None, None)] * 3 + [(8, "", "en", "c", 0)] * 2
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    places = mixing.mix_documents(docs).collect()
    got = mixing.take_copies(docs)
    assert got.columns == docs.columns
    got = got.collect()
    words, target = Counter(), {p.source: p.target for p in places}
    for r in got:
        words[r.source] += len((r.text or "").split())
    for source in ("a", "b", "c"):
        assert abs(words[source] - target[source]) <= 30, (source, words, target)
    assert Counter((r.doc_id, r.source, len((r.text or "").split())) for r in got) == sum((Counter({(p.doc_id, p.source, p.size): p.copies}) for p in places), Counter())
    most = Counter((r.doc_id, r.source, r.text, r.n_chars) for r in got)
    assert max(most.values()) <= 3 * max(Counter(rows).values())
    again = Counter((r.doc_id, r.source, r.text) for r in mixing.take_copies(docs).collect())
    assert again == Counter((r.doc_id, r.source, r.text) for r in got)
    assert mixing.take_copies(docs.limit(0)).collect() == []
