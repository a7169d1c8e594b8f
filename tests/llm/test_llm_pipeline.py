"""The registered queries, and the pipeline against its stages done plainly."""

from collections import Counter

import pytest
from test_llm_corpus import WORD, plain_contamination, plain_near, plain_targets
from test_llm_models import plain_statistics

import __spark_entry__ as entry
import corpus_pipeline
from mailfacts.llm import pii, quality, queries

SMALL = "/root/testdata/sf0.001"


def test_queries_are_registered():
    names = set(entry.queries())
    assert {n.split("_")[0] for n in queries.queries()} == {f"op{i}" for i in range(1, 11)}
    assert set(queries.queries()) | {"pipeline"} <= names
    assert set(queries.oracle_sql()) <= set(queries.queries())


@pytest.mark.parametrize("name", [n for n in queries.queries() if n != "op4_toxicity"])
def test_queries_return_every_row(spark, name):
    of = "pages" if name.startswith("op3") else "documents"
    assert queries.queries()[name](spark, SMALL).count() == spark.read.parquet(f"{SMALL}/{of}.parquet").count()


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_queries_equal_sql(spark, name):
    import check

    df = queries.queries()[name](spark, SMALL)
    assert check.differences(df, check.connect(SMALL), queries.oracle_sql()[name]) == []


def test_pipeline_equals_plain_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    benchmark = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    rows = {r.doc_id: r for r in docs.collect()}

    model = quality.train(docs, labels)
    import numpy as np

    scores = model.score(np.array([plain_statistics(r.text) for r in rows.values()]))
    good = [i for i, s in zip(rows, scores) if s >= quality.THRESHOLD]
    alone = [i for i, _, component, _ in plain_near([(i, rows[i].text) for i in good]) if i == component]
    items = [tuple(r) for r in benchmark.select("item_id", "text").collect()]
    clean = [k[0] for k in plain_contamination([(i, rows[i].text) for i in alone], items) if not k[5]]
    texts = {i: pii.mask(rows[i].text) for i in clean}
    assert len(rows) > len(good) > len(alone) > len(clean) > 0

    stage = docs
    for (name, f), ids in zip(corpus_pipeline.STAGES[:4], (good, alone, clean, clean), strict=True):
        stage = f(spark, stage, SMALL)
        assert stage.columns == docs.columns, name
        stage.write.parquet(str(tmp_path / name))
        stage = spark.read.parquet(str(tmp_path / name))
        assert Counter(r.doc_id for r in stage.select("doc_id").collect()) == Counter(ids), name
    assert {r.doc_id: (r.text, r.n_chars) for r in stage.collect()} == {i: (t, len(t)) for i, t in texts.items()}

    sizes = {i: len(WORD.findall(t)) for i, t in texts.items()}
    per_source = Counter()
    for i, n in sizes.items():
        per_source[rows[i].source] += n
    target = plain_targets(per_source)
    mixed = corpus_pipeline.run(spark, SMALL).collect()
    assert {r.doc_id: (r.size, r.source_size) for r in mixed} == {i: (n, per_source[rows[i].source]) for i, n in sizes.items()}
    assert all(r.target == pytest.approx(target[rows[r.doc_id].source]) and r.taken <= 3 * r.size for r in mixed)


def test_stage_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "personal_data", "mix"]
    assert corpus_pipeline.ORACLE_SQL is None
