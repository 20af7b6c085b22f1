import corpus_pipeline
from folioflow.llm.common import materialise
from folioflow.llm.personal import base_spans, redact_spans
from tests.conftest import SMALL
from tests.llm.test_decontaminate import brute as contaminated
from tests.llm.test_neardup import brute as groups


def test_stages_against_plain_versions(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "near_dedup", "decontamination", "personal_data", "packing"]

    good = materialise(stages["quality_rules"](spark, docs, SMALL))
    assert good.columns == docs.columns
    ids = {r.doc_id for r in good.select("doc_id").collect()}
    assert not [k for k in ids if labels.get(k) == 0]

    one = materialise(stages["near_dedup"](spark, good, SMALL))
    rows = [(r.doc_id, r.text) for r in good.collect()]
    assert one.columns == docs.columns and {r.doc_id for r in one.collect()} == {k for k, _, _, kept in groups(rows, 5, 80) if kept}

    clean = materialise(stages["decontamination"](spark, one, SMALL))
    rows = [(r.doc_id, r.text) for r in one.collect()]
    assert clean.columns == docs.columns and {r.doc_id for r in clean.collect()} == {x[0] for x in contaminated(rows, items) if not x[5]}

    hidden = materialise(stages["personal_data"](spark, clean, SMALL))
    assert hidden.columns == docs.columns
    before, after = ({r.doc_id: r.text for r in df.collect()} for df in (clean, hidden))
    assert before.keys() == after.keys()
    for k, text in before.items():
        assert not any(base_spans(after[k]).values())
        spans = [(a, b, kind) for kind, found in base_spans(text).items() for a, b in found]
        if "[SECRET]" not in after[k]:
            assert after[k] == redact_spans(text, spans)

    pieces = stages["packing"](spark, hidden, SMALL).collect()
    assert {r.doc_id for r in pieces} == after.keys() and all(len(r.ids) == r.length for r in pieces)


def test_odd_rows_and_empty_tables_pass_every_stage(spark, odd_docs, no_docs):
    """Each stage keeps the columns, drops nothing but what it is for, and takes a table without rows."""
    docs = odd_docs.withColumnRenamed("score", "component_id").withColumn("row", odd_docs.n_chars).withColumn("K1", odd_docs.doc_id)
    plain = odd_docs.where("doc_id is null or doc_id <> 4").count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns and stage(spark, no_docs, SMALL).count() == 0, name
        ids = sorted(str(r.doc_id) for r in out.collect())
        if name == "quality_rules":
            assert not {"1", "2", "3", "6", "None"} & set(ids)  # all under 50 words
        elif name == "near_dedup":
            assert ids.count("1") == 1 and {"4", "5", "None"} <= set(ids)
        else:
            assert len(ids) == plain + 1 and ids.count("1") == 2, name
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()
    assert sum(r.start == 0 for r in pieces) == docs.count()
