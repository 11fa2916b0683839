import corpus_pipeline
from helpers import rows

import __spark_entry__
from burnish.llm import decontaminate, langid, mixing, pii, simhash
from burnish.session import materialise


def test_stages_one_by_one(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    names = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = materialise(stage(spark, docs, small), name)
        assert kept.columns == names and kept.count() <= docs.count()
        if name == "language_id":
            assert rows(kept) == rows(langid.identify(docs).filter("lang_pred <> 'und'").select(*names))
        elif name == "near_dedup":
            ids = {r.doc_id for r in simhash.near_duplicates(docs).filter("doc_id = component_id").collect()}
            assert {r.doc_id for r in kept.collect()} == ids and kept.count() == len(ids)
        elif name == "decontamination":
            marked = decontaminate.judged(decontaminate.mark(docs, spark.read.parquet(f"{small}/benchmark.parquet")))
            assert rows(kept) == rows(marked.filter("NOT contaminated").select(*names))
        else:
            assert kept.count() == docs.count()
            left = [s for r in kept.collect() for s in pii.base_spans(r.text)]
            assert not [s for s in left if s[0] in (0, 1)]
        docs = kept
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, small)
    assert rows(mixed) == rows(mixing.mix(docs).filter("taken > 0"))


def test_awkward_and_empty_documents(spark, awkward, nothing, small):
    for docs in (awkward, nothing):
        for name, stage in corpus_pipeline.STAGES:
            docs = materialise(stage(spark, docs, small), name)
        assert set(awkward.columns) <= set(docs.columns)


def test_registered():
    found = __spark_entry__.queries()
    assert "pipeline" in found and "pipeline" not in __spark_entry__.oracle_sql()
    for n in range(1, 11):
        assert sum(k.startswith(f"op{n}_") for k in found) == 1
