from __future__ import annotations

import public_tokenizers as P

import __spark_entry__ as entry
import corpus_pipeline
from dealspark.llm import language_model, near_dedup, packing, quality_rules, suffix_dedup
from dealspark.llm.common import stored, table

SF = "/root/testdata/sf0.001"


def test_stages_are_the_operators(spark):
    """Each stage on what its predecessor kept, against its operator's own (brute-force tested) verdicts."""
    docs = table(spark, SF, "documents")
    labels = table(spark, SF, "labels")
    ids = lambda df: sorted(r.doc_id for r in df.collect())
    verdicts = {
        "quality rules": lambda d: quality_rules.judge(d, "doc_id").where("kept"),
        "quality classifier": lambda d: language_model.classify(d, labels).where("kept"),
        "minhash near-dedup": lambda d: near_dedup.near_duplicates(d, 5, 80).where("kept"),
        "suffix-array dedup": lambda d: suffix_dedup.remove_repeats(d, 200),
    }
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stored(stage(spark, docs, SF), "stage")
        assert out.schema == docs.schema, name
        assert ids(out) == ids(verdicts[name](docs)), name
        docs = out
    last = stored(corpus_pipeline.STAGES[-1][1](spark, docs, SF), "stage")
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    want = packing.pack_documents(docs, P.path("byte_bpe_50k.json"))
    assert sorted(map(tuple, last.select(*key).collect())) == sorted(map(tuple, want.select(*key).collect()))


def test_registered(spark):
    names = [q for q in entry.queries() if q.startswith("op")]
    assert {int(n[2:].split("_")[0]) for n in names} >= set(range(1, 11)) and "pipeline" in entry.queries()
    assert [s[0] for s in corpus_pipeline.STAGES] == ["quality rules", "quality classifier", "minhash near-dedup",
                                                      "suffix-array dedup", "best-fit packing"]


def test_empty_and_null_documents(spark):
    docs = table(spark, SF, "documents")
    none = docs.limit(0)
    odd = spark.createDataFrame([(None, None, None, None, None), (1, None, "en", None, 0), (1, "", None, "s", None)], docs.schema)
    for name, stage in corpus_pipeline.STAGES:
        assert stored(stage(spark, none, SF), "stage").count() == 0, name
        assert stored(stage(spark, odd, SF), "stage").count() >= (0 if name == "quality rules" else 1), name
