"""The pipeline: stages in order, each judged on its own input."""

import corpus_pipeline
from conftest import SF001
from parcelkit.llm import lines, mixing, packing, quality, simhash


def test_stages_and_result(spark, docs, tmp_path):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "simhash_near_dedup", "mix_sources", "packing"]
    outs, now = [], docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, now, SF001)
        if name != "packing":
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
        out.write.parquet(str(tmp_path / name))
        now = spark.read.parquet(str(tmp_path / name))
        outs.append(now)
    good, unique, single, mixed, packed = outs
    kept = {r.doc_id for r in quality.score(docs).where("quality.kept").collect()}
    assert {r.doc_id for r in good.collect()} == kept
    dropped = {r.doc_id: r.dropped for r in lines.line_report(good).collect()}
    before = {r.doc_id: r.text for r in good.collect()}
    for r in unique.collect():
        assert r.text == "\n".join(x for i, x in enumerate(before[r.doc_id].split("\n")) if i not in dropped[r.doc_id])
        assert r.n_chars == len(r.text)
    groups = {r.component_id for r in simhash.group_documents(unique).collect()}
    assert {r.doc_id for r in single.collect()} == groups
    copies = {r.doc_id: len(r.mix.shards) for r in mixing.place(single).collect()}
    got = [r.doc_id for r in mixed.collect()]
    assert sorted(got) == sorted(d for d, n in copies.items() for _ in range(n))
    assert sum(p.length for p in packed.collect()) == sum(p.length for p in packing.pack(mixed, with_ids=False).collect())


def test_run(spark, queries):
    assert queries["pipeline"](spark, SF001).count() > 0


def test_empty_documents(spark, empty):
    now = empty
    for _, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, SF001)
        assert now.count() == 0
