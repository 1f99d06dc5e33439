"""The corpus pipeline: stage by stage against plain versions of each decision."""

import corpus_pipeline
from panelrank.llm import stages
from panelrank.llm.common import stored, table


def test_stages(spark, sf):
    docs = table(spark, sf, "documents")
    columns = docs.columns
    kept = {}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stored(stage(spark, docs, sf), name)
        if number < 4:
            assert docs.columns == columns
            kept[name] = {r.doc_id: r.text for r in docs.collect()}
    first = {r.doc_id: r.text for r in table(spark, sf, "documents").collect()}
    order = [first, *kept.values()]
    assert all(set(b) <= set(a) for a, b in zip(order, order[1:]))
    assert len(kept["toxicity"]) > 0.8 * len(first)
    after = kept["ngram_jaccard_join"]
    assert len(set(after.values())) == len([t for t in after.values() if len(t.split()) >= 5]) + len({t for t in after.values() if len(t.split()) < 5})
    items = [" ".join(r.text.lower().split()) for r in table(spark, sf, "benchmark").collect()]
    spaced = {i: " ".join(t.lower().split()) for i, t in after.items()}
    leaky = {i for i, t in spaced.items() if any(x in t for x in items)}
    assert leaky and not leaky & set(kept["benchmark_decontamination"])
    clean = set(after) - leaky
    assert len(clean - set(kept["benchmark_decontamination"])) <= 2
    assert {r.doc_id for r in docs.collect()} == set(kept["benchmark_decontamination"])


def test_run_gives_the_same_rows(spark, sf):
    rows = corpus_pipeline.run(spark, sf)
    assert set(rows.columns) == {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"}
    assert rows.count() == rows.select("doc_id").distinct().count() > 100


def test_stage_functions_take_empty_tables(spark, sf):
    none = table(spark, sf, "documents").limit(0)
    for stage in (stages.without_toxic, stages.without_repeated_lines, stages.without_near_copies, stages.without_benchmarks, stages.tokenized):
        assert stage(spark, none, sf).count() == 0
