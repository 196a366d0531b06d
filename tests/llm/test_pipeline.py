import corpus_pipeline as P
from helpers import clashing, docs, edge_rows

from orbita.llm import common, decontaminate, quality, simhash
from orbita.llm.simhash import fingerprint

SF = "/root/testdata/sf0.01"


def test_stages_on_the_table(spark):
    table = common.documents(spark, SF)
    now, seen = table, {}
    for name, stage in P.STAGES:
        new = common.written(stage(spark, now, SF), "test")
        if name != "packing":
            assert new.columns == table.columns
            assert new.join(now, "doc_id", "left_anti").count() == 0 and new.count() <= now.count()
        seen[name] = (now, new)
        now = new
    # quality: what goes is what the classifier rejects
    predicted = {r.doc_id: r.predicted for r in quality.classify(table, common.table(spark, SF, "labels")).collect()}
    assert {r.doc_id for r in seen["quality"][1].collect()} == {i for i, p in predicted.items() if p}
    # near duplicates: one of each group, the least id
    before, after = seen["near_dedup"]
    groups = {r.doc_id: r.component_id for r in simhash.near_duplicates(before).collect()}
    assert sorted(r.doc_id for r in after.collect()) == sorted(set(groups.values()))
    assert len({fingerprint(r.text) for r in after.collect()}) == after.count()
    # decontamination: what goes holds an item
    before, after = seen["decontaminate"]
    leaks = {r.doc_id for r in decontaminate.find_leaks(before, common.table(spark, SF, "benchmark")).collect()}
    assert {r.doc_id for r in before.collect()} - {r.doc_id for r in after.collect()} == leaks
    # packing: all that is left
    before, after = seen["packing"]
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in before.collect()}
    run = P.run(spark, SF).collect()
    assert sorted((r.doc_id, r.start) for r in run)[:1] and {r.doc_id for r in run} == {r.doc_id for r in before.collect()}


def test_stages_on_edges(spark):
    now = clashing(docs(spark, edge_rows()), "_score", "_fp", "_row", "_found", "part", "N_LINES")
    columns = now.columns
    for name, stage in P.STAGES:
        now = common.written(stage(spark, now, SF), "test")
        assert name == "packing" or now.columns == columns
    for name, stage in P.STAGES:
        assert stage(spark, docs(spark, []), SF).count() == 0
        stage(spark, docs(spark, edge_rows()), SF).count()
