"""The corpus pipeline: each stage against its operator's brute-force version, on the stage's own input."""

from collections import Counter

import brute
import corpus_pipeline
import pytest

from trolley.llm.common import DOCUMENT_COLUMNS, materialise


@pytest.fixture(scope="module")
def steps(spark, sf_dir, small):
    docs, out = small, []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        docs = materialise(stage(spark, docs, sf_dir), f"test-stage-{k}")
        out.append((before, docs))
    return out


def texts(df):
    return Counter((r.doc_id, r.text) for r in df.select("doc_id", "text").collect())


def test_stages(steps):
    assert len(corpus_pipeline.STAGES) == 5
    assert all(after.columns == DOCUMENT_COLUMNS for _, after in steps[:-1])


def test_quality_keeps_good_documents(spark, sf_dir, steps):
    before, after = steps[0]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    kept = {r.doc_id for r in after.collect()}
    good = [i for i, q in labels.items() if q == 1]
    assert sum(i in kept for i in good) >= 0.97 * len(good)
    assert texts(after) <= texts(before)


def test_one_document_of_each_group_stays(steps):
    before, after = steps[1]
    rows = before.select("doc_id", "text").collect()
    label = brute.components([brute.fingerprint(r.text) for r in rows])
    least = {}
    for r, c in zip(rows, label, strict=True):
        least[c] = min(least.get(c, r.doc_id), r.doc_id)
    assert sorted(r.doc_id for r in after.collect()) == sorted(least.values())


def test_contaminated_documents_go(spark, sf_dir, steps):
    before, after = steps[2]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    clean = Counter()
    for r in before.collect():
        if not brute.contamination(r.text, items)[3]:
            clean[(r.doc_id, r.text)] += 1
    assert texts(after) == clean


def test_mix_repeats_documents_as_often_as_taken(steps):
    before, after = steps[3]
    taken, _ = brute.mix([(r.doc_id, r.text, r.source) for r in before.collect()])
    expected = Counter()
    for (doc_id, _, size, words), n in taken.items():
        expected[doc_id] += n * int(words / size + 0.5) if size else 0
    assert Counter(r.doc_id for r in after.collect()) == +expected


def test_shards_hold_everything(steps):
    before, after = steps[4]
    assert texts(after) == texts(before)
    slots = Counter((r.shard, r.slot) for r in after.collect())
    assert max(slots.values()) == 1


def test_run_gives_the_last_stage(spark, sf_dir, steps):
    found = corpus_pipeline.run(spark, sf_dir)
    assert Counter(map(tuple, found.collect())) == Counter(map(tuple, steps[-1][1].select(*found.columns).collect()))


@pytest.mark.parametrize("stage", range(5))
def test_stages_take_odd_and_empty_tables(spark, sf_dir, odd, empty, stage):
    function = corpus_pipeline.STAGES[stage][1]
    assert function(spark, empty, sf_dir).count() == 0
    kept = function(spark, odd, sf_dir)
    assert 0 < kept.count() <= 3 * odd.count()
