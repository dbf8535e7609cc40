"""Collocations, fill-in-the-middle and MinHash near-dedup: against brute force, on odd and empty tables."""

import random
from collections import Counter

import __spark_entry__ as entry_points
import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from trolley.llm import chosen_path, collocations, infill
from trolley.llm.bloom import Bloom, bloom_of

SCHEMA = "doc_id bigint, text string, lang string"


def long_text():
    return " ".join(f"w{i * i % 9973}" + (".\n" if i % 17 == 0 else "") for i in range(1_000_000))


# Fill in the middle


@pytest.mark.parametrize("block", [1, 2, 7, infill.BLOCK])
@pytest.mark.parametrize("form", [infill.PSM, infill.SPM])
def test_rotations(block, form, monkeypatch):
    monkeypatch.setattr(infill, "BLOCK", block)
    text = "ab é\n <P <S　M> ><".encode()
    for first in range(len(text) + 1):
        for second in range(first, len(text) + 1):
            out = bytes(infill.infill(text, first, second, form))
            parts = {"P": text[:first], "M": text[first:second], "S": text[second:]}
            assert out == b"".join(b"<%b>%b" % (m.encode(), parts[m]) for m in ("PSM" if form == "psm" else "SPM"))
            assert infill.undo(out, form) == text


def test_infill_of_odd_rows(spark, odd, odd_rows):
    extra = [(i, t) for i in range(11, 90) for t in (f"some words {i}\n\tand é more  ", f"holds <M> {i}")]
    table = odd.select("doc_id", "text", "n", "size").unionByName(
        spark.createDataFrame(extra, "doc_id bigint, text string"), allowMissingColumns=True
    )
    made = infill.transform(table)
    found = made.withColumn("back", infill.restored(F.col("output"), F.col("form"))).collect()
    expected = Counter((i, *brute.infill(i, t), t or "") for i, t, *_ in [*odd_rows, *extra])
    assert Counter(tuple(r) for r in found) == expected
    assert {r.form for r in found} == {"plain", "psm", "spm"}


def test_infill_of_a_very_long_text_and_of_none(spark, empty):
    text = long_text()
    rows = infill.transform(spark.createDataFrame([(i, text) for i in range(4)], "doc_id bigint, text string")).collect()
    assert [tuple(r) for r in rows] == [(i, *brute.infill(i, text)) for i in range(4)]
    assert infill.transform(empty).count() == 0


def test_registered_infill(spark, sf_dir, small):
    expected = {r.doc_id: brute.infill(r.doc_id, r.text) for r in small.collect()}
    texts = {r.doc_id: r.text or "" for r in small.collect()}
    for r in entry_points.queries()["op12_infill"](spark, sf_dir).collect():
        n, form, output, prefix, middle = expected.pop(r.doc_id)
        assert (r.n, r.form, r.prefix_chars, r.middle_chars) == (n, form, prefix, middle)
        assert (r.output_sha256, r.restored_sha256) == (brute.digest(output), brute.digest(texts[r.doc_id]))
    assert not expected


# Collocations


def some_text(rng, n):
    words = ["of", "the", "end", "deep", "blue", "sea", "é", "in", "a", "Word", "x-y", " "]
    return "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", ", ", ".\n", "  "]) for _ in range(n))


@pytest.mark.parametrize("every, longest", [(1, 256), (2, 256), (3, 4), (1 << 30, 3), (1 << 30, 256)])
def test_chunks_hold_every_phrase_once(every, longest, monkeypatch):
    monkeypatch.setattr(collocations, "TRIGGER_EVERY", every)
    monkeypatch.setattr(collocations, "LONGEST_CHUNK", longest)
    text = some_text(random.Random(5), 700)
    found = Counter()
    for own, words in collocations.chunks(text.encode(), collocations.Triggers()):
        words = words.decode().split(" ")
        for i in range(own):
            for k in range(1, 6):
                phrase = tuple(words[i : i + k])
                if len(phrase) == k and "." not in phrase:
                    found[phrase] += 1
    assert found == brute.phrase_counts([text])


def test_collocations_of_odd_rows(spark, odd_rows):
    rng = random.Random(3)
    rows = [(t, lang) for _, t, lang, _ in odd_rows]
    rows += [(some_text(rng, rng.randrange(300)), rng.choice(["en", "fr", None])) for _ in range(60)]
    rows += [("of the deep blue sea, " * 40, "en"), ("again " * 5000, "fr")] + [("one passage of it", "de")] * 30
    table = spark.createDataFrame([(None, *r, "x", "y") for r in rows], f"{SCHEMA}, phrase string, rank string")
    for share in (100, 60):
        found = collocations.collocations(table, least=8, share=share, top=50)
        assert sorted(tuple(r) for r in found.collect()) == brute.collocations(rows, 8, share, 50)


def test_collocations_of_a_very_long_text_and_of_none(spark, empty):
    text = long_text()
    table = spark.createDataFrame([(1, text, "en")], SCHEMA)
    found = collocations.collocations(table, top=5).collect()
    assert [tuple(r) for r in found] == brute.collocations([(text, "en")], top=5)
    assert collocations.collocations(empty).count() == 0


def test_scores_beyond_64_bits(spark):
    wide = spark.sql("SELECT 4000000000000L a, 90000000000000L n, 5000000000000L l, 7000000000000L r")
    score = wide.selectExpr(
        "(cast(a * 1000 as decimal(38,0)) * n) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0))) AS s"
    )
    assert score.first().s == 1000 * 4000000000000 * 90000000000000 // (5000000000000 * 7000000000000)


def test_bloom_filters_have_what_was_added(spark):
    items = spark.range(5000).selectExpr("cast(id as string) AS w")
    bloom = bloom_of(items, F.xxhash64("w"))
    hashes = np.array([r.h for r in spark.range(20000).selectExpr("xxhash64(cast(id as string)) AS h").collect()])
    has = bloom.has(hashes.view(np.uint64))
    assert has[:5000].all() and has[5000:].mean() < 0.05
    assert not Bloom(np.zeros(4096, np.uint8)).has(hashes.view(np.uint64)).any()


# MinHash near-dedup


def changed(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return words


def near_copies(seed=7):
    """Groups of near copies of all similarities, one of them dense, among texts that share a passage."""
    rng = random.Random(seed)
    passage = [f"p{i}" for i in range(40)]
    texts = []
    for g in range(25):
        base = [f"b{g}x{rng.randrange(10**6)}" for _ in range(rng.choice([20, 60, 150]))] + passage[: rng.randrange(40)]
        texts += [changed(rng, base, rng.randrange(5)) for _ in range(rng.randrange(1, 6))]
    base = [f"dense{i}" for i in range(120)]
    texts += [changed(rng, base, rng.randrange(9)) for _ in range(90)]
    texts += [["only"], ["only", "two"], ["Only"], passage, passage[:35]]
    rng.shuffle(texts)
    return [" ".join(t) for t in texts]


def check_components(spark, texts, plan):
    table = spark.createDataFrame([(i + 1, t, "en") for i, t in enumerate(texts)], SCHEMA)
    found = {r.doc_id: r for r in chosen_path.near_duplicates(table, plan).collect()}
    label = brute.similar(texts)
    for i, t in enumerate(texts):
        row = found[i + 1]
        assert (row.n_shingles, row.component_id, row.kept) == (len(brute.shingle_set(t)), label[i] + 1, label[i] == i), t


def test_components_equal_brute_force(spark):
    check_components(spark, near_copies(), chosen_path.Plan())


def test_components_with_small_nodes(spark):
    """Nodes of six: the dense group goes through branches, random blocks and pairs of blocks."""
    check_components(spark, near_copies(8), chosen_path.Plan(leaf=6, trees=12, root_tokens=1, steps=((1, 1), (2, 2))))


def test_components_with_heavy_sets(spark):
    check_components(spark, near_copies(9), chosen_path.Plan(leaf_shingles=300, trees=12, root_tokens=1, steps=((1, 1),)))


def test_near_copies_of_odd_rows(spark, odd, odd_rows, empty):
    ids = [i for i, *_ in odd_rows]
    label = brute.similar([t for _, t, *_ in odd_rows])
    least = {k: min((i for i, own in zip(ids, label) if own == k and i is not None), default=None) for k in set(label)}
    expected = Counter(
        (i, len(brute.shingle_set(t)), least[k], i == least[k]) for (i, t, *_), k in zip(odd_rows, label)
    )
    assert Counter(tuple(r) for r in chosen_path.near_duplicates(odd).collect()) == expected
    assert chosen_path.near_duplicates(empty).count() == 0


def test_near_copies_of_very_long_texts(spark):
    text = long_text()
    other = " ".join(f"z{i}" for i in range(400_000))
    rows = [(3, text, "en"), (2, text.replace("w1 ", "v1 "), "en"), (1, other, "en")]
    found = chosen_path.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    label = brute.similar([t for _, t, _ in rows])
    assert {r.doc_id: r.component_id for r in found} == {3: 2, 2: 2, 1: 1} and label == [0, 0, 2]


def test_registered_near_copies(spark, sf_dir, small):
    rows = sorted(small.collect(), key=lambda r: r.doc_id)
    label = brute.similar([r.text for r in rows])
    found = {r.doc_id: r for r in entry_points.queries()["op13_minhash"](spark, sf_dir).collect()}
    assert len(found) == len(rows)
    for r, k in zip(rows, label):
        own = found[r.doc_id]
        assert (own.n_shingles, own.component_id) == (len(brute.shingle_set(r.text)), rows[k].doc_id)
        assert own.kept == (r.doc_id == rows[k].doc_id)
