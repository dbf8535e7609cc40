"""Decontamination, licence scans, mixing, sharding: against brute force, and on odd and empty tables."""

from collections import Counter

import __spark_entry__ as entry_points
import brute
import pytest
from compare import connect, differences
from pyspark.sql import functions as F

from trolley.llm import decontaminate, licenses, mixing, sharding
from trolley.llm.sql import ORACLE_SQL


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_sql(spark, sf_dir, name):
    assert differences(entry_points.queries()[name](spark, sf_dir), connect(sf_dir), ORACLE_SQL[name]) == ""


def test_contamination_of_odd_rows(odd, odd_rows, benchmark):
    items = [tuple(r) for r in benchmark.collect()]
    found = Counter(
        (r.doc_id, r.n_words, r.n_hit, r.n_items, tuple(r.item_ids), r.contaminated)
        for r in decontaminate.contamination(odd, benchmark).collect()
    )
    expected = Counter()
    for doc_id, text, *_ in odd_rows:
        n, hit, ids, bad = brute.contamination(text, items)
        expected[(doc_id, n, hit, len(ids), tuple(ids), bad)] += 1
    assert found == expected
    kept = decontaminate.decontaminate(odd, benchmark)
    assert kept.columns == odd.columns
    assert kept.count() == sum(n for key, n in expected.items() if not key[-1])


def test_contamination_of_overlapping_windows_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_WINDOWS", 3)
    words = [f"w{i % 7}" for i in range(60)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words[::-1]))], "doc_id bigint, text string")
    items = [(1, " ".join(words[3:30])), (2, " ".join(words[20:34])), (3, "w1 w2"), (4, "w9 w1 w2")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    for r in decontaminate.contamination(docs, bench).collect():
        text = " ".join(words if r.doc_id == 1 else words[::-1])
        assert (r.n_words, r.n_hit, r.item_ids, r.contaminated) == brute.contamination(text, items)


def test_contamination_of_empty_tables(odd, empty, benchmark):
    assert decontaminate.contamination(empty, benchmark).count() == 0
    rows = decontaminate.contamination(odd, benchmark.limit(0)).collect()
    assert len(rows) == odd.count()
    assert not any(r.contaminated or r.n_hit or r.n_items for r in rows)


def test_no_python_in_native_plans(odd, benchmark):
    for df in (
        decontaminate.contamination(odd, benchmark), licenses.find_licenses(odd), mixing.mix(odd), sharding.shard(odd)
    ):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_licenses(spark, empty, odd):
    mit = f"{licenses.SENTENCES[3].capitalize()}:\n\n{licenses.SENTENCES[4]}.\n{licenses.SENTENCES[5]}."
    rows = [
        (1, mit),
        (2, f"{licenses.SENTENCES[4]}. {licenses.SENTENCES[3]}."),
        (3, f"Some words.\nReleased under the MIT License.\n{'More words. ' * 5000}Licensed under CC BY-NC 4.0."),
        (3, f"Some words.\nReleased under the MIT License.\n{'More words. ' * 5000}Licensed under CC BY-NC 4.0."),
        (4, "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
            "compliance with the License. You may obtain a copy of the License at"),
    ]
    found = licenses.find_licenses(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert Counter((r.doc_id, tuple(r.sentence_ids), tuple(r.licenses)) for r in found) == Counter(
        [(1, (3, 4, 5), ("MIT",)), (2, (4, 3), ()), *[(3, (1, 30), ("CC-BY-NC-4.0", "MIT"))] * 2,
         (4, (11, 12, 13), ("Apache-2.0",))]
    )
    assert licenses.find_licenses(empty).count() == 0
    assert [(r.sentence_ids, r.licenses) for r in licenses.find_licenses(odd).collect()] == [([], [])] * odd.count()


WRAPPED_MIT = """MIT License

Copyright (c) 2020 Somebody

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
"""
WRAPPED_BSD = """Copyright (c) 2020, Somebody
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
WRAPPED_GPL = """A program
This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY."""


def _commented(text, mark):
    return "\n".join(f"{mark} {line}".rstrip() for line in text.split("\n"))


def test_licenses_in_wrapped_lines(spark):
    bsd = ("BSD-2-Clause", "BSD-3-Clause", "proprietary")
    wrapped = [(WRAPPED_MIT, (3, 4), ("MIT",)), (WRAPPED_BSD, (50, 40, 41, 42, 43), bsd),
               (WRAPPED_GPL, (21, 22, 23), ("GPL-3.0",))]
    cases = [
        (dressed, *expected)
        for text, *expected in wrapped
        for dressed in (text, text.replace("\n", "\r\n"), f"/*\n{_commented(text, ' *')}\n */",
                        *(_commented(text, mark) for mark in ("#", "//", ";;", "--")))
    ]
    word_a_line = "\n".join(WRAPPED_MIT.replace("\n\n", " \0 ").split()).replace("\0", "")
    cases += [
        (word_a_line, (3, 4), ("MIT",)),
        ("A title\nCopyright Somebody\n" + WRAPPED_MIT.split("\n\n", 2)[2], (3, 4), ("MIT",)),
        ("Released under\nthe MIT License\nby somebody", (1,), ("MIT",)),
        ("Licensed under the Apache License, Version 2.0\n(the \"License\")\nAll rights reserved", (11, 50),
         ("proprietary",)),
        ("Released under\n\nthe MIT License", (), ()),
        ("Released under. The MIT License\nthe released under\nthe MIT License too", (), ()),
        ("the " * 5000 + "\nReleased under the\nMIT License\n" + "the\n" * 5000, (1,), ("MIT",)),
    ]
    rows = [(i // 2, text) for i, (text, *_) in enumerate(cases)] * 2
    found = licenses.find_licenses(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert Counter((r.doc_id, tuple(r.sentence_ids), tuple(r.licenses)) for r in found) == Counter(
        (i // 2, ids, names) for i, (_, ids, names) in enumerate(cases) for _ in range(2)
    )


def test_mix_of_odd_rows(odd, odd_rows):
    found = mixing.mix(odd)
    assert sorted(found.columns) == sorted(odd.columns)
    expected, target = brute.mix([(r[0], r[1], r[3]) for r in odd_rows])
    rows = found.collect()
    assert Counter((r.doc_id, r.source, r["size"], r.taken) for r in rows) == expected
    assert all(r.target == pytest.approx(target[r.source]) for r in rows)


def test_mix_meets_every_budget_and_reruns_agree(small):
    rows = mixing.mix(small).collect()
    taken, target = Counter(), {}
    for r in rows:
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert 0 <= r.taken <= 3 * r["size"]
    assert all(abs(taken[s] - target[s]) <= 0.5 for s in target)
    again = mixing.mix(small.repartition(7)).collect()
    assert Counter((r.doc_id, r.taken) for r in rows) == Counter((r.doc_id, r.taken) for r in again)


def test_mix_of_empty_table(empty):
    assert mixing.mix(empty).count() == 0


def _assert_shards(rows, shards):
    by_shard = {}
    for r in rows:
        by_shard.setdefault(r.shard, []).append(r)
    assert set(by_shard) <= set(range(shards))
    assert all(sorted(r.slot for r in own) == list(range(len(own))) for own in by_shard.values())
    return {k: sum(r["size"] for r in own) for k, own in by_shard.items()}


def test_shards_have_near_equal_bytes_and_equal_texts_stay_together(small):
    sizes = _assert_shards(rows := sharding.shard(small, shards=8).collect(), 8)
    assert len(rows) == small.count()
    assert all(r["size"] == len((r.text or "").encode()) + 16 for r in rows)
    mean, longest = sum(sizes.values()) / 8, max(r["size"] for r in rows)
    assert all(abs(size - mean) <= longest for size in sizes.values())
    homes = {}
    for r in rows:
        homes.setdefault(r.text, set()).add(r.shard)
    assert sum(len(h) > 1 for h in homes.values()) <= 7


def test_shards_of_one_hot_text(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("the same text " * 20).alias("text"))
    sizes = _assert_shards(sharding.shard(docs, shards=10).collect(), 10)
    assert max(sizes.values()) - min(sizes.values()) <= 0.02 * max(sizes.values())


def test_shards_cut_into_ranges(small, monkeypatch):
    monkeypatch.setattr(sharding, "RANGE_BYTES", 20_000)
    sizes = _assert_shards(rows := sharding.shard(small, shards=4).collect(), 4)
    assert len(rows) == small.count()
    assert max(sizes.values()) < 1.3 * min(sizes.values())


def test_shards_of_odd_and_empty_tables(odd, empty):
    found = sharding.shard(odd)
    assert sorted(found.columns) == sorted(odd.columns)
    _assert_shards(rows := found.collect(), 40)
    assert Counter((r.doc_id, r.text) for r in rows) == Counter((r.doc_id, r.text) for r in odd.collect())
    assert sharding.shard(empty).count() == 0
