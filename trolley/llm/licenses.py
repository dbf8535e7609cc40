"""License scans by sentence rules.

A text is cut into sentences, each is normalised, known sentences of licences become identifiers, and a licence is
found where the text's sequence of identifiers holds the identifiers of one of its rules, in order and with no other
known sentence between them. Unknown sentences are skipped.

Punctuation and blank lines end a sentence; a single line break, with the comment marks after it, may end one or be a
space in it. So a known sentence is looked for from the start of each line or sentence on, to the end of any line.

Sentences are generated and looked up in one stage (the tables of sentences and rules are constants), so only known
ones are ever shuffled, whatever a text repeats.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trolley.llm.common import ascii_lower, row_key

COMMENT_MARKS = r"\n[^a-z0-9\n\x80-\x{10FFFF}]+"  # at the start of a line; a line of nothing else is blank
SENTENCE_END = r"[.!?;:]+[ \t\r\f\n]+"

# Sentences of public licences and of customary notices, normalised, and the rules over them.
SENTENCES = {
    1: "released under the mit license",
    2: "licensed under the mit license",
    3: "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
    " documentation files the software to deal in the software without restriction including without limitation the"
    " rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit"
    " persons to whom the software is furnished to do so subject to the following conditions",
    4: "the above copyright notice and this permission notice shall be included in all copies or substantial portions of"
    " the software",
    5: "the software is provided as is without warranty of any kind express or implied including but not limited to the"
    " warranties of merchantability fitness for a particular purpose and noninfringement",
    10: "licensed under the apache license version 2 0",
    11: "licensed under the apache license version 2 0 the license",
    12: "you may not use this file except in compliance with the license",
    13: "you may obtain a copy of the license at",
    20: "this work is licensed under the gnu general public license version 3",
    21: "this program is free software",
    22: "you can redistribute it and or modify it under the terms of the gnu general public license as published by the"
    " free software foundation either version 3 of the license or at your option any later version",
    23: "this program is distributed in the hope that it will be useful but without any warranty",
    30: "licensed under cc by nc 4 0",
    31: "licensed under cc by 4 0",
    32: "licensed under cc by sa 4 0",
    40: "redistribution and use in source and binary forms with or without modification are permitted provided that the"
    " following conditions are met",
    41: "redistributions of source code must retain the above copyright notice this list of conditions and the following"
    " disclaimer",
    42: "redistributions in binary form must reproduce the above copyright notice this list of conditions and the"
    " following disclaimer in the documentation and or other materials provided with the distribution",
    43: "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote"
    " products derived from this software without specific prior written permission",
    50: "all rights reserved",
}
RULES = [
    ("Apache-2.0", (10,)),
    ("Apache-2.0", (11, 12)),
    ("Apache-2.0", (12, 13)),
    ("BSD-2-Clause", (40, 41, 42)),
    ("BSD-3-Clause", (40, 41, 42, 43)),
    ("CC-BY-4.0", (31,)),
    ("CC-BY-NC-4.0", (30,)),
    ("CC-BY-SA-4.0", (32,)),
    ("GPL-3.0", (20,)),
    ("GPL-3.0", (21, 22)),
    ("MIT", (1,)),
    ("MIT", (2,)),
    ("MIT", (3, 4)),
    ("proprietary", (50,)),
]


def lines_of(text: Column) -> Column:
    """Lower case (A-Z) lines with one space for anything but letters and digits, none at the ends, an empty one where a
    sentence ends."""
    marked = F.regexp_replace(ascii_lower(text), COMMENT_MARKS, "\n")
    marked = F.regexp_replace(marked, SENTENCE_END, "\n\n")
    marked = F.regexp_replace(marked, r"[^a-z0-9\n]+", " ")
    return F.split(F.trim(F.regexp_replace(marked, " ?\n ?", "\n")), "\n")


def known_sentences(documents: DataFrame, sentences: dict[int, str]) -> DataFrame:
    """``row_key, at, sentence_id`` of every known sentence, but not of those inside longer ones; ``at`` counts the
    text's lines from 0."""
    spark = documents.sparkSession
    known = spark.range(1).select(
        F.explode(F.map_from_arrays(F.array(*map(F.lit, sentences.values())), F.array(*map(F.lit, sentences)))).alias(
            "sentence", "sentence_id"
        )
    )
    known = known.withColumn("first", F.substring_index("sentence", " ", 1))
    firsts = sorted({sentence.split(" ")[0] for sentence in sentences.values()})
    longest = max(map(len, sentences.values()))
    most_lines = max(len(sentence.split(" ")) for sentence in sentences.values())

    def starts(lines: Column) -> Column:
        def start(line: Column, at: Column) -> Column:
            rest = F.substring(F.array_join(F.slice(lines, at + 1, most_lines), "\n"), 1, longest + 1)
            first = F.substring_index(line, " ", 1)
            return F.when(first.isin(firsts), F.struct(at.alias("at"), first.alias("first"), rest.alias("rest")))

        return F.array_compact(F.transform(lines, start))

    # A line longer than any known sentence is in none; empty, it bounds what is joined.
    lines = F.transform(lines_of(F.col("text")), lambda line: F.when(F.length(line) <= longest, line).otherwise(""))
    # An array of one names the lines, so that they are made once. The outer form keeps Spark from making them once
    # more below, to filter on the number of starts.
    exploded = F.explode_outer(F.flatten(F.transform(F.array(lines), starts))).alias("start")
    begun = documents.select(row_key().alias("row_key"), exploded).select("row_key", "start.*")
    begun = begun.withColumn("flat", F.translate("rest", "\n", " "))

    after = F.col("rest").substr(F.length("sentence") + 1, F.lit(1))
    found = begun.join(F.broadcast(known), "first")
    found = found.where(F.startswith("flat", "sentence") & after.isin("", "\n"))
    breaks = F.regexp_count(F.col("rest").substr(F.lit(1), F.length("sentence")), F.lit("\n"))
    ended = F.struct((F.col("at") + breaks).alias("end"), "sentence_id")
    # Repeated rows and all but the longest of a line go in the map tasks; a text's starts then gather in one.
    best = found.groupBy("row_key", "at").agg(F.max(ended).alias("best")).select("row_key", "at", "best.*")
    earlier = Window.partitionBy("row_key").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    outside = best.withColumn("reached", F.coalesce(F.max("end").over(earlier), F.lit(-1)))
    return outside.where(F.col("end") > F.col("reached")).select("row_key", "at", "sentence_id")


def find_licenses(
    documents: DataFrame,
    sentences: dict[int, str] = SENTENCES,
    rules: list[tuple[str, tuple[int, ...]]] = RULES,
) -> DataFrame:
    """``doc_id, sentence_ids`` (known sentences in order) and ``licenses`` (sorted, distinct) for every row.

    Null and empty texts have none. Null doc_id and repeated rows: a row each. A sentence repeated in a text is in the
    sequence as often as it occurs. Very long texts are searched whole, as lines of one row. Empty table: empty result. Other columns are ignored.
    """
    found = known_sentences(documents, sentences)
    # Bounded by the text's length.
    ordered = found.groupBy("row_key").agg(F.array_sort(F.collect_list(F.struct("at", "sentence_id"))).alias("found"))
    ordered = ordered.select("row_key", F.transform("found", lambda s: s["sentence_id"]).alias("ids"))
    all_rows = documents.select("doc_id", row_key().alias("row_key")).join(ordered, "row_key", "left")

    ids = F.coalesce("ids", F.array().cast("array<int>"))
    sequence = F.concat(F.lit(","), F.array_join(F.col("sentence_ids").cast("array<string>"), ","), F.lit(","))
    met = [F.when(sequence.contains(f",{','.join(map(str, rule))},"), F.lit(name)) for name, rule in rules]
    licenses = F.array_sort(F.array_distinct(F.array_compact(F.array(*met))))
    return all_rows.select("doc_id", ids.alias("sentence_ids")).withColumn("licenses", licenses)
