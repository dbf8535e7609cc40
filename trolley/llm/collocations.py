"""Phrase collocations by prefix-free parsing.

Trigger words, chosen by their hash, cut every text into chunks that overlap by one word less than the longest phrase,
so that each phrase lies whole in the chunk it starts in and is counted there alone. Wherever a passage is repeated the
cuts fall alike: the corpus becomes a dictionary of distinct chunks with frequencies, and phrases are counted inside the
dictionary, each weighted by its chunk's frequency.

A phrase occurs no more often than its parts. Words are counted first, then pairs of frequent words, then longer phrases
of frequent pairs. What is frequent reaches the tasks as a Bloom filter of bounded size: it never drops a frequent
phrase, and one that it lets through in error is counted and then dropped for its exact count.
"""

from __future__ import annotations

import string
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trolley.llm.bloom import Bloom, bloom_of
from trolley.llm.common import materialise

NO_LANG = "und"
LONGEST = 5  # words of a phrase
TRIGGER_EVERY = 32  # one word in so many is a trigger
KNOWN_WORDS = 400_000  # whose triggers a task remembers
LONGEST_CHUNK = 256  # own words of a chunk, where no trigger comes
CHUNKS_HELD = 200_000  # distinct chunks in a task before they go out
BLOCK_WORDS = 2_000_000  # words whose phrases are counted together in a task
SEED = 42
BREAK = b"."  # stands for every run of separators; no word holds it
# Lower case for A-Z, one byte for all of . , ; : ! ? and U+000A to U+000D.
FOLD = bytes.maketrans(
    string.ascii_uppercase.encode() + b",;:!?\n\x0b\x0c\r", string.ascii_lowercase.encode() + BREAK * 9
)


class Triggers(dict):
    """Whether a word is a trigger, remembered for a bounded number of words."""

    def __missing__(self, word: bytes) -> bool:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        self[word] = found = xxhash.xxh32_intdigest(word, SEED) % TRIGGER_EVERY == 0
        return found


def chunks(text: bytes, triggers: Triggers) -> Iterator[tuple[int, bytes]]:
    """``(own, words)`` of each chunk: words and breaks joined by spaces, the phrases that start in the first ``own`` of
    them being the chunk's."""
    words = text.translate(FOLD).replace(BREAK, b" " + BREAK + b" ").split()
    trigger = list(map(triggers.__getitem__, words))
    at = 0
    while at < len(words):
        end = min(at + LONGEST_CHUNK, len(words))
        try:
            end = trigger.index(True, at + 1, end)
        except ValueError:
            pass
        reach = end
        while reach < len(words) and reach - end < LONGEST - 1 and words[reach] != BREAK:
            reach += 1
        yield end - at, b" ".join(words[at:reach])
        at = end


def dictionary(documents: DataFrame) -> DataFrame:
    """``lang, own, words, freq``: the distinct chunks of every language with their number of occurrences."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        triggers = Triggers()

        def out() -> Iterator[pa.RecordBatch]:
            keys, freq = list(held), list(held.values())
            held.clear()
            for k in range(0, len(keys), 10_000):
                langs, own, words = zip(*keys[k : k + 10_000], strict=True)
                arrays = [pa.array(langs), pa.array(own, pa.int32()), pa.array(words, pa.binary())]
                yield pa.RecordBatch.from_arrays(
                    [*arrays, pa.array(freq[k : k + 10_000], pa.int64())], names=["lang", "own", "words", "freq"]
                )

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
                for own, words in chunks(text.as_py(), triggers):
                    held[lang, own, words] += 1
                    if len(held) >= CHUNKS_HELD:
                        yield from out()
        yield from out()

    bare = documents.where("text IS NOT NULL").select(
        F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)).alias("lang"), F.col("text").cast("binary").alias("text")
    )
    parsed = bare.mapInArrow(parse, "lang string, own int, words binary, freq bigint")
    summed = parsed.groupBy("lang", "own", "words").agg(F.sum("freq").alias("freq"))
    return materialise(summed.select("lang", "own", F.col("words").cast("string").alias("words"), "freq"), "chunks")


class Numbers(dict):
    """Words in the order in which they are met first."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


class Block:
    """Chunks of one language, their words as numbers. ``start[i]`` is true where a phrase may start, ``weight[i]`` is
    the frequency of the chunk, and ``room[i]`` the number of words from i to the next break or end of a chunk."""

    def __init__(self, lang: str, texts: list[bytes], own: list[int], freq: list[int]):
        self.seed = xxhash.xxh64_intdigest(lang.encode(), SEED)
        lengths = np.fromiter((t.count(b" ") + 1 for t in texts), np.int64, len(texts))
        number, size = Numbers(), int(lengths.sum())
        self.ids = np.fromiter(map(number.__getitem__, b" ".join(texts).split(b" ")), np.int64, size)
        self.words = list(number)
        ends = np.cumsum(lengths)
        offset = np.arange(size) - np.repeat(ends - lengths, lengths)
        self.start = offset < np.repeat(np.asarray(own), lengths)
        self.weight = np.repeat(np.asarray(freq, np.int64), lengths)
        stop = np.full(size, size)
        stop[ends - 1] = ends
        if BREAK in number:
            breaks = np.flatnonzero(self.ids == number[BREAK])
            stop[breaks] = breaks
        self.room = np.minimum.accumulate(stop[::-1])[::-1] - np.arange(size)

    def hashes(self, phrases: list[bytes]) -> np.ndarray:
        """What xxhash64 of language and phrase is in Spark."""
        digest = xxhash.xxh64_intdigest
        return np.fromiter((digest(p, self.seed) for p in phrases), np.uint64, len(phrases))

    def pairs(self, bloom: Bloom) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Positions where two frequent words start, the distinct pair at each, and the pairs' texts."""
        frequent = bloom.has(self.hashes(self.words))[self.ids]
        at = np.flatnonzero(frequent[:-1] & frequent[1:] & (self.room[:-1] >= 2))
        distinct, pair = np.unique(self.ids[at] * len(self.words) + self.ids[at + 1], return_inverse=True)
        first, second = divmod(distinct, len(self.words))
        texts = [self.words[a] + b" " + self.words[b] for a, b in zip(first.tolist(), second.tolist(), strict=True)]
        return at, pair, texts

    def counts(self, at: np.ndarray, key: np.ndarray, n: int) -> np.ndarray:
        """Exact occurrences of n keys: of those that start here only, weighted."""
        total = np.zeros(n, np.int64)
        own = self.start[at]
        np.add.at(total, key[own], self.weight[at[own]])
        return total


Counted = Iterator[tuple[list[bytes] | np.ndarray, np.ndarray]]


def pair_counts(block: Block, blooms: list[Bloom]) -> Counted:
    """Pairs of frequent words, by hash. They are counted again by their words if the hash is frequent."""
    at, pair, texts = block.pairs(blooms[0])
    yield block.hashes(texts).view(np.int64), block.counts(at, pair, len(texts))


def phrase_counts(block: Block, blooms: list[Bloom]) -> Counted:
    """Frequent pairs, and longer phrases all of whose pairs are frequent."""
    at, pair, texts = block.pairs(blooms[0])
    frequent = blooms[1].has(block.hashes(texts))[pair]
    at, key = at[frequent], pair[frequent]
    yield texts, block.counts(at, key, len(texts))
    goes_on = np.zeros(len(block.ids) + LONGEST, bool)  # a frequent pair starts here
    goes_on[at] = True
    for n in range(3, LONGEST + 1):
        grows = goes_on[at + n - 2] & (block.room[at] >= n)
        at, key = at[grows], key[grows]
        last = block.ids[at + n - 1]
        distinct, key = np.unique(key * len(block.words) + last, return_inverse=True)
        before, word = divmod(distinct, len(block.words))
        texts = [texts[b] + b" " + block.words[w] for b, w in zip(before.tolist(), word.tolist(), strict=True)]
        yield texts, block.counts(at, key, len(texts))


def blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Block]]:
    """A task's chunks, a bounded number of words of one language at a time."""
    held: dict[str, tuple[list, list, list]] = {}
    size: Counter = Counter()
    for batch in batches:
        for lang, own, words, freq in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            texts, owns, freqs = held.setdefault(lang, ([], [], []))
            texts.append(words)
            owns.append(own)
            freqs.append(freq)
            size[lang] += own
            if size[lang] >= BLOCK_WORDS:
                size.pop(lang)
                yield lang, Block(lang, *held.pop(lang))
            elif size.total() >= 2 * BLOCK_WORDS:  # many languages of few words each
                size.clear()
                yield from ((k, Block(k, *v)) for k, v in held.items())
                held.clear()
    yield from ((k, Block(k, *v)) for k, v in held.items())


def count_phrases(
    parsed: DataFrame, count: Callable[[Block, list[Bloom]], Counted], key: str, filters: list[Bloom], least: int
) -> DataFrame:
    """``lang, phrase, a`` of what ``count`` finds in the dictionary and what occurs ``least`` times. ``key`` is the type
    of a phrase: binary, or bigint for its hash, which stands for the language too (``lang`` is then empty)."""
    shared = parsed.sparkSession.sparkContext.broadcast([b.bits for b in filters])
    kind = pa.binary() if key == "binary" else pa.int64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blooms = [Bloom(bits) for bits in shared.value]
        for lang, block in blocks_of(batches):
            for phrases, total in count(block, blooms):
                found = np.flatnonzero(total)
                for k in range(0, len(found), 10_000):
                    part = found[k : k + 10_000]
                    named = [phrases[i] for i in part.tolist()] if key == "binary" else phrases[part]
                    langs = [lang if key == "binary" else ""] * len(part)
                    arrays = [pa.array(langs, pa.string()), pa.array(named, kind), pa.array(total[part], pa.int64())]
                    yield pa.RecordBatch.from_arrays(arrays, names=["lang", "phrase", "a"])

    bare = parsed.select("lang", "own", F.col("words").cast("binary").alias("words"), "freq")
    counted = bare.mapInArrow(run, f"lang string, phrase {key}, a bigint")
    keys = ["lang", "phrase"] if key == "binary" else ["phrase"]
    summed = counted.groupBy(*keys).agg(F.sum("a").alias("a")).where(F.col("a") >= least)
    found = materialise(summed, "phrases")
    shared.unpersist()
    return found


def frequent_phrases(documents: DataFrame, least: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Number of words by language (``lang, n``), words that occur ``least`` times, phrases of 2 to LONGEST words that
    do (``lang, phrase, a`` each)."""
    parsed = dictionary(documents)
    own = parsed.select("lang", "freq", F.explode(F.slice(F.split("words", " "), F.lit(1), F.col("own"))).alias("phrase"))
    words = own.where(F.col("phrase") != BREAK.decode()).groupBy("lang", "phrase").agg(F.sum("freq").alias("a"))
    words = materialise(words, "words")
    totals = words.groupBy("lang").agg(F.sum("a").alias("n"))
    frequent = words.where(F.col("a") >= least)
    word_filter = bloom_of(frequent, F.xxhash64("lang", "phrase"))
    pairs = count_phrases(parsed, pair_counts, "bigint", [word_filter], least)
    pair_filter = bloom_of(pairs, F.col("phrase"))
    phrases = count_phrases(parsed, phrase_counts, "binary", [word_filter, pair_filter], least)
    return totals, frequent, phrases.withColumn("phrase", F.col("phrase").cast("string"))


def _part(words: Column, start: Column, length: Column) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def collocations(documents: DataFrame, least: int = 100, share: int = 100, top: int = 2000) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's ``top`` phrases of 2 to 5 words.

    Score: the smallest, over all cuts into two parts, of floor(1000 * a * n / (l * r)) for a phrase and parts that
    occur a, l and r times among n words; the first of cuts that tie. A phrase goes if its words lie in one, one word
    longer, that occurs at least ``share`` per cent as often (a still longer one then has such a phrase within it).
    Ties: score, then a, then the phrase by its bytes.

    Null, empty and blank texts have no phrases; documents without a language count as ``und``. doc_id is not used, so
    null and repeated ids are like any others, and repeated rows count each time. Very long texts become bounded chunks.
    Empty table: empty result. Other columns are ignored. At most 38 digits: a * n * 1000 may reach 10^38.
    """
    spark: SparkSession = documents.sparkSession
    totals, words, phrases = frequent_phrases(documents, least)
    split = F.split("phrase", " ")
    number = F.size(split)
    parts = words.unionByName(phrases).withColumnsRenamed({"phrase": "_part", "a": "_f"})

    cut = phrases.withColumn("_k", F.explode(F.sequence(F.lit(1), number - 1)))
    cut = cut.withColumns(
        {"_first": _part(split, F.lit(1), F.col("_k")), "_rest": _part(split, F.col("_k") + 1, number - F.col("_k"))}
    )
    for side, name in (("_first", "l"), ("_rest", "r")):
        cut = cut.join(parts.select("lang", F.col("_part").alias(side), F.col("_f").alias(name)), ["lang", side])
    wide = "decimal(38,0)"  # a bigint holds 19 digits
    cut = cut.join(totals, "lang").withColumn(
        "score", F.expr(f"(cast(a * 1000 as {wide}) * n) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")
    )
    best = F.min(F.struct("score", "_k", "l", "r", "n")).alias("_best")
    scored = cut.groupBy("lang", "phrase", "a").agg(best)
    scored = scored.select("lang", "phrase", "a", "_best.l", "_best.r", "_best.n", "_best.score")

    inner = F.array(_part(split, F.lit(1), number - 1), _part(split, F.lit(2), number - 1))
    covers = phrases.where(number > 2).select("lang", F.explode(inner).alias("phrase"), "a")
    covers = covers.groupBy("lang", "phrase").agg(F.max("a").alias("_longer"))
    kept = scored.join(covers, ["lang", "phrase"], "left")
    kept = kept.where(F.col("_longer").isNull() | (100 * F.col("_longer") < share * F.col("a"))).drop("_longer")

    # A language may have most phrases: its best are found in slices first, then among those.
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    slices = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sliced = kept.withColumn("_slice", F.pmod(F.xxhash64("phrase"), F.lit(slices)))
    best_of = F.row_number().over(Window.partitionBy("lang", "_slice").orderBy(*order))
    few = sliced.withColumn("rank", best_of).where(F.col("rank") <= top)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint"))
    return ranked.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
