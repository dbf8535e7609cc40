"""Token ids in files, compressed by a static range asymmetric numeral system.

The format is a folder of two Parquet tables, so that writing is atomic and any store Spark reaches will do:

* ``frequencies`` (id, frequency): the table all blocks share, made from the counts over all documents;
* ``blocks`` (part, block, doc_ids, lengths, segments): runs of whole documents in ascending order. ``part`` and
  ``block`` order them; ``lengths`` are the documents' numbers of ids; ``segments`` (symbols, states, words, checksum)
  hold the concatenated ids, each with the coder states it starts from (a checkpoint) and a crc32, so blocks and
  segments decode independently of each other.

A document's ids are made once and written down; after that counting, ordering and encoding work on ids.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from functools import lru_cache
from math import ceil
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from trolley.llm.rans import Coder, frequencies
from trolley.workspace import workspace

END = 1  # appended to each document
END_WORD = b""  # stands for it among the words of texts
KNOWN_WORDS = 1_000_000  # of the cache in a Python worker, about 150 MB; emptied when full
TOGETHER_BYTES = 1 << 23  # of texts whose words are looked up together; a longer text is alone
BLOCK_TOKENS = 1 << 18  # a block closes at the end of the document that reaches it
PART_TOKENS = 1 << 25  # a task's stretch of documents, 64 MB of 16-bit ids
BLOCK_SCHEMA = (
    "part int, block int, doc_ids array<bigint>, lengths array<bigint>,"
    " segments array<struct<symbols:int,states:binary,words:binary,checksum:bigint>>"
)


# Lower-case words of Latin letters: no normalising or splitting is left to do, the vocabulary's model takes them whole.
LETTERS = re.compile("[a-zß-öø-ɏ]+")
PROBES = ["the", "tokenization", "straße", "ñandú", "zażółć", "ęxqz"]
# Marks that end a word, after a letter (ASCII, À to ÿ) or digit: the tokenizer always parts the two, so "word." is "word"
# and ".".
MARKS = re.compile(
    rb"[.,!?;:#$%&*](?:(?<=[A-Za-z0-9].)|(?<=\xc3[\x80-\x96\x98-\xb6\xb8-\xbf].))[.,!?;:#$%&*]*(?=\s|\Z)"
)
SPECIAL = b"<|"  # begins the special tokens, which the tokenizer looks for before it lower-cases
# First bytes of U+0300 to U+037F, which hold all marks that compose with an ASCII letter.
COMBINING = re.compile(rb"[\xcc\xcd]")


def split_words(raw: bytes | None) -> list[bytes]:
    """Words between ASCII white space, marks after them apart. A-Z are lower-cased, which the tokenizer does anyway; only
    in texts with special tokens or combining marks, which it looks at before that, words that are not ASCII stay."""
    if not raw:
        return []
    if SPECIAL not in raw and (raw.isascii() or not COMBINING.search(raw)):
        return MARKS.sub(rb" \g<0>", raw.lower()).split()
    words = MARKS.sub(rb" \g<0>", raw).split()
    return [word.lower() if word.isascii() and SPECIAL not in word else word for word in words]


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones for themselves, the others, in
    order, from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b if b in printable else next(others)) for b in range(256)]


class WordIds(dict):
    """Ids of words as packed bytes, found when first asked for. The tokenizer drops white space and no token spans it, so
    a text's ids are its words' ids in order. Plain words go only through its model, if that gives the same for PROBES."""

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = "H" if self.kind.itemsize == 2 else "I"
        self.model, self.letters = self.tokenizer.model, byte_letters()
        self.direct = all(self._direct(word) == self._encode(word) for word in PROBES)

    def __missing__(self, word: bytes) -> bytes:
        if word == END_WORD:
            return self._packed([END])
        text = word.lower().decode("utf-8", "surrogatepass")
        # No letter of LETTERS, nor of A-Z, composes with another one, so here lower-casing may come first.
        if self.direct and LETTERS.fullmatch(text) and text == text.lower():
            ids = self._direct(text)
        else:
            ids = self._encode(word.decode("utf-8", "surrogatepass"))
        if len(self) >= KNOWN_WORDS:
            self.clear()
        self[word] = ids
        return ids

    def _direct(self, word: str) -> bytes:
        if not word.isascii():
            word = "".join(map(self.letters.__getitem__, word.encode()))
        return self._packed([token.id for token in self.model.tokenize(word)])

    def _encode(self, text: str) -> bytes:
        # The batch call of one text: it alone has a variant that leaves out the offsets.
        return self._packed(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids)

    def _packed(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{self.code}", *ids)

    def of_texts(self, texts: list[bytes | None]) -> pa.Array:
        """Ids of each whole text and the end id. Each different word is looked up once."""
        words, ends = [], [0]
        for text in texts:
            words += split_words(text)
            words.append(END_WORD)
            ends.append(len(words))
        coded = pa.array(words, pa.large_binary()).dictionary_encode()
        ids = pa.array([self[word] for word in coded.dictionary.to_pylist()], pa.large_binary()).take(coded.indices)
        _, starts, packed = ids.buffers()
        # The words' ids lie one after another, so a text's are those from its first word to the next text's.
        bounds = np.frombuffer(starts, np.int64, len(ids) + 1)[ends]
        return pa.Array.from_buffers(pa.large_binary(), len(texts), [None, pa.py_buffer(bounds), packed])


@lru_cache(maxsize=1)
def word_ids(path: str) -> WordIds:
    """One for all tasks of a Python worker, so that words are learnt once in each worker."""
    return WordIds(path)


def stretches(texts: list[bytes | None]) -> Iterator[tuple[int, int]]:
    """Runs of texts of TOGETHER_BYTES, or a little more by their last one."""
    begin = size = 0
    for end, text in enumerate(texts, 1):
        size += len(text or b"")
        if size >= TOGETHER_BYTES or end == len(texts):
            yield begin, end
            begin, size = end, 0


def tokenize(documents: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_tokens, ids`` (packed little-endian integers, the end id last)."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        words = word_ids(path)
        for batch in batches:
            doc_ids, texts = batch.column("doc_id").cast(pa.int64()), batch.column("raw").to_pylist()
            for begin, end in stretches(texts):
                ids = words.of_texts(texts[begin:end])
                size = pc.divide(pc.binary_length(ids), words.kind.itemsize)
                fields = [doc_ids[begin:end], size, ids.cast(pa.binary())]
                yield pa.RecordBatch.from_arrays(fields, ["doc_id", "n_tokens", "ids"])

    texts = documents.select("doc_id", F.col("text").cast("binary").alias("raw"))
    return texts.mapInArrow(encode, "doc_id bigint, n_tokens bigint, ids binary")


def count_ids(tokenized: DataFrame, vocabulary: int, kind: np.dtype) -> np.ndarray:
    """Occurrences of each id in all documents: a task sends one row for each id it met."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(vocabulary, np.int64)
        for batch in batches:
            for k in range(0, len(batch), 256):
                ids = np.frombuffer(b"".join(batch["ids"].iloc[k : k + 256]), kind)
                total += np.bincount(ids, minlength=vocabulary)
        present = np.flatnonzero(total)
        yield pd.DataFrame({"id": present, "n": total[present]})

    rows = tokenized.select("ids").mapInPandas(count, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
    counts = np.zeros(vocabulary, np.int64)
    for row in rows.collect():  # at most one for each id of the vocabulary
        counts[row["id"]] = row["n"]
    return counts


def write_tokens(documents: DataFrame, tokenizer_path: str, out: str) -> None:
    """Write the ids of every whole text of ``documents`` to ``out``, in ascending doc_id order.

    Null and empty texts have the end id alone. Null doc_id sorts first. Documents with the same id are ordered by
    number of ids, then by ids; rows alike in all three are interchangeable. A very long text is
    encoded whole in one task and is never parted between blocks. Empty table: no blocks. Other columns are
    ignored.
    """
    spark = documents.sparkSession
    own = WordIds(tokenizer_path)
    kind, vocabulary = own.kind, own.tokenizer.get_vocab_size()
    scratch = workspace(spark).fresh("tokens")
    tokenize(documents, tokenizer_path).write.option("compression", "zstd").parquet(scratch)
    tokenized = spark.read.schema("doc_id bigint, n_tokens bigint, ids binary").parquet(scratch)

    scaled = frequencies(count_ids(tokenized, vocabulary, kind))
    table = pd.DataFrame({"id": np.arange(vocabulary), "frequency": scaled})
    spark.createDataFrame(table, "id bigint, frequency bigint").coalesce(1).write.parquet(f"{out}/frequencies")
    sent = spark.sparkContext.broadcast(scaled)  # as large as the vocabulary

    total = tokenized.agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0]
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), ceil(total / PART_TOKENS))
    order = ["doc_id", "n_tokens", "ids"]
    ranged = tokenized.repartitionByRange(parts, "doc_id", "n_tokens").sortWithinPartitions(*order)

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder, block = Coder(sent.value), 0
        doc_ids, ids, size = [], [], 0

        def close() -> pd.DataFrame:
            lengths = [len(i) // kind.itemsize for i in ids]
            segments = coder.encode_segments(np.frombuffer(b"".join(ids), kind).astype(np.int64))
            names = ("symbols", "states", "words", "checksum")
            row = (part, block, doc_ids, lengths, [dict(zip(names, s, strict=True)) for s in segments])
            return pd.DataFrame([row], columns=["part", "block", "doc_ids", "lengths", "segments"])

        for batch in batches:
            for part, doc_id, packed in zip(batch["part"], batch["doc_id"].astype("Int64"), batch["ids"], strict=True):
                doc_ids.append(None if doc_id is pd.NA else int(doc_id))
                ids.append(packed)
                size += len(packed) // kind.itemsize
                if size >= BLOCK_TOKENS:
                    yield close()
                    block += 1
                    doc_ids, ids, size = [], [], 0
        if ids:
            yield close()

    numbered = ranged.select(F.spark_partition_id().alias("part"), "doc_id", "ids")
    numbered.mapInPandas(encode, BLOCK_SCHEMA).write.option("compression", "uncompressed").parquet(f"{out}/blocks")


def read_tokens(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """The documents in the files of ``path``: ``doc_id, start`` (number of ids before it), ``n_tokens, ids_crc32`` and,
    unless not wanted, ``ids`` (packed little-endian unsigned 32-bit integers, the end id last). A wrong checksum fails
    the read."""
    table = spark.read.parquet(f"{path}/frequencies").toPandas()
    scaled = np.zeros(len(table), np.int64)
    scaled[table["id"].to_numpy()] = table["frequency"].to_numpy()
    sent = spark.sparkContext.broadcast(scaled)

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = Coder(sent.value)
        for batch in batches:
            for row in batch.itertuples():
                ids = [coder.decode_segment(s["symbols"], s["states"], s["words"], s["checksum"]) for s in row.segments]
                packed = memoryview(np.concatenate(ids).astype("<u4").tobytes())
                ends = 4 * np.cumsum(row.lengths)
                own = [bytes(packed[e - 4 * n : e]) for e, n in zip(ends.tolist(), row.lengths, strict=True)]
                yield pd.DataFrame(
                    {
                        "part": row.part,
                        "block": row.block,
                        "place": range(len(own)),
                        "doc_id": pd.array(row.doc_ids, "Int64"),
                        "n_tokens": row.lengths,
                        "ids_crc32": [crc32(i) for i in own],
                        "ids": own if with_ids else None,
                    }
                )

    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks")
    words = F.aggregate("lengths", F.lit(0).cast("bigint"), lambda a, n: a + n)
    of_part = blocks.groupBy("part").agg(F.sum(words).alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = of_part.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("shift"))
    schema = "part int, block int, place int, doc_id bigint, n_tokens bigint, ids_crc32 bigint, ids binary"
    rows = blocks.mapInPandas(decode, schema)
    within = Window.partitionBy("part").orderBy("block", "place").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("within", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))
    # One row for each part: as many as the writer had tasks.
    rows = rows.join(F.broadcast(shifts), "part").withColumn("start", F.col("shift") + F.col("within"))
    return rows.select("doc_id", "start", "n_tokens", "ids_crc32", *["ids"] * with_ids)
