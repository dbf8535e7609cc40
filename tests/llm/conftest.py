import pytest

LONG = " ".join(f"word{i % 977} tail{i % 31}." for i in range(15_000))
SHARED = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and blank texts, a very long text, copies, repeated rows, marks only, text beyond ASCII."""
    return [
        (None, "A text without an id, of some words more.", "en", "a"),
        (1, None, "en", "a"),
        (2, "", None, "b"),
        (3, " \n\t ", "en", None),
        (4, LONG, "en", "a"),
        (5, f"Same text. {SHARED}", "en", "a"),
        (5, f"Same text. {SHARED}", "en", "a"),
        (6, f"Same text. {SHARED}", "fr", None),
        (7, "?!... ---", None, "b"),
        (8, "ÉCOLE été ÜBER straße 漢字 \U0001f600 naïve", "de", "c"),
        (9, SHARED.upper() + " and more", "de", "c"),
        (10, "x", "en", ""),
    ]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """The rows above as documents, with extra columns named like the operators' own."""
    extra = [
        "size", "source_size", "target", "taken", "shard", "slot", "score", "predicted", "held_out", "row_key", "words",
        "print", "component", "component_id", "hash", "position", "start", "size_", "window", "label", "rank", "terms",
        "law", "key", "n",
    ]
    rows = [(*row, len(row[1] or ""), *["x"] * len(extra)) for row in odd_rows]
    columns = ", ".join(f"{c} string" for c in extra)
    return spark.createDataFrame(
        rows, f"doc_id bigint, text string, lang string, source string, n_chars bigint, {columns}"
    )


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def small(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def benchmark(spark):
    rows = [(1, SHARED), (1, SHARED), (2, None), (3, ""), (None, "same text"), (4, "straße 漢字"), (5, "x")]
    return spark.createDataFrame(rows, "item_id bigint, text string")


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(i, i % 2, 0) for i in range(1, 11)] + [(4, 1, 0), (None, 1, 0), (8, None, None)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")
