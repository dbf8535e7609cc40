"""The registered queries themselves, on the smallest tables, against brute force."""

from collections import Counter, defaultdict
from zlib import crc32

import __spark_entry__ as entry_points
import brute
import numpy as np
import pytest
from tokenizers import Tokenizer

from trolley.llm import language, quality, sharding

public_tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def documents(small):
    return {r.doc_id: r for r in small.collect()}


def ask(spark, sf_dir, name, documents):
    rows = entry_points.queries()[name](spark, sf_dir).collect()
    assert len(rows) == len(documents) and {r.doc_id for r in rows} == set(documents)
    return {r.doc_id: r for r in rows}


def test_op2(spark, sf_dir, documents):
    found = ask(spark, sf_dir, "op2_tokens", documents)
    tokenizer, start = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 0
    for doc_id in sorted(documents):
        ids = [*tokenizer.encode(documents[doc_id].text or "", add_special_tokens=False).ids, 1]
        row = found[doc_id]
        assert (row.start, row.n_tokens) == (start, len(ids))
        assert row.ids_crc32 == crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def gram_vector(codes):
    """Letters' vectors, each rotated once for every letter after it, multiplied."""
    out = [1] * language.DIM
    for k, code in enumerate(codes):
        letter = np.random.default_rng([language.SEED, code]).choice(np.array([-1, 1], np.float32), language.DIM)
        shift = len(codes) - 1 - k
        out = [a * letter[(i - shift) % language.DIM] for i, a in enumerate(out)]
    return np.array(out)


def test_op3(spark, sf_dir, documents):
    known, learnt, vectors = {}, defaultdict(lambda: np.zeros(language.DIM)), {}
    for r in documents.values():
        letters = "".join(c if c.isalpha() else " " for c in (r.text or "").lower())
        codes = [0 if c == " " else ord(c) for c in " " + " ".join(letters.split()) + " "]
        if len(codes) < 3:
            continue
        total = np.zeros(language.DIM)
        for gram, n in Counter(zip(codes, codes[1:], codes[2:])).items():
            if gram not in known:
                known[gram] = gram_vector(gram)
            total += n * known[gram]
        vectors[r.doc_id] = total / np.linalg.norm(total)
        if r.lang is not None and crc32(str(r.doc_id).encode()) % 4 != 2:
            learnt[r.lang] += vectors[r.doc_id]
    for doc_id, row in ask(spark, sf_dir, "op3_language", documents).items():
        assert row.held_out == (crc32(str(doc_id).encode()) % 4 == 2)
        if doc_id not in vectors:
            assert (row.lang_pred, row.score) == ("und", 0)
            continue
        cosine = {k: float(v @ vectors[doc_id] / np.linalg.norm(v)) for k, v in learnt.items()}
        best = max(cosine.values())
        assert cosine[row.lang_pred] > best - 1e-5 and row.score == pytest.approx(best, abs=1e-5)


def test_op6(spark, sf_dir, documents):
    queries = [i for i in documents if i % 20 == 0]
    expected = brute.bm25([(i, r.text) for i, r in documents.items()], queries)
    found = defaultdict(list)
    for r in entry_points.queries()["op6_search"](spark, sf_dir).orderBy("query_id", "rank").collect():
        found[r.query_id].append((r.rank, r.doc_id, r.score))
    assert set(found) == {q for q in queries if expected[q]}
    for q, rows in found.items():
        assert [(rank, doc) for rank, doc, _ in rows] == [(k + 1, d) for k, (d, _) in enumerate(expected[q])]
        assert [s for *_, s in rows] == pytest.approx([s for _, s in expected[q]], abs=2e-6)


def test_op7(spark, sf_dir, documents):
    for doc_id, row in ask(spark, sf_dir, "op7_secrets", documents).items():
        base = brute.secrets(documents[doc_id].text)
        kinds = Counter(span.split(":")[0] for span in base.split(",") if span)
        assert (row.n_assign, row.n_access, row.n_hex) == (kinds["assign"], kinds["access"], kinds["hex"])
        assert row.base_sha256 == brute.digest(base)
        assert set(filter(None, base.split(","))) <= set(row.spans.split(","))


def test_op8(spark, sf_dir, documents):
    """Shards are runs of one sorted list, cut as near to equal bytes as the list and the tolerance allow."""
    found = ask(spark, sf_dir, "op8_shards", documents)
    for doc_id, row in found.items():
        text = (documents[doc_id].text or "").encode()
        assert (row.size, row.text_crc32, row.law, row.grown_shard) == (len(text) + 16, crc32(text), "bytes", None)
    half = sharding.KEY_DIGITS // 2
    key = {i: brute.md5((r.text or "").encode()).hexdigest()[:half] + brute.md5(str(i).encode()).hexdigest()[:half]
           for i, r in documents.items()}
    order = sorted(documents, key=key.get)
    places = [(found[i].shard, found[i].slot) for i in order]
    assert places == sorted(places)
    assert [slot for _, slot in places] == [n for s in range(40) for n in range(Counter(p[0] for p in places)[s])]
    edges = [0, *np.cumsum([found[i].size for i in order]).tolist()]
    share = edges[-1] / 40
    for cut in range(1, 40):
        below = edges[sum(s < cut for s, _ in places)]
        nearest = min(abs(e - cut * share) for e in edges)
        assert abs(below - cut * share) <= max(nearest, 0.002 * share) + 1e-6


def test_op9(spark, sf_dir, documents):
    for doc_id, row in ask(spark, sf_dir, "op9_quality", documents).items():
        assert row.held_out == (crc32(str(doc_id).encode()) % 5 == 0)
        assert 0 <= row.score <= 1 and row.predicted == (row.score >= 0.3)


def test_ftrl_in_plain_loops(documents):
    how = quality.Training(passes=3)
    texts = [r.text for r in list(documents.values())[:25]] + [None, ""]
    labels = [k % 2 for k in range(len(texts))]
    features, z, n = quality.Features(), defaultdict(float), defaultdict(float)

    def weight(i):
        if abs(z[i]) <= how.l1:
            return 0.0
        return -(z[i] - how.l1 * np.sign(z[i])) / ((how.beta + n[i] ** 0.5) / how.alpha + how.l2)

    for _ in range(how.passes):
        for text, label in zip(texts, labels):
            row = list(zip(*(v.tolist() for v in features.of(text))))
            w = {i: weight(i) for i, _ in row}
            p = 1 / (1 + np.exp(-sum(w[i] * x for i, x in row)))
            for i, x in row:
                g = (p - label) * x
                z[i] += g - ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / how.alpha * w[i]
                n[i] += g * g
    trained = quality.train(texts, labels, how)
    assert set(np.flatnonzero(trained)) == {i for i in z if weight(i)}
    assert all(trained[i] == pytest.approx(weight(i), abs=1e-9) for i in z)


def test_op10(spark, sf_dir, documents):
    ids = sorted(documents)
    prints = [brute.fingerprint(documents[i].text) for i in ids]
    label = brute.components(prints)
    found = ask(spark, sf_dir, "op10_simhash", documents)
    for k, i in enumerate(ids):
        assert (found[i].fingerprint, found[i].component_id) == (f"{prints[k]:016x}", ids[label[k]])
