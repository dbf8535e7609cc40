"""The contracts, word for word and row by row, for small inputs."""

import math
import re
from collections import Counter
from hashlib import md5, sha256

import xxhash

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def contamination(text, items):
    words, hit, ids = WORD.findall(lower(text)), set(), set()
    for item_id, item in items:
        own = WORD.findall(lower(item))
        for k in range(max(1, len(own) - 12)) if own else ():
            window = own[k : k + 13]
            for i in range(len(words) - len(window) + 1):
                if words[i : i + len(window)] == window:
                    hit.update(range(i, i + len(window)))
                    if item_id is not None:
                        ids.add(str(item_id))
    return len(words), len(hit), sorted(ids), bool(hit) and 20 * len(hit) >= len(words)


def mix(rows, weights=(1, 2, 3), most=3, seed=5):
    """rows: (doc_id, text, source) -> Counter of (doc_id, source, size, taken), and targets by source."""
    sized = [(i, len(SPACED.findall(t or "")), s) for i, t, s in rows]
    sources = sorted({s for *_, s in sized}, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(sources)}
    size = {s: sum(n for _, n, o in sized if o == s) for s in sources}
    target, full = {}, set()
    while True:
        left = sum(size.values()) - sum(most * size[s] for s in full)
        share = sum(weight[s] for s in sources if s not in full)
        target = {s: most * size[s] if s in full else weight[s] * left / share for s in sources}
        above = {s for s in sources if s not in full and target[s] >= most * size[s]}
        if not above or above | full == set(sources):
            break
        full |= above
    out = Counter()
    for s in sources:
        own = [(md5(f"{seed}:{'' if i is None else i}".encode()).hexdigest(), i, n) for i, n, o in sized if o == s]
        budget, before = math.floor(target[s] + 0.5), 0
        for _, i, n in sorted(own, key=lambda x: (x[0], x[1] or 0, x[2])):
            epochs, rest = divmod(budget, size[s]) if size[s] else (0, 0)
            out[(i, s, n, epochs * n + max(0, min(n, rest - before)))] += 1
            before += n
    return out, target


def fingerprint(text):
    words = SPACED.findall(lower(text))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]).encode(), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, budget=4):
    """Index of the first row of each row's component."""
    label = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= budget and label[i] != label[j]:
                new, old = sorted((label[i], label[j]))
                label = [new if x == old else x for x in label]
    return label


ASSIGN = re.compile(
    r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
    r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def secrets(text):
    text = text or ""
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 8]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in sorted(found))


def digest(spans):
    return sha256(spans.encode()).hexdigest()


def bm25(rows, queries, k=10):
    """rows: (doc_id, text) -> for each query id the ranking (doc_id, score)."""
    bags = [Counter(WORD.findall(lower(t))) for _, t in rows]
    length = [sum(b.values()) for b in bags]
    n, mean = len(rows), sum(length) / max(len(rows), 1)
    df = Counter(w for b in bags for w in b)
    out = {}
    for q in queries:
        bag = next(b for (i, _), b in zip(rows, bags) if i == q)
        scores = []
        for (i, _), b, m in zip(rows, bags, length):
            s = sum(
                math.log1p((n - df[w] + 0.5) / (df[w] + 0.5)) * b[w] * 2.2 / (b[w] + 1.2 * (0.25 + 0.75 * m / mean))
                for w in bag if w in b
            )
            if s > 0:
                scores.append((-round(s, 8), math.inf if i is None else i))
        out[q] = [(i, -s) for s, i in sorted(scores)[:k]]
    return out


def infill(doc_id, text):
    """n, form, output, prefix_chars, middle_chars."""
    text = text or ""
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    digest = sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[k : k + 8], 16) for k in range(0, 32, 8)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return len(units), "plain", text, None, None
    if h[3] % 100 < 80:
        return len(units), "spm", f"<S>{suffix}<P>{prefix}<M>{middle}", len(prefix), len(middle)
    return len(units), "psm", f"<P>{prefix}<S>{suffix}<M>{middle}", len(prefix), len(middle)


def phrase_counts(texts, longest=5):
    """Occurrences of every phrase of 1 to ``longest`` words, as tuples of words."""
    count = Counter()
    for text in texts:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, longest + 1):
                count.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    return count


def collocations(rows, least=100, share=100, top=2000):
    """rows: (text, lang) -> tuples lang, rank, phrase, a, l, r, n, score."""
    out = []
    for lang in {lang or "und" for _, lang in rows}:
        f = phrase_counts(t for t, own in rows if (own or "und") == lang)
        n = sum(c for p, c in f.items() if len(p) == 1)
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        covered = {p[i:j] for p, a in candidates.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
                   if j - i < len(p) and 100 * a >= share * f[p[i:j]]}
        scored = []
        for p, a in candidates.items():
            cuts = [(1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            if p not in covered:
                scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, rank, phrase.decode(), -a, left, right, n, -score)
                for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out)


def shingle_set(text):
    words = SPACED.findall(lower(text))
    if len(words) < 3:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 3]) for i in range(len(words) - 2)}


def similar(texts, percent=85):
    """Index of the first text of each text's component."""
    sets = [shingle_set(t) for t in texts]
    label = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]) and label[i] != label[j]:
                new, old = sorted((label[i], label[j]))
                label = [new if x == old else x for x in label]
    return label
