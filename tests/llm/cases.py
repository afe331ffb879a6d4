"""Small tables with every hard case, and brute-force versions of the operators."""

import hashlib
import random
from collections import defaultdict

import numpy as np

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node string, block int, size long, text_sha string, rank int, label string, token string, `key` string, `start` long, n long, cell int, `__b` string"
EXTRA = ("x", 1, 2, "y", 3, "z", "t", "k", 5, 6, 7, "b")


def words(seed, n, vocabulary=400):
    r = random.Random(seed)
    return " ".join("".join(random.Random(r.randrange(vocabulary)).choices("abcdefghijklmnop", k=6)) + r.choice(["", "", ","]) for _ in range(n))


def texts():
    base = words(1, 120)
    parts = base.split(" ")
    near = " ".join(["CHANGED" if i == 60 else w for i, w in enumerate(parts)])
    passage = words(2, 30)
    return [
        base, base, near, base.upper(), None, "", " \t\n", "one two", "One TWO", "one two three four five", "ü ö é ☃ 日本語 　 x",
        words(3, 40) + " " + passage + " " + words(4, 40), words(5, 50) + " " + passage, passage, "z" * 200, "z" * 60, words(6, 3000),
        "12345 67890", "  lead and trail  ", "a\n\nb\r\nc", "the quick brown fox jumps over the lazy dog and runs away", "nul\0byte \x01\x02\x03 end", words(3, 40), "💡" * 40,
    ]


def rows(ids=None, langs=("en", "de", None), sources=("s1", None, "s2", "")):
    out = []
    for i, t in enumerate(texts()):
        out.append((i if ids is None else ids[i], t, langs[i % len(langs)], sources[i % len(sources)], None if i % 5 else len(t or ""), *EXTRA))
    out.append((len(out), None, None, None, None, *([None] * len(EXTRA))))
    return out


def write(spark, path, data, schema=SCHEMA, table="documents"):
    spark.createDataFrame(data, schema).write.mode("overwrite").parquet(f"{path}/{table}.parquet")
    return str(path)


def shingles(text):
    w = (text or "").encode()
    w = w.lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def jaccard(docs):
    """doc_id -> (set size, component) for unique ids."""
    sets = {i: shingles(t) for i, t in docs}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            if sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def repeated(docs, length=50):
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of each row."""
    first = {}
    data = [(i, (t or "").encode()) for i, t in docs]
    for i, t in data:
        for p in range(len(t) - length + 1):
            s = t[p : p + length]
            first[s] = min(i, first.get(s, i))
    out = []
    for i, t in data:
        mask = np.zeros(len(t) + 1, bool)
        for p in range(len(t) - length + 1):
            if first[t[p : p + length]] < i:
                mask[p : p + length] = True
        mask = mask[:-1]
        spans = int((np.diff(np.concatenate(([0], mask.astype(int)))) == 1).sum())
        kept = np.frombuffer(t, np.uint8)[~mask].tobytes()
        out.append((i, len(t), int(mask.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def top(vectors, k=10):
    """(query_id, rank, vec_id, score) over rows (vec_id, whole-number vector)."""
    out = []
    for at, (q, v) in enumerate(vectors):
        if q % 100 == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, x, strict=False)), i) for n, (i, x) in enumerate(vectors) if n != at)[:k]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(scored, 1)]
    return sorted(out)


def by_text(pairs):
    found = defaultdict(set)
    for t, x in pairs:
        found[t].add(x)
    return found
