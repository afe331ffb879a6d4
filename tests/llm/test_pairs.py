"""N-gram join, suffix dedup, exact top-k and their building blocks against brute force."""

import random

import numpy as np
import pytest

from placewright.llm import exchange, knn, ngram_join, suffix_dedup
from placewright.llm.common import word_table
from placewright.llm.components import components
from tests.llm import cases


def test_ngram_join_hard_cases(spark, tmp_path):
    d = cases.write(spark, tmp_path, cases.rows())
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.op1_ngram_join(spark, d).collect()}
    assert got == cases.jaccard([(r[0], r[1]) for r in cases.rows()])


def test_ngram_join_near_copies_and_passages(spark, tmp_path):
    r = random.Random(5)
    docs, base = [], cases.words(9, 100).split(" ")
    for i in range(160):
        kind = i % 4
        if kind == 0:  # near copies of one text, some too far from each other
            w = list(base)
            for _ in range(r.randint(0, 5)):
                w[r.randrange(len(w))] = f"q{r.randrange(10**6)}"
            docs.append((i * 3 + 1, " ".join(w)))
        elif kind == 1:  # short texts made of a few common lines
            docs.append((i * 3 + 1, " ".join(cases.words(100 + r.randrange(4), 12) for _ in range(r.randint(1, 3)))))
        elif kind == 2:
            docs.append((i * 3 + 1, cases.words(500, 40) + " " + cases.words(1000 + i, r.randint(1, 15))))
        else:
            docs.append((i * 3 + 1, cases.words(2000 + i, r.randint(1, 60), 10**6)))
    r.shuffle(docs)
    d = cases.write(spark, tmp_path, docs, "doc_id long, text string")
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in ngram_join.op1_ngram_join(spark, d).collect()}
    assert got == cases.jaccard(docs)


def test_ngram_join_repeated_rows_and_null_ids(spark, tmp_path):
    text = cases.words(1, 30)
    d = cases.write(spark, tmp_path, [(7, text), (7, text), (None, text), (None, "alone"), (9, None)], "doc_id long, text string")
    got = sorted(((x.doc_id, x.component_id) for x in ngram_join.op1_ngram_join(spark, d).collect()), key=str)
    assert got == sorted([(7, 7), (7, 7), (None, 7), (None, None), (9, 9)], key=str)


def test_suffix_dedup_hard_cases(spark, tmp_path):
    d = cases.write(spark, tmp_path, cases.rows())
    got = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.op2_suffix_dedup(spark, d).collect())
    assert got == cases.repeated([(r[0], r[1]) for r in cases.rows()])


@pytest.mark.parametrize("often", [2, 400])
def test_suffix_dedup_passages_overlaps_and_ties(spark, tmp_path, monkeypatch, often):
    monkeypatch.setattr(suffix_dedup, "OFTEN", often)
    r, docs = random.Random(often), []
    common = [cases.words(k, 14) for k in range(3)]
    for _ in range(80):
        t = cases.words(r.randrange(30), r.randint(0, 40))
        for _ in range(r.randint(0, 2)):
            p = r.randint(0, len(t))
            t = t[:p] + r.choice(common) + t[p:]
        docs.append((r.randrange(60), t))
    d = cases.write(spark, tmp_path, docs, "doc_id long, text string")
    got = sorted((x.doc_id, x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in suffix_dedup.op2_suffix_dedup(spark, d).collect())
    assert got == cases.repeated(docs)


def test_suffix_filter_cuts_whole_characters(spark):
    shared = "日本語" * 30
    df = spark.createDataFrame([(1, "a" + shared, "x"), (2, "bé" + shared + "end", "y"), (3, shared, "z"), (4, None, "n"), (5, "", "e")], "doc_id long, text string, source string")
    got = {r.doc_id: (r.text, r.source) for r in suffix_dedup.without_repeats(df).collect()}
    assert got[1] == ("a" + shared, "x") and got[2] == ("béend", "y") and 3 not in got and got[4] == (None, "n") and got[5] == ("", "e")


def test_sorted_windows_equals_sorting():
    r = random.Random(1)
    for _ in range(20):
        parts = [bytes(r.choice(b"ab") for _ in range(r.randint(50, 84))) if r.random() < 0.6 else r.choice([b"\0", b"c", b"\xff"]) * r.randint(50, 84) for _ in range(r.randint(1, 20))]
        parts += [r.choice(parts)]
        size = np.array([len(p) for p in parts])
        order, new = suffix_dedup.sorted_windows(np.frombuffer(b"".join(parts), np.uint8), np.cumsum(size) - size, size - 49, size)
        windows = [p[i : i + 50] for p in parts for i in range(len(p) - 49)]
        found = [windows[i] for i in order]
        assert found == sorted(windows) and sorted(order.tolist()) == list(range(len(windows)))
        assert new.tolist() == [True] + [a != b for a, b in zip(found, found[1:], strict=False)]


def test_top_k_against_brute_force(spark, tmp_path):
    r = random.Random(3)
    data = {i: [r.uniform(-1, 1) for _ in range(8)] for i in range(0, 900, 3)}
    data |= {i: [0.5] * 8 for i in range(1, 120, 3)}  # many ties
    rows = [(i, v, "extra", 1) for i, v in data.items()]
    rows += [(2, None, "n", 2), (5, [0.1, None], "n", 2), (8, [float("nan")] * 8, "n", 2), (11, [float("inf")] * 8, "n", 2), (None, [0.1] * 8, None, None), (0, data[0], "again", 3), (14, [0.25], "short", 4)]
    d = cases.write(spark, tmp_path, rows, "vec_id long, embedding array<float>, `rank` string, cell int", "embeddings")
    ints = [(i, [int(np.floor(float(np.float32(x)) * 1024)) for x in v]) for i, v in [*data.items(), (14, [0.25]), (0, data[0])]]
    got = sorted((x.query_id, x["rank"], x.vec_id, x.score) for x in knn.op8_topk(spark, d).collect())
    assert got == cases.top(ints)


def test_top_k_repeated_ids_are_rows_of_their_own(spark, tmp_path):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (0, [0.0, 1.0]), (3, [0.5, 0.5]), (3, [2.0, 2.0]), (100, [-1.0, 4.0])]
    d = cases.write(spark, tmp_path, rows, "vec_id long, embedding array<float>", "embeddings")
    got = sorted((x.query_id, x["rank"], x.vec_id, x.score) for x in knn.op8_topk(spark, d).collect())
    assert got == cases.top([(i, [int(x * 1024) for x in v]) for i, v in rows])


def test_top_k_few_candidates(spark, tmp_path):
    d = cases.write(spark, tmp_path, [(0, [1.0, 2.0]), (100, [3.0, -1.0])], "vec_id long, embedding array<float>", "embeddings")
    assert sorted((x.query_id, x["rank"], x.vec_id) for x in knn.op8_topk(spark, d).collect()) == [(0, 1, 100), (100, 1, 0)]


@pytest.mark.parametrize(("query", "table", "schema"), [
    (ngram_join.op1_ngram_join, "documents", cases.SCHEMA), (suffix_dedup.op2_suffix_dedup, "documents", cases.SCHEMA), (knn.op8_topk, "embeddings", "vec_id long, embedding array<float>")])
def test_empty_tables(spark, tmp_path, query, table, schema):
    assert query(spark, cases.write(spark, tmp_path, [], schema, table)).count() == 0


def test_exchange_counts():
    r = np.random.default_rng(1)
    blocks = [r.integers(0, 2**63, 500, dtype=np.uint64) for _ in range(3)]
    blocks[1][:100] = blocks[0][:100]
    blocks[2][:300] = blocks[0][0]
    asked = [exchange.requests(i, b, 4) for i, b in enumerate(blocks)]
    import pyarrow as pa
    import pyarrow.compute as pc

    asked = pa.concat_tables(asked)
    answered = pa.concat_tables([exchange._answer(asked.filter(pc.equal(asked["part"], p))) for p in range(4)])
    whole = np.concatenate(blocks)
    for i, b in enumerate(blocks):
        got = exchange.read_answers(b, 4, answered.filter(pc.equal(answered["block"], i)))
        assert got.tolist() == [exchange.code_of(int((whole == x).sum())) for x in b]
    assert all(exchange.code_of(i) <= exchange.code_of(i + 1) for i in range(5000))


def test_components(spark):
    r = random.Random(2)
    links = [(r.randrange(60), r.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(20)]
    root = {x: x for e in links for x in e}

    def find(x):
        return x if root[x] == x else find(root[x])

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {x.node: x.label for x in components(spark.createDataFrame(links, "a long, b long")).collect()}
    loops = {a for a, b in links if a == b}
    assert got == {x: find(x) for x in root if any(x in e and e[0] != e[1] for e in links) or x not in loops}


def test_words_are_those_of_bytes_split():
    data = [b"a b\x0bc\xc2\xa0d\x1ce", b"", b" x ", b"\n"]
    _, first = word_table(data)
    assert np.diff(first).tolist() == [len(d.split()) for d in data]


def test_ngram_join_leader_with_very_many_members(spark, tmp_path, monkeypatch):
    """All documents near one leader, in groups of ten pairs: spread over many groups, nothing lost."""
    monkeypatch.setattr(ngram_join, "PAIRS_PER_GROUP", 10)
    base = cases.words(3, 60, 10**6).split(" ")
    docs = [(0, " ".join(base))]
    for i in range(1, 200):
        w = list(base)
        w[i % len(base)] = f"q{i}"
        docs.append((i, " ".join(w)))
    d = cases.write(spark, tmp_path, docs, "doc_id long, text string")
    seen = []
    inner = ngram_join.verified

    def noted(pairs, *rest):
        got = inner(pairs, *rest)
        seen.append(pairs.count())
        return got

    monkeypatch.setattr(ngram_join, "verified", noted)
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in ngram_join.op1_ngram_join(spark, d).collect()}
    assert got == cases.jaccard(docs) and max(seen) < 200 * 20  # not all pairs


def test_largest_ids_stay_apart_from_null_ids(spark, tmp_path):
    last, text = 2**63 - 1, cases.words(1, 40)
    d = cases.write(spark, tmp_path, [(last, text), (None, text), (last - 1, "other words only here")], "doc_id long, text string")
    got = {(x.doc_id, x.component_id) for x in ngram_join.op1_ngram_join(spark, d).collect()}
    assert got == {(last, last), (None, last), (last - 1, last - 1)}
    ids = sorted(str(x.doc_id) for x in suffix_dedup.op2_suffix_dedup(spark, d).collect())
    assert ids == sorted(map(str, (last, None, last - 1)))


def test_fragments_cut_the_global_order(spark):
    tokens = [np.sort(np.random.default_rng(i).integers(0, 1 << 62, 400, dtype=np.uint64)).tobytes() for i in range(6)]
    edges = ngram_join.fragment_edges(spark.createDataFrame([(t,) for t in tokens], "tokens binary"))
    parts = np.concatenate([[len(p) for p in np.split(s, np.searchsorted(s, edges, side="right"))] for s in (np.frombuffer(t, np.uint64) for t in tokens)]).reshape(6, -1).sum(0)
    assert (np.diff(edges.astype(float)) >= 0).all() and parts.sum() == 2400 and (parts > 500).all()


def test_pieces_of_a_text_have_each_window_once(monkeypatch):
    """Texts that cross a piece: the same windows with the same anchors as in one piece."""
    r = random.Random(3)
    texts = [bytes(r.choice(b"abc ") for _ in range(n)) for n in (700, 0, 49, 50, 2000)]
    buffer, edges = suffix_dedup._joined(texts)

    def anchors():
        out = {}
        for start, count, h, _ in suffix_dedup.segments(buffer, edges):
            for s, n, x in zip(start.tolist(), count.tolist(), h.tolist(), strict=True):
                for w in range(s, s + n):
                    assert w not in out
                    out[w] = x
        return out

    whole = anchors()
    monkeypatch.setattr(suffix_dedup, "PIECE", 128)
    assert anchors() == whole and len(whole) == sum(max(0, len(t) - 49) for t in texts)
