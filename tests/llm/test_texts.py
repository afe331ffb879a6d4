"""Codec, media, language ID, mixing, sharding, URL lists, WARC and the pipeline."""

import datetime as dt
import hashlib
import heapq
import json
import random
import zlib

import numpy as np
import pytest

import corpus_pipeline
from placewright.llm import language_id, media, mixing, piece_codec, sharding, url_lists, warc
from tests.llm import cases


def rows_of(df):
    return {r.doc_id: r for r in df.collect()}


# -- codec ----------------------------------------------------------------------------------------------


def test_codec_equals_the_library(spark, tmp_path):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=piece_codec.default_model())
    got = rows_of(piece_codec.op5_sentencepiece(spark, cases.write(spark, tmp_path, cases.rows())))
    for r in cases.rows():
        ids = model.encode(r[1] or "", add_eos=True)
        assert got[r[0]].n_tokens == len(ids)
        assert got[r[0]].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[r[0]].decoded_sha256 == hashlib.sha256(model.decode(ids).encode()).hexdigest()


@pytest.mark.parametrize("text", ["a  b", " a", "a ", "\n a\n\nb", "é☃\n　x ▁y", "▁▁", "①ﬁ", "a\0b", "🙂 🙂x", ""])
def test_spans_tile_the_text(text):
    c = piece_codec.PieceCodec()
    ids, begin, end = c.encode(text)
    data = text.encode()
    assert ids.tolist() == c.model.encode(text, add_eos=True)
    assert end[-1] == len(data) and (begin[1:] == end[:-1]).all() and (begin <= end).all() and begin[0] == 0
    for i, a, b in zip(ids, begin, end, strict=True):
        piece = c.pieces[i]
        if not c.model.is_byte(int(i)) and i != c.end[0] and a > 0:
            assert data[a:b].decode().replace(" ", "▁") == piece


def test_column_round_trip(spark):
    df = spark.createDataFrame([(1, "hello world", "old"), (2, None, None)], "doc_id long, text string, piece_ids string")
    got = {r.doc_id: r for r in piece_codec.decode_pieces(piece_codec.encode_pieces(df)).collect()}
    assert got[1].decoded == "hello world" and got[2].decoded == "" and got[1].piece_end[-1] == 11


def test_compiled_map_takes_the_longest_prefix():
    # a double array with the keys "ab" -> "X", "abc" -> "YZ", laid out by hand through a small builder
    keys = {b"ab": b"X", b"abc": b"YZ"}
    strings, at = b"", {}
    for k, v in keys.items():
        at[k] = len(strings)
        strings += v + b"\0"
    units = [0] * 1024

    def place(node, prefix, base):
        """Children of a node stand at base ^ byte; the value of a key at base ^ 0."""
        units[node] |= (node ^ base) << 10
        if prefix in keys:
            units[node] |= 1 << 8
            units[base] = at[prefix] | 1 << 31
        for byte in sorted({k[len(prefix)] for k in keys if k.startswith(prefix) and len(k) > len(prefix)}):
            child = base ^ byte
            units[child] |= byte
            place(child, prefix + bytes([byte]), 256 * (len(prefix) + 2) % 1024 or 256)

    place(0, b"", 256)
    import struct

    blob = struct.pack("<I", 4 * len(units)) + struct.pack(f"<{len(units)}I", *units) + strings
    m = piece_codec.CharMap(blob)
    assert m.longest(b"abcd", 0) == (3, b"YZ") and m.longest(b"xab", 1) == (2, b"X") and m.longest(b"a", 0) is None
    c = piece_codec.PieceCodec()
    c.map, c.squeeze, c.plain = m, True, False
    norm, origin = c.normalize("  abc ab  d ")
    assert norm.decode() == "▁YZ▁X▁d" and origin == [2, 2, 2, 2, 2, 5, 5, 5, 6, 8, 8, 8, 10, 11] and len(origin) == len(norm) + 1


# -- media ----------------------------------------------------------------------------------------------


def test_media_round_trip(spark, tmp_path):
    got = rows_of(media.op3_media(spark, cases.write(spark, tmp_path, cases.rows())))
    for r in cases.rows():
        data = (r[1] or "").encode()
        padded = data + bytes(-len(data) % 64 or (0 if data else 64))
        x = got[r[0]]
        assert (x.n_bytes, x.payload_bytes, x.payload_sha256, x.tail_crc32) == (len(data), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-64:]))
    assert (got[0].media_sha256, got[0].feature) == (got[1].media_sha256, got[1].feature)


def test_media_odd_payloads():
    r = random.Random(4)
    payloads = [bytes(64), bytes([1]) * 64, bytes(range(64)), bytes(64 * 300), bytes(r.choice([0, 0, 0, 1, 2, 3, 255]) for _ in range(64 * 50)), bytes(r.randrange(256) for _ in range(64 * 700)), bytes(r.choice([0] * 40 + [1, 5]) for _ in range(64 * 90))]
    files = media.store_bytes(payloads)
    images, coef = media.coefficients(files)
    assert [media.stored_payload(i, coef) for i in images] == payloads
    for f, image in zip(files, images, strict=True):  # alone or in a batch, the same
        one, own = media.coefficients([f])
        assert (media.rgb(one[0], own) == media.rgb(image, coef)).all()


def test_media_is_what_java_decodes(spark):
    """The tensor agrees with the JDK's own decoder, but for rounding and chroma interpolation."""
    payload = bytes(min(255, 3 + k * 0) if k % 64 else 200 for k in range(64 * 24))  # strong DC, weak AC
    (data,) = media.store_bytes([payload])
    images, coef = media.coefficients([data])
    own = media.rgb(images[0], coef).astype(int)
    jvm = spark._jvm
    image = jvm.javax.imageio.ImageIO.read(jvm.java.io.ByteArrayInputStream(bytearray(data)))
    assert (image.getWidth(), image.getHeight()) == (own.shape[1], own.shape[0])
    far = []
    for y in range(0, own.shape[0], 5):
        for x in range(0, own.shape[1], 7):
            p = image.getRGB(x, y) & 0xFFFFFF
            far.append(max(abs((p >> 16 & 255) - own[y, x, 0]), abs((p >> 8 & 255) - own[y, x, 1]), abs((p & 255) - own[y, x, 2])))
    assert np.median(far) <= 2 and np.quantile(far, 0.9) <= 12


def test_media_columns(spark):
    df = spark.createDataFrame([(1, "abc"), (2, None)], "doc_id long, text string")
    stored = media.media_column(df, "doc_id", "text")
    bad = spark.createDataFrame([(3, bytearray(b"junk")), (4, None)], "doc_id long, media binary")
    got = {r.doc_id: r for r in media.tensor_column(stored.unionByName(bad), "doc_id").collect()}
    assert got[1].height == 16 and got[1].width == 16 and len(got[1].rgb) == 768 and got[3].rgb is None and got[4].rgb is None
    with pytest.raises(ValueError):
        media.parse(b"junk")


def test_media_table_and_features_against_plain_decoding(spark):
    docs = [(i, t) for i, t in enumerate(cases.texts())] + [(None, "x"), (3, None), (0, cases.texts()[0])]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = media.media_table(df).collect()
    assert len(got) == len(docs)
    for x in got:
        images, coef = media.coefficients([bytes(x.media)])
        assert media.stored_payload(images[0], coef) == bytes(x.payload) and media.rgb(images[0], coef).tobytes() == bytes(x.rgb)
        assert (x.height, x.width) == (images[0].height, images[0].width)
    digests = sorted((str(x.doc_id), x.media_sha256, x.media_bytes, x.feature) for x in media.media_digests(df).collect())
    want = []
    for x in got:
        means = np.frombuffer(bytes(x.rgb), np.uint8).reshape(-1, 3).astype(float).mean(0)
        want.append((str(x.doc_id), hashlib.sha256(bytes(x.media)).hexdigest(), len(x.media), f"{x.width}x{x.height}:" + ",".join(f"{m:.6f}" for m in means)))
    assert [d[:3] for d in digests] == [w[:3] for w in sorted(want)]
    for d, w in zip(digests, sorted(want), strict=True):
        assert d[3].split(":")[0] == w[3].split(":")[0] and np.allclose([float(v) for v in d[3].split(":")[1].split(",")], [float(v) for v in w[3].split(":")[1].split(",")], atol=1e-5)


def test_media_texts_beyond_one_batch(spark, monkeypatch):
    """Texts that cross the batch size, alone and together, are stored as in one piece."""
    texts = [b"ab" * 3000, b"", b"c" * 9000, b"d", b"e" * 20000]
    whole = media.store_bytes([media.pad(t) for t in texts])
    monkeypatch.setattr(media, "BATCH_BYTES", 4096)
    assert [f for part in media.chunks([media.pad(t) for t in texts], media.BATCH_BYTES) for f in media.store_bytes([media.pad(texts[i]) for i in part])] == whole
    got = list(media._decoded([None, whole[0], b"junk", None, whole[2], None]))
    assert [g is not None for g in got] == [False, True, False, False, True, False]
    assert media.stored_payload(*got[4]) == media.pad(texts[2])


def test_media_bad_files_are_nulls(spark):
    (good,) = media.store_bytes([media.pad(b"good")])
    at = good.index(b"\xff\xc2")
    zero = good[: at + 11] + b"\x00" + good[at + 12 :]  # a sampling factor of 0
    huge = good[: at + 5] + b"\xff\xff\xff\xff" + good[at + 9 :]  # 65,535 x 65,535
    files = [(1, good), (2, zero), (3, huge), (4, good[: len(good) // 2]), (5, b""), (6, None), (7, good[:at]), (8, good)]
    got = {r.doc_id: r.rgb for r in media.tensor_column(spark.createDataFrame(files, "doc_id long, media binary"), "doc_id").collect()}
    assert got[1] is not None and got[1] == got[8] and all(got[k] is None for k in (2, 3, 5, 6, 7))


def test_media_reads_files_of_another_writer(spark):
    """Progressive files written by the JDK, whose refining scans and sampling differ from ours."""
    jvm = spark._jvm
    image = jvm.java.awt.image.BufferedImage(37, 29, 1)
    for y in range(29):
        for x in range(37):
            image.setRGB(x, y, (x * 6 << 16) | (y * 8 << 8) | (x * y % 256))
    writer = jvm.javax.imageio.ImageIO.getImageWritersByFormatName("jpeg").next()
    param = writer.getDefaultWriteParam()
    param.setProgressiveMode(1)
    out = jvm.java.io.ByteArrayOutputStream()
    stream = jvm.javax.imageio.ImageIO.createImageOutputStream(out)
    writer.setOutput(stream)
    writer.write(None, jvm.javax.imageio.IIOImage(image, None, None), param)
    stream.flush()
    data = bytes(out.toByteArray())
    got = media.tensor_column(spark.createDataFrame([(1, data)], "doc_id long, media binary"), "doc_id").first()
    own = np.frombuffer(bytes(got.rgb), np.uint8).reshape(29, 37, 3).astype(int)
    back = jvm.javax.imageio.ImageIO.read(jvm.java.io.ByteArrayInputStream(bytearray(data)))
    theirs = np.array([[[(back.getRGB(x, y) >> s) & 255 for s in (16, 8, 0)] for x in range(37)] for y in range(29)])
    luma = np.array([0.299, 0.587, 0.114])
    assert np.quantile(np.abs((own - theirs) @ luma), 0.95) <= 4


# -- language ID ----------------------------------------------------------------------------------------


def corpus(n):
    r = random.Random(8)
    forms = {"en": ["the", "thing", "wherever", "ought", "this", "with", "ing"], "fr": ["les", "quelle", "oiseau", "jeux", "être", "dans", "aux"], "de": ["der", "schrift", "zwischen", "ich", "über", "und", "keit"]}
    return [(i, " ".join(r.choice(forms[lang]) + r.choice(["", "s", "n"]) for _ in range(r.randint(4, 40))), lang) for i in range(n) for lang in [r.choice(list(forms))]]


def test_language_held_out_accuracy(spark, tmp_path):
    data = corpus(400) + [(1000, None, "en"), (1001, "123 456 !", "fr"), (1002, "", None), (1003, "the thing", None), (None, "les oiseaux", "fr"), (3, "der und", "de")]
    d = cases.write(spark, tmp_path, [(*x, "s", 1.0, 2) for x in data], "doc_id long, text string, lang string, source string, score double, held_out int")
    got = language_id.op9_language_id(spark, d).collect()
    truth = {i: lang for i, _, lang in data[:400]}
    held = [x for x in got if x.held_out and x.doc_id in truth]
    assert len(got) == len(data) and len(held) > 50
    assert all(x.held_out == (zlib.crc32(str(x.doc_id).encode()) % 5 == 0) for x in got if x.doc_id is not None)
    assert sum(x.lang_pred == truth[x.doc_id] for x in held) / len(held) > 0.95
    by = {x.doc_id: x for x in got}
    assert [by[i].lang_pred for i in (1000, 1001, 1002, 1003)] == ["und", "und", "und", "en"] and by[1000].score == 0.0
    assert all(0 <= x.score <= 1 for x in got)


def test_forward_sums_all_segmentations():
    pieces = language_id.Pieces()
    prob = np.random.default_rng(1).uniform(0, 0.01, (len(pieces.names) + 1, 2))
    prob[0] = 0
    rows = {p: i for i, p in enumerate(pieces.names, 1)}

    def total(word):
        if not word:
            return np.ones(2)
        out = np.zeros(2)
        for k in range(1, min(len(word), pieces.longest) + 1):
            p = prob[rows[word[:k]]] if word[:k] in rows else (language_id.UNKNOWN if k == 1 else 0)
            out = out + p * total(word[k:])
        return out

    for word in ("the", "being", "étrange", "☃x"):
        languages = language_id.Languages(["a", "b"], np.zeros(2), prob)
        assert np.allclose(languages.log_likelihood([word], pieces)[0], np.log(total("▁" + word)))
    long = languages.log_likelihood(["ab" * 400, "the"], pieces)
    assert np.isfinite(long).all() and (long[0] < -700).all()


def test_forward_sums_all_segmentations_of_long_words():
    pieces = language_id.Pieces()
    prob = np.random.default_rng(2).uniform(0, 0.01, (len(pieces.names) + 1, 2))
    prob[0] = 0
    rows = {p: i for i, p in enumerate(pieces.names, 1)}
    languages = language_id.Languages(["a", "b"], np.zeros(2), prob)

    def p(piece):
        return prob[rows[piece]] if piece in rows else np.full(2, language_id.UNKNOWN if len(piece) == 1 else 0.0)

    for n in [*range(14, 41), 90]:
        word = "▁" + ("donaudampfschifffahrtsgesellschaft" * 3)[:n]
        ahead, behind = [np.ones(2)], [np.ones(2)]  # sums over segmentations of each prefix and each suffix
        for k in range(1, len(word) + 1):
            ahead.append(sum(ahead[k - m] * p(word[k - m : k]) for m in range(1, min(k, pieces.longest) + 1)))
            behind.append(sum(behind[k - m] * p(word[len(word) - k : len(word) - k + m]) for m in range(1, min(k, pieces.longest) + 1)))
        assert np.allclose(languages.log_likelihood([word[1:]], pieces)[0], np.log(ahead[-1]), rtol=1e-9)
        ((_, codes),) = language_id._groups([word[1:]])
        b, scale = language_id._forward(pieces.rows(codes), prob, reverse=True)
        assert np.allclose((np.log(b) + scale)[0, ::-1], np.log(behind), rtol=1e-9)


def test_expected_counts_against_all_segmentations():
    """The expectation step gives what listing every segmentation of every word gives."""
    pieces = language_id.Pieces()
    prob = np.random.default_rng(3).uniform(0, 0.01, (len(pieces.names) + 1, 2))
    prob[0] = 0
    rows = {p: i for i, p in enumerate(pieces.names, 1)}

    def segmentations(word):
        if not word:
            yield []
        for k in range(1, min(len(word), pieces.longest) + 1):
            if word[:k] in rows or k == 1:
                yield from ([word[:k], *rest] for rest in segmentations(word[k:]))

    counts = [("a", "the", 3), ("b", "the", 1), ("a", "being", 2), ("b", "☃x", 5), ("b", "étrange", 1)]
    words, weight = language_id.weights_of(counts, ["a", "b"])
    want = np.zeros((len(pieces.names) + 1, 2))
    for w, n in zip(words, weight, strict=True):
        found = [(s, np.prod([prob[rows[p]] if p in rows else np.full(2, language_id.UNKNOWN) for p in s], axis=0)) for s in segmentations("▁" + w)]
        total = sum(p for _, p in found)
        for s, p in found:
            for piece in s:
                if piece in rows:
                    want[rows[piece]] += n * p / total
    assert np.allclose(language_id.expected(words, weight, prob, pieces), want, rtol=1e-9)


def test_prediction_is_the_posterior(spark, monkeypatch):
    """Languages and scores by a fit of its own: counts of whole tables, substrings first, then expectations."""
    data = corpus(120) + [(None, "les oiseaux", "fr"), (5, None, "en"), (7, "the", None)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string")
    got = {(x.doc_id, x.lang_pred): x.score for x in language_id.predict(docs, language_id.learn(docs), ["doc_id"]).collect()}
    taught = [(t, lang) for i, t, lang in data if lang and t and not (i is not None and zlib.crc32(str(i).encode()) % 5 == 0)]
    counts = {}
    for t, lang in taught:
        for w in language_id.words_of(t):
            counts[lang, w] = counts.get((lang, w), 0) + 1
    names = sorted({lang for _, lang in taught})
    pieces = language_id.Pieces()
    words, weight = language_id.weights_of([(lang, w, n) for (lang, w), n in sorted(counts.items())], names)
    prob = None
    for _ in range(language_id.ROUNDS + 1):
        prob = language_id.maximised(language_id.expected(words, weight, prob, pieces))
    prior = np.log([sum(x == n for _, x in taught) for n in names]) - np.log(len(taught))
    model = language_id.Languages(names, prior, prob)
    for i, t, _ in data:
        if t is None:
            assert got[i, "und"] == 0
            continue
        total = prior + model.log_likelihood(language_id.words_of(t), pieces).sum(0)
        post = np.exp(total - total.max()) / np.exp(total - total.max()).sum()
        assert abs(got[i, names[int(post.argmax())]] - post.max()) < 1e-6


# -- mixing ---------------------------------------------------------------------------------------------


def test_targets():
    assert mixing.targets([("a", 80), ("b", 80), ("c", 80)]) == {"a": 150.0, "b": 60.0, "c": 30.0}
    got = mixing.targets([("a", 10), ("b", 500), (None, 300), ("", 0)])  # order: '', a, b, null
    assert got[""] == 0 and got["a"] == 30
    assert abs(sum(got.values()) - 810) < 1e-6 and all(got[k] <= 3 * n + 1e-9 for k, n in (("a", 10), ("b", 500), (None, 300), ("", 0)))
    assert mixing.targets([]) == {} and mixing.targets([("x", 0)]) == {"x": 0.0}


def test_permutation_and_draws():
    for n in (1, 2, 3, 17, 1000):
        assert sorted(mixing.permute(np.arange(n), n, 5).tolist()) == list(range(n))
    assert mixing.permute(np.arange(100), 100, 1).tolist() != mixing.permute(np.arange(100), 100, 2).tolist()
    dealt = mixing.draws([500, 300, 0, 7], 16)
    assert dealt.sum(0).tolist() == [500, 300, 0, 7] and max(dealt.sum(1)) - min(dealt.sum(1)) <= 1 and (dealt >= 0).all()


@pytest.mark.parametrize("block_words", [7, 1024])
def test_mix(spark, block_words):
    df = spark.createDataFrame(cases.rows(), cases.SCHEMA)
    got = mixing.mix(df, block_words=block_words).collect()
    truth = {r[0]: (len((r[1] or "").encode().split()), r[3]) for r in cases.rows()}
    size, taken = {}, {}
    assert len(got) == len(truth)
    for x in got:
        n, s = truth[x.doc_id]
        assert x.size == n and 0 <= x.taken <= 3 * n
        size[s], taken[s] = size.get(s, 0) + n, taken.get(s, 0) + x.taken
    goal = mixing.targets(list(size.items()))
    for x in got:
        s = truth[x.doc_id][1]
        assert x.source_size == size[s] and x.target == goal[s]
    assert all(abs(taken[s] - goal[s]) <= 0.5 for s in size)
    again = mixing.mix(df.repartition(3), block_words=block_words).collect()
    assert sorted((x.doc_id, x.taken) for x in again) == sorted((x.doc_id, x.taken) for x in got)


def test_mixed_documents_have_the_words_taken(spark):
    df = spark.createDataFrame([r for r in cases.rows() if r[1] is not None], cases.SCHEMA)
    taken = {x.doc_id: x.taken for x in mixing.mix(df).collect() if x.taken}
    made = {}
    mixed = mixing.mixed_documents(df)
    for x in mixed.collect():
        made[x.doc_id] = made.get(x.doc_id, 0) + len(x.text.encode().split())
    assert made == taken and mixed.columns == df.columns


def test_shards_hold_what_the_slots_say(spark):
    """Every slot mapped one by one through its source's permutation, against the join of blocks by index."""
    width = 7
    df = spark.createDataFrame(cases.rows(), cases.SCHEMA)
    held = mixing.mixed_slots(df, block_words=width).collect()
    size = {}
    for r in cases.rows():
        size[r[3]] = size.get(r[3], 0) + len((r[1] or "").encode().split())
    begin = {}  # the place of every document among its source's words
    for x in held:
        assert begin.setdefault((x.source, x.doc_id), x.position - x.begin) == x.position - x.begin
    plan = mixing.shares(list(size.items()), mixing.targets(list(size.items())), width)
    words = {r[0]: len((r[1] or "").encode().split()) for r in cases.rows()}
    want = set()
    for share in plan:
        source = None if share.skey == "n" else share.skey[1:]
        for j in range(share.slots):
            epoch, k = divmod(j, share.full + (share.tail > 0))
            block = int(mixing.permute(np.array([k]), share.full, mixing.SEED * 1_000_003 + share.number * 8191 + epoch)[0]) if k < share.full else k
            take = share.part if share.part and j == share.slots - 1 else width if k < share.full else share.tail
            for (s, doc), at in begin.items():
                low, high = max(at, block * width), min(at + words[doc], block * width + take)
                if s == source and high > low:
                    want.add((source, j, epoch, block, doc, low - at, high - at))
    assert {(x.source, x.slot, x.epoch, x.block, x.doc_id, x.begin, x.end) for x in held} == want
    slots = {(x.source, x.slot): x.shard for x in held}
    dealt = mixing.draws([r.slots for r in plan], 16)
    for i, share in enumerate(plan):
        source = None if share.skey == "n" else share.skey[1:]
        assert [sum(v == n for k, v in slots.items() if k[0] == source) for n in range(16)] == dealt[:, i].tolist()
    other = {(x.source, x.slot): x.shard for x in mixing.mixed_slots(df, block_words=width, seed=5).collect()}
    assert slots != other  # the draws decide


# -- sharding -------------------------------------------------------------------------------------------


def test_schedule_equals_a_plain_heap():
    r = random.Random(6)
    for _ in range(60):
        n = r.choice([1, 3, 16])
        hist = [(s, r.choice([1, 2, 5, 700, 3000])) for s in r.sample(range(1, 4000), r.randint(1, 12))]
        heap = [(0, i) for i in range(n)]
        want = {}
        for size, count in sorted(hist, reverse=True):
            want[size] = [0] * n
            for _ in range(count):
                load, i = heap[0]
                want[size][i] += 1
                heapq.heapreplace(heap, (load + size, i))
        assert sharding.schedule(hist, n) == want


def test_shards(spark, tmp_path):
    data = cases.rows() + [(100 + i, cases.words(50 + i, 20), "en", "s", 1, *cases.EXTRA) for i in range(40)] + [(100, cases.words(50, 20), "en", "s", 1, *cases.EXTRA)]
    got = sharding.op10_sharding(spark, cases.write(spark, tmp_path, data)).collect()
    assert len(got) == len(data) and {x.law for x in got} == {"bytes"} and all(x.grown_shard is None for x in got)
    slots, load = {}, [0] * 16
    for x in got:
        slots.setdefault(x.shard, []).append(x.slot)
        load[x.shard] += x["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    text = {}
    for r in data:
        text.setdefault(r[0], []).append(r[1])
    for x in got:
        assert any(x["size"] == len((t or "").encode()) + 1 and x.text_crc32 == zlib.crc32((t or "").encode()) for t in text[x.doc_id])
    crc = cases.by_text(((x.text_crc32, x["size"]), x.shard) for x in got if x["size"] > 1)
    assert all(len(s) == 1 for s in crc.values())
    groups = {}
    for r in data:
        groups[r[1]] = groups.get(r[1], 0) + len((r[1] or "").encode()) + 1
    heap = [0] * 16
    for g in sorted(groups.values(), reverse=True):
        heapq.heapreplace(heap, heap[0] + g)
    assert sorted(load) == sorted(heap)


# -- URL lists ------------------------------------------------------------------------------------------


def test_url_lists(spark):
    day = lambda n: dt.date(2024, 1, n)
    entries = [("block", "domain", "bad.org", "add", day(5)), ("block", "domain", "bad.org", "remove", day(10)), ("block", "domain", "bad.org", "add", day(10)), ("block", "domain", "bad.org", "add", day(20)), ("allow", "host", "ok.bad.org", "add", day(1)),
               ("block", "prefix", "x.com/a/", "add", day(2)), ("block", "domain", "x.com", "add", day(3)), ("block", "domain", "x.com", "add", day(4)), (None, "host", "q", "add", day(1))]
    intervals = url_lists.validity_intervals(spark.createDataFrame(entries, "verdict string, kind string, value string, action string, day date"))
    assert sorted((r.value, r.valid_from.day, r.valid_to and r.valid_to.day) for r in intervals.collect()) == [("bad.org", 5, 10), ("bad.org", 20, None), ("ok.bad.org", 1, None), ("x.com", 3, None), ("x.com/a/", 2, None)]
    urls = [(1, "https://www.bad.org/p", 4), (2, "https://www.bad.org/p", 5), (3, "http://u@BAD.org.:80/", 9), (4, "http://bad.org", 10), (5, "http://ok.bad.org/", 21), (6, "http://notbad.org", 21), (7, "http://x.com/a/b/c?d#e", 2), (8, "http://x.com/ab", 2), (9, "http://x.com/a/", 9), (10, None, 3), (11, "nonsense", 3), (2, "https://www.bad.org/p", 5)]
    captures = spark.createDataFrame([(i, u, day(n), "clash") for i, u, n in urls], "page_id long, url string, day date, kind string")
    got = {r.page_id: (r.host, r.n_active, r.verdict, r.entry) for r in url_lists.evaluate(captures, intervals, "page_id", "url", "day").collect()}
    assert got == {1: ("www.bad.org", 0, "none", ""), 2: ("www.bad.org", 1, "block", "domain:bad.org"), 3: ("bad.org", 1, "block", "domain:bad.org"), 4: ("bad.org", 0, "none", ""), 5: ("ok.bad.org", 2, "allow", "host:ok.bad.org"), 6: ("notbad.org", 0, "none", ""),
                   7: ("x.com", 1, "block", "prefix:x.com/a/"), 8: ("x.com", 0, "none", ""), 9: ("x.com", 2, "block", "prefix:x.com/a/"), 10: ("", 0, "none", ""), 11: ("", 0, "none", "")}
    assert url_lists.evaluate(captures, intervals.limit(0), "page_id", "url", "day").filter("verdict <> 'none'").count() == 0


def test_url_prefixes_of_every_kind(spark):
    day = dt.date(2024, 1, 1)
    values = ["x.com/", "x.com/a", "x.com/a/b.html", "[::1]/"]
    intervals = url_lists.validity_intervals(spark.createDataFrame([("block", "prefix", v, "add", day) for v in values], "verdict string, kind string, value string, action string, day date"))
    urls = ["http://x.com", "http://x.com/q", "http://x.com/a", "http://x.com/a/c", "http://x.com/ab", "http://x.com/a/b.html?q=1", "http://x.com/a/b.htmlx", "http://[::1]:80/z", "http://x.com/" + "p/" * 3000]
    captures = spark.createDataFrame([(i, u, day) for i, u in enumerate(urls)], "page_id long, url string, day date")
    got = {r.page_id: r.entry for r in url_lists.evaluate(captures, intervals, "page_id", "url", "day").collect()}
    assert [got[i] for i in range(len(urls))] == ["prefix:" + v for v in ("x.com/", "x.com/", "x.com/a", "x.com/a", "x.com/", "x.com/a/b.html", "x.com/a", "[::1]/", "x.com/")]


# -- WARC -----------------------------------------------------------------------------------------------


def test_warc_derivatives(spark):
    page = "<html><head><title>A &amp; B</title><style>p{}</style><script>var x='<p>no</p>';</script></head><body><p>One <b>two</b><br>three</p><!-- gone --><a class=x href='/u?a=1&amp;b=2'>link</a><img src=pic.png></body></html>"
    one = warc.response("http://e.org/x", "2024-01-01T00:00:00Z", page.encode())
    (headers, block), = warc.parse(one)
    assert warc.value_of(headers, "warc-block-digest") == warc.digest(block)
    import gzip

    both = gzip.compress(one) + gzip.compress(warc.record([("WARC-Type", "request"), ("WARC-Record-ID", "<urn:x>")], b"GET /"))
    df = spark.createDataFrame([(1, bytearray(both)), (2, bytearray(one)), (3, None), (4, bytearray(b""))], "record_id long, content binary")
    got = warc.derivatives(df).collect()
    assert len(got) == 4 and {r.type for r in got} == {"metadata", "conversion"}
    for r in got:
        assert r.refers_to == warc.value_of(headers, "WARC-Record-ID") and r.target_uri == "http://e.org/x" and r.payload_digest == warc.digest(page.encode()) and r.block_digest == warc.digest(bytes(r.block)) and r.headers["WARC-Date"] == r.date
    by = {r.type: r for r in got}
    assert by["metadata"].concurrent_to == by["conversion"].record_id
    assert bytes(by["conversion"].block).decode() == "A & B\nOne two\nthree\nlink"
    meta = json.loads(bytes(by["metadata"].block))
    assert meta["html"] == {"title": "A & B", "links": [{"path": "A@/href", "url": "/u?a=1&b=2"}, {"path": "IMG@/src", "url": "pic.png"}]}
    assert meta["http"]["headers"]["Content-Length"] == str(len(page)) and meta["source"]["WARC-Type"] == "response"
    assert warc.derive([("WARC-Type", "response")], b"no head")[1][1] == b"no head"


def test_warc_query(spark, tmp_path):
    data = [(1, "http://a.b/", "<p>x</p>", 5), (1, "http://a.b/", "<p>x</p>", 6), (2, None, None, None), (None, "u", "", 1), (3, "http://c/", "<p>" + "long " * 50000, 2)]
    got = warc.op7_warc(spark, cases.write(spark, tmp_path, data, "page_id long, url string, html string, title int", "pages")).collect()
    assert len(got) == 5 and all(r.refers_to == r.response_id for r in got)
    assert {r.text_bytes for r in got if r.page_id == 1} == {1} and next(r.text_bytes for r in got if r.page_id == 3) == 249999


def test_warc_long_and_broken_headers(spark, tmp_path):
    date, url = "2024-01-01T00:00:00Z", "http://e.org/" + "u" * 70_000
    parts = [warc.response(url, date, b"<p>one</p>"), warc.response("http://e.org/2", date, b"<p>two</p>" * 9000), b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: http://cut", b"\r\n", warc.response("http://e.org/3", date, b"a\r\n\r\nb")]
    parts.append(warc.response("http://e.org/4", date, b"x").replace(b"\r\n", b"\n", 10))  # its header has LF only
    got = list(warc.parse(b"".join(parts)))
    assert [warc.value_of(h, "WARC-Target-URI") for h, _ in got] == [url, *(f"http://e.org/{k}" for k in (2, 3, 4))]
    assert all(warc.digest(b) == warc.value_of(h, "WARC-Block-Digest") for h, b in got)
    data = [(1, url, "<p>x</p>"), (2, "http://a.b/", "<p>yy</p>")]
    rows = warc.op7_warc(spark, cases.write(spark, tmp_path, data, "page_id long, url string, html string", "pages")).collect()
    assert sorted((r.page_id, r.text_bytes) for r in rows) == [(1, 1), (2, 2)]


def test_warc_gzip_members_are_read_in_linear_time_and_past_damage():
    import gzip
    import time

    def packed(n):
        return b"".join(gzip.compress(warc.response(f"http://e.org/{k}", "2024-01-01T00:00:00Z", b"<p>%d</p>" % k * 300, key=str(k))) for k in range(n))

    took = []
    for n in (500, 4000):
        data = packed(n)
        began = time.perf_counter()
        assert [warc.value_of(h, "WARC-Target-URI") for h, _ in warc.parse(data)] == [f"http://e.org/{k}" for k in range(n)]
        took.append(time.perf_counter() - began)
    assert took[1] < took[0] * 8 * 4  # eight times the members
    parts = [gzip.compress(warc.response(f"http://e.org/{k}", "2024-01-01T00:00:00Z", random.Random(k).randbytes(3000))) for k in range(4)]
    broken = bytearray(parts[1])
    broken[1500:1600] = bytes(100)
    got = [(warc.value_of(h, "WARC-Target-URI"), len(b)) for h, b in warc.parse(parts[0] + bytes(broken) + parts[2] + parts[3][:900])]
    assert [u for u, n in got if n > 3000] == ["http://e.org/0", "http://e.org/2"] and list(warc.parse(b"\x1f\x8bjunk")) == []


def test_warc_bodies_by_their_encodings():
    import gzip

    def derived(head, payload):
        block = b"HTTP/1.1 200 OK\r\n" + head + b"\r\n\r\n" + payload
        (_, envelope), (_, text) = warc.derive([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:a>"), ("X", "1"), ("X", "2")], block)
        return json.loads(envelope), text.decode()

    page = "<title>Grüße</title><p title='a > b'>naïve</p>"
    data = gzip.compress(page.encode())
    assert derived(b"Content-Encoding: gzip", data)[1] == "Grüße\nnaïve"
    assert derived(b"Content-Encoding: deflate", zlib.compress(page.encode()))[1] == "Grüße\nnaïve"
    assert derived(b"Content-Encoding: gzip", page.encode())[1] == "Grüße\nnaïve"
    chunked = b"".join(b"%x;x=y\r\n" % len(c) + c + b"\r\n" for c in (data[:7], data[7:])) + b"0\r\n\r\n"
    assert derived(b"Transfer-Encoding: chunked\r\nContent-Encoding: gzip", chunked)[1] == "Grüße\nnaïve"
    assert derived(b"Transfer-Encoding: chunked", page.encode())[1] == "Grüße\nnaïve"
    assert derived(b"Content-Type: text/html; charset=iso-8859-1", "é".encode("latin-1"))[1] == "é"
    assert derived(b"A: b", '<meta charset="gb18030"><p>中文</p>'.encode("gb18030"))[1] == "中文"
    assert derived(b"A: b", b"\xff\xfe" + "日本".encode("utf-16-le"))[1] == "日本"
    assert derived(b"Content-Type: text/html; charset=nonsense", "é".encode())[1] == "é"
    envelope, _ = derived(b"Set-Cookie: a\r\nSet-Cookie: b\r\nVia: c", b"")
    assert envelope["http"]["headers"] == {"Set-Cookie": ["a", "b"], "Via": "c"} and envelope["source"]["X"] == ["1", "2"]


def test_warc_pages_with_odd_markup():
    page = '<a title="x > y" href=/1>one</a><script>if (a < b) { "<p>" }</script><a href="/2?a&gt;b">two</a><p title="open>three<p>four<!-- <a href=/no> --><img alt="" src=\'/3\'><title>T &lt;b&gt;</title><style>.x{}'
    title, text, links = warc.read_page(page)
    assert title == "T <b>" and [x["url"] for x in links] == ["/1", "/2?a>b", "/3"]
    assert "one" in text and "two" in text and "four" in text and "no" not in text.split() and "{" not in text
    long = "<p>" + "<b x='" * 20_000 + "end"
    assert warc.read_page(long)[0] == "" and warc.read_page("a<b>c<!-- > d")[1] == "ac" == warc.read_page("a<b>c<!-- d")[1]


# -- all together ---------------------------------------------------------------------------------------


@pytest.mark.parametrize("query", [piece_codec.op5_sentencepiece, media.op3_media, language_id.op9_language_id, mixing.op4_mixing, sharding.op10_sharding])
def test_empty_documents(spark, tmp_path, query):
    assert query(spark, cases.write(spark, tmp_path, [])).count() == 0


@pytest.mark.parametrize("query", [url_lists.op6_url_lists, warc.op7_warc])
def test_empty_pages(spark, tmp_path, query):
    assert query(spark, cases.write(spark, tmp_path, [], "page_id long, url string, html string", "pages")).count() == 0


@pytest.mark.parametrize(("query", "equal"), [(piece_codec.op5_sentencepiece, ("n_tokens", "ids_sha256", "decoded_sha256")), (media.op3_media, ("n_bytes", "payload_sha256", "media_sha256", "feature")), (mixing.op4_mixing, ("size", "source_size", "target")), (sharding.op10_sharding, ("size", "text_crc32", "shard"))])
def test_null_and_repeated_ids_are_rows_of_their_own(spark, tmp_path, query, equal):
    text = "one two three four five six"
    data = [(None, text, "en", "s"), (None, text, "en", "s"), (None, "other words", "en", "s"), (7, text, "en", "s"), (7, text, "en", "s"), (7, "more", None, None), (8, None, "de", "s")]
    got = query(spark, cases.write(spark, tmp_path, data, "doc_id long, text string, lang string, source string")).collect()
    assert sorted(str(x.doc_id) for x in got) == sorted(str(r[0]) for r in data)
    same = {tuple(x[c] for c in equal) for x in got}
    assert len(same) <= 4  # four different texts, one of them of a source of its own


def test_results_live_on_while_a_pipeline_runs(spark, tmp_path):
    d = cases.write(spark, tmp_path, cases.rows())
    first = sharding.op10_sharding(spark, d)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", None)
    piped = corpus_pipeline.run(spark, d)
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", None) == before or before is None
    second = mixing.op4_mixing(spark, d)
    again = corpus_pipeline.run(spark, d)
    assert first.count() == second.count() == len(cases.rows()) and piped.count() == again.count() > 0


def test_pipeline_keeps_columns_of_any_name(spark, tmp_path):
    odd = ["score", "lang_pred", "epochs", "ranges", "row", "pieces", "size", "__row", "order", "component_id", "sha", "start", "block", "a b", "text_", "_row"]
    data = [(r[0], r[1], r[2], r[3], *[f"{c}{r[0]}" for c in odd]) for r in cases.rows()]
    schema = "doc_id long, text string, lang string, source string, " + ", ".join(f"`{c}` string" for c in odd)
    d = cases.write(spark, tmp_path, data, schema)
    docs = spark.read.parquet(f"{d}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, d).collect(), docs.schema)
        assert docs.columns == ["doc_id", "text", "lang", "source", *odd], name
        for r in docs.collect():
            assert all(r[c] == f"{c}{r.doc_id}" for c in odd), name
    assert docs.count() > 5 and corpus_pipeline.run(spark, d).count() > 5


def test_pipeline_of_nothing(spark, tmp_path):
    d = cases.write(spark, tmp_path, [], cases.SCHEMA)
    assert corpus_pipeline.run(spark, d).count() == 0


def test_pipeline_against_plain_stages(spark, tmp_path):
    import sentencepiece

    data = [(i, t, lang, "s%d" % (i % 3), len(t)) for i, t, lang in corpus(60)] + [(200 + r[0], *r[1:5]) for r in cases.rows()]
    d = cases.write(spark, tmp_path, data, "doc_id long, text string, lang string, source string, n_chars long")
    docs = spark.read.parquet(f"{d}/documents.parquet")
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, d)
        seen.append((name, [r.asDict() for r in made.collect()]))
        if name != "sentencepiece":
            assert made.columns == docs.columns
        docs = spark.createDataFrame(made.collect(), made.schema)
    out = dict(seen)
    letters = {i for i, t, *_ in data if t and any(map(str.isalpha, t))}
    assert {r["doc_id"] for r in out["language_id"]} == letters
    parts = cases.jaccard([(r["doc_id"], r["text"]) for r in out["language_id"]])
    assert {r["doc_id"] for r in out["ngram_join"]} == {c for _, c in parts.values()}
    cut = {i: n for i, _, n, _, _ in cases.repeated([(r["doc_id"], r["text"]) for r in out["ngram_join"]])}
    before = {r["doc_id"]: len(r["text"].encode()) for r in out["ngram_join"]}
    for r in out["suffix_dedup"]:
        assert before[r["doc_id"]] - len(r["text"].encode()) in range(max(0, cut[r["doc_id"]] - 6), cut[r["doc_id"]] + 1)
    model = sentencepiece.SentencePieceProcessor(model_file=piece_codec.default_model())
    want = sorted((r["doc_id"], len(model.encode(r["text"], add_eos=True))) for r in out["mixing"])
    assert sorted((r["doc_id"], r["n_tokens"]) for r in out["sentencepiece"]) == want
    assert sorted((r.doc_id, r.n_tokens) for r in corpus_pipeline.run(spark, d).collect()) == want


def test_pipeline_keeps_rows_with_null_and_repeated_ids(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    texts = [cases.words(100 + i, 60, 100_000) for i in range(12)]
    ids = [None, None, None, 7, 7, 7, None, 7, 1, 2, 3, 4]
    near = texts[3] + " more"
    data = [(i, t, "en", "s", len(t)) for i, t in zip(ids, texts, strict=True)]
    data += [data[0], data[3], (9, near, "en", "s", len(near)), (None, texts[8], "en", "s", 1)]
    key = lambda rows: sorted((r.doc_id is None, r.doc_id or 0, r.text) for r in rows)
    want = sorted((i is None, i or 0, t) for i, t in zip(ids, texts, strict=True))
    for order in (data, data[::-1]):
        docs = spark.createDataFrame(order, schema).repartition(3)
        kept = corpus_pipeline.ngram_join(spark, docs, "")
        assert kept.columns == docs.columns and key(kept.collect()) == want
    kept = spark.createDataFrame(kept.collect(), schema)
    assert key(corpus_pipeline.suffix_dedup(spark, kept, "").collect()) == want
    # one source is taken exactly once as a whole; equal rows are rows of their own
    twice = kept.union(kept.filter("doc_id is null"))
    mixed = corpus_pipeline.mixing(spark, twice, "")
    assert mixed.columns == docs.columns and key(mixed.collect()) == key(twice.collect())
    # what a part of a pass takes does not depend on the order of the rows
    two = kept.withColumn("source", mixing.F.when(mixing.F.length("text") % 2 == 0, "a").otherwise("b"))
    assert key(corpus_pipeline.mixing(spark, two, "").collect()) == key(corpus_pipeline.mixing(spark, two.orderBy("text").repartition(5), "").collect())
