"""Language identification by segmentation-marginalised unigrams (operator 9).

Every language has a probability for each piece of a fixed public vocabulary.  The likelihood of a word is the
sum over all its segmentations into pieces, which a forward pass over the word's characters computes; a text is
the product of its words (maximal runs of letters, lower-cased, each behind a meta space, which no piece of the
vocabulary crosses).  The probabilities are fitted by expectation-maximisation: forward and backward passes give
each piece's expected count.  All passes run over many words of one length at once in numpy; characters that no
piece covers cost a fixed probability.

Fitting uses a bounded sample of the labelled rows (``docs_per_language``, chosen by a hash of the id, whole
texts); prediction covers every row.  The sample's distinct words are a written table; every expectation step is a
job over it, and what visits the driver is one number for each piece and language that occurs.

Defined results: a null text, or one without a letter, gives ``und`` and score 0; ties go to the language that
sorts first; without any labelled row everything is ``und``, and an empty table gives no rows.  Very long texts and
words are judged whole, repeated rows each for itself; a null id counts as not held out.  Other columns are not read,
or are kept as they are, whatever their names.
"""

from __future__ import annotations

import itertools
import re
from collections import Counter
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placewright.llm.common import free_name, map_arrow, materialize, mix64, read, text_bytes
from placewright.llm.piece_codec import META, default_model

#: Upper bound (in the mean of the hash) of labelled texts per language that the fit reads.
DOCS_PER_LANGUAGE = 1500
_HASHES = 1 << 60
ROUNDS = 3
#: Tasks of an expectation step, whose number is bounded as the sample is, and rows of its words that go together.
STEP_PARTS, STEP_ROWS = 24, 20_000
#: Probability of a character outside the vocabulary, weight of the pooled estimate, floor of a piece.
UNKNOWN, POOL, FLOOR = 1e-7, 50.0, 1e-9
CACHED_WORDS = 100_000
#: The first step of a pass whose sums are divided; all steps before it have scale 0.
SCALED = 16
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    """Lower-cased runs of letters; none if no character of the text is a letter."""
    found = _WORD.findall(text.lower())
    return found if any(any(map(str.isalpha, w)) for w in found) else []


class Pieces:
    """The vocabulary as a hash table from the code points of a piece to its row (0: no piece)."""

    def __init__(self, model_path: str | None = None):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_path or default_model())
        names = sorted({model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))})
        self.names = [p for p in names if p.strip(META) or p == META]
        self.longest = max(map(len, self.names), default=1)
        keys = self._keys(self.names)
        bits = 18
        self.shift = np.uint64(64 - bits)
        self.table_key, self.table_row = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.int32)
        self.more: dict[int, int] = {}
        for row, key in enumerate(keys.tolist(), 1):
            slot = key >> (64 - bits)
            if self.table_row[slot]:
                self.more[key] = row
            else:
                self.table_key[slot], self.table_row[slot] = key, row
        self.more_keys = np.array(sorted(self.more), dtype=np.uint64)
        self.more_rows = np.array([self.more[k] for k in sorted(self.more)], dtype=np.int32)

    @staticmethod
    def _keys(names: list[str]) -> np.ndarray:
        """The hash of each name, as ``rows`` finds it character by character."""
        out = np.zeros(len(names), np.uint64)
        size = np.array([len(n) for n in names], dtype=np.int64)
        for k in range(int(size.max(initial=0))):
            at = np.flatnonzero(size > k)
            out[at] = mix64(out[at] ^ np.array([ord(names[i][k]) for i in at.tolist()], dtype=np.uint64))
        return out

    def rows(self, codes: np.ndarray) -> np.ndarray:
        """codes: words x characters; the result's [w, start, length - 1] is the row of that piece, or 0."""
        n, size = codes.shape
        out = np.zeros((n, size, min(self.longest, size)), dtype=np.int32)
        h = np.zeros((n, size), dtype=np.uint64)
        for k in range(out.shape[2]):
            h = mix64(h[:, : size - k] ^ codes[:, k:])
            slot = h >> self.shift
            row = np.where(self.table_key[slot] == h, self.table_row[slot], 0)
            if len(self.more_keys):
                crowded = np.flatnonzero((row.ravel() == 0) & (self.table_row[slot].ravel() > 0))
                if len(crowded):
                    flat = h.ravel()[crowded]
                    at = np.minimum(np.searchsorted(self.more_keys, flat), len(self.more_keys) - 1)
                    row.ravel()[crowded] = np.where(self.more_keys[at] == flat, self.more_rows[at], 0)
            out[:, : size - k, k] = row
        return out


_pieces: dict[str | None, Pieces] = {}


def pieces_of(model_path: str | None) -> Pieces:
    """The process's vocabulary, read once."""
    if model_path not in _pieces:
        _pieces[model_path] = Pieces(model_path)
    return _pieces[model_path]


def _groups(words: list[str], limit: int = 120_000):
    """(positions, code points) of words of one length, at most about ``limit`` characters together."""
    by: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        by.setdefault(len(w), []).append(i)
    for size, where in by.items():
        step = max(1, limit // (size + 1))
        for k in range(0, len(where), step):
            part = where[k : k + step]
            text = "".join([META + words[i] for i in part])
            codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).reshape(len(part), size + 1)
            yield np.array(part), codes.astype(np.uint64)


def _forward(rows: np.ndarray, prob: np.ndarray, reverse: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Sums over segmentations: (values per word, position and language; logarithm of what each was divided by)."""
    n, size, reach = rows.shape
    a = np.zeros((n, size + 1, prob.shape[1]))
    scale = np.zeros_like(a)
    order = range(size, -1, -1) if reverse else range(size + 1)
    for step, at in enumerate(order):
        if step == 0:
            a[:, at] = 1
            continue
        back = [at + k if reverse else at - k for k in range(1, min(step, reach) + 1)]
        base = scale[:, back[0]]
        total = np.zeros((n, prob.shape[1]))
        for k, other in enumerate(back):
            p = prob[rows[:, at if reverse else other, k]]
            if k == 0:
                p = np.where(rows[:, at if reverse else other, 0, None] == 0, UNKNOWN, p)
            value = a[:, other] * p
            total += value if step <= SCALED else value * np.exp(scale[:, other] - base)
        if step >= SCALED and step % 8 == 0:
            divide = np.maximum(total, 1e-300)
            total, base = total / divide, base + np.log(divide)
        a[:, at], scale[:, at] = total, base
    return a, scale


class Languages:
    """Fitted piece probabilities; ``prob`` has a row for no piece, then one for each piece."""

    def __init__(self, names: list[str], prior: np.ndarray, prob: np.ndarray):
        self.names, self.prior, self.prob = names, prior, prob

    def log_likelihood(self, words: list[str], pieces: Pieces) -> np.ndarray:
        out = np.zeros((len(words), len(self.names)))
        for where, codes in _groups(words):
            a, scale = _forward(pieces.rows(codes), self.prob)
            out[where] = np.log(np.maximum(a[:, -1], 1e-300)) + scale[:, -1]
        return out


def expected(words: list[str], weight: np.ndarray, prob: np.ndarray | None, pieces: Pieces) -> np.ndarray:
    """Expected count of each piece (rows) in each language (columns) over words with weights (words x languages).

    Without probabilities, every occurrence as a substring counts.
    """
    n_rows, n_langs = len(pieces.names) + 1, weight.shape[1]
    found = np.zeros((n_rows, n_langs))
    for where, codes in _groups(words, 100_000):
        rows = pieces.rows(codes)
        if prob is None:
            for k in range(rows.shape[2]):
                for lang in range(n_langs):
                    found[:, lang] += np.bincount(rows[:, :, k].ravel(), np.repeat(weight[where, lang], rows.shape[1]), n_rows)
            continue
        a, a_scale = _forward(rows, prob)
        b, b_scale = _forward(rows, prob, reverse=True)
        whole, whole_scale, mine = np.maximum(a[:, -1], 1e-300), a_scale[:, -1], weight[where]
        for k in range(rows.shape[2]):  # pieces of k + 1 characters, wherever they begin
            word, start = np.nonzero(rows[:, :, k])
            piece, end = rows[word, start, k], start + k + 1
            share = mine[word] * a[word, start] * prob[piece] * b[word, end] / whole[word] * np.exp(a_scale[word, start] + b_scale[word, end] - whole_scale[word])
            for lang in range(n_langs):
                found[:, lang] += np.bincount(piece, share[:, lang], n_rows)
    found[0] = 0
    return found


def maximised(found: np.ndarray) -> np.ndarray:
    """Piece probabilities from expected counts, smoothed towards all languages together."""
    pool = found.sum(1, keepdims=True) + 1e-3
    pool[0] = 0
    prob = (found + POOL * pool / pool.sum()) / (found.sum(0) + POOL)
    prob[1:] = np.maximum(prob[1:], FLOOR)
    return prob


def weights_of(counts: Iterable[tuple[str, str, int]], names: list[str]) -> tuple[list[str], np.ndarray]:
    """(words, words x languages) of (language, word, count)."""
    at: dict[str, int] = {}
    place = {n: i for i, n in enumerate(names)}
    cells = [(at.setdefault(w, len(at)), place[lang], n) for lang, w, n in counts]
    weight = np.zeros((len(at), len(names)))
    for i, j, n in cells:
        weight[i, j] += n
    return list(at), weight


def fit(docs: dict[str, int], step: Callable[[np.ndarray | None], np.ndarray], rounds: int = ROUNDS) -> Languages:
    """Expectation-maximisation; ``step`` gives the expected counts under some probabilities, of substrings without."""
    names, prob = sorted(docs), None
    for _ in range(rounds + 1):
        prob = maximised(step(prob))
    total = np.array([docs[x] for x in names], dtype=float)
    return Languages(names, np.log(total / total.sum()), prob)


def held_out(id_col: str = "doc_id"):
    """True where crc32 of the id as text leaves no remainder by 5; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", docs_per_language: int = DOCS_PER_LANGUAGE, model_path: str | None = None) -> Languages:
    """Fit on a hash sample of the labelled rows that aren't held out, about ``docs_per_language`` of each."""
    labelled = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & ~held_out(id_col))
    count = {r[0]: r[1] for r in labelled.groupBy(F.col(lang_col)).count().collect()}
    if not count:
        return Languages([], np.zeros(0), np.zeros((len(pieces_of(model_path).names) + 1, 0)))
    limit = F.create_map(*[F.lit(x) for lang, n in count.items() for x in (lang, min(_HASHES, -(-_HASHES * docs_per_language // n)))])
    sample = labelled.filter(F.pmod(F.xxhash64(F.col(id_col), F.lit("fit")), F.lit(_HASHES)) < limit[F.col(lang_col)])

    def count_words(table: pa.Table) -> pa.Table:
        found: dict[str, Counter] = {}
        for lang, text in zip(table["lang"].to_pylist(), table["text"].to_pylist(), strict=True):
            found.setdefault(lang, Counter()).update(words_of(text.decode("utf-8", "replace")))
        rows = [(lang, w, n) for lang, c in found.items() for w, n in c.items()]
        return pa.table([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.int64())], names=["lang", "word", "n"])

    counted = map_arrow(sample.select(F.col(lang_col).alias("lang"), text_bytes(text_col).alias("text")), count_words, "lang string, word string, n long")
    totals = counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))
    # a word's languages together, words of all lengths in every part
    words = materialize(totals.repartition(STEP_PARTS, "word"), "words")
    return fit(count, lambda prob: _step(words, sorted(count), prob, model_path))


def _step(words: DataFrame, names: list[str], prob: np.ndarray | None, model_path: str | None) -> np.ndarray:
    """One expectation step over the table (lang, word, n)."""
    shared = words.sparkSession.sparkContext.broadcast(prob)  # pieces x languages: fixed by the vocabulary

    def work(batches):
        pieces = pieces_of(model_path)
        total = np.zeros((len(pieces.names) + 1, len(names)))
        rows: list[tuple[str, str, int]] = []
        for b in itertools.chain(batches, [None]):
            if b is not None:
                rows += zip(b["lang"].to_pylist(), b["word"].to_pylist(), b["n"].to_pylist(), strict=True)
            if len(rows) >= STEP_ROWS or (b is None and rows):  # passes run over many words at once, however they come
                total += expected(*weights_of(rows, names), shared.value, pieces)
                rows = []
        row, lang = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(lang), pa.array(total[row, lang])], ["row", "lang", "n"])

    parts = words.mapInArrow(work, "row long, lang long, n double")
    # summed in a fixed order, so reruns agree to the last digit
    summed = parts.groupBy("row", "lang").agg(F.aggregate(F.sort_array(F.collect_list("n")), F.lit(0.0), lambda a, x: a + x).alias("n")).toArrow()
    found = np.zeros((len(pieces_of(model_path).names) + 1, len(names)))
    found[np.asarray(summed["row"]), np.asarray(summed["lang"])] = np.asarray(summed["n"])
    return found


class _Judge:
    """A worker's words with their likelihoods."""

    def __init__(self, languages: Languages, model_path: str | None):
        self.languages, self.pieces = languages, pieces_of(model_path)
        self.at: dict[str, int] = {}
        self.known = np.zeros((0, len(languages.names)))

    def judge(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        each = [words_of(t) if t else [] for t in texts]
        if len(self.at) > CACHED_WORDS:
            self.at, self.known = {}, self.known[:0]
        new = list({w: None for ws in each for w in ws if w not in self.at})
        if new:
            self.at.update(zip(new, range(len(self.at), len(self.at) + len(new)), strict=True))
            self.known = np.concatenate((self.known, self.languages.log_likelihood(new, self.pieces)))
        langs, scores = [], []
        for ws in each:
            if not ws or not self.languages.names:
                langs.append("und")
                scores.append(0.0)
                continue
            total = self.languages.prior + self.known[[self.at[w] for w in ws]].sum(0)
            best = int(np.argmax(total))
            langs.append(self.languages.names[best])
            scores.append(float(1 / np.exp(total - total[best]).sum()))
        return langs, scores


def predict(docs: DataFrame, languages: Languages, keep: list[str], text_col: str = "text", model_path: str | None = None, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """Columns ``keep`` with the language and its score, under ``names``."""
    shared = docs.sparkSession.sparkContext.broadcast(languages)  # pieces x languages: fixed by the vocabulary
    text, state = free_name("text", keep), []

    def work(table: pa.Table):
        if not state:
            state.append(_Judge(shared.value, model_path))
        for begin in range(0, table.num_rows, 256):
            part = table.slice(begin, 256)
            langs, scores = state[0].judge([None if b is None else b.decode("utf-8", "replace") for b in part[text].to_pylist()])
            yield pa.table([*[part[k] for k in keep], pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=[*keep, *names])

    pruned = docs.select(*[F.col(f"`{k}`") for k in keep], text_bytes(text_col).alias(text))
    schema = T.StructType([*[f for f in pruned.schema.fields if f.name != text], T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())])
    return map_arrow(pruned, work, schema)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned from those that aren't held out."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "lang")
    return predict(docs.withColumn("held_out", held_out()), learn(docs), ["doc_id", "held_out"]).select("doc_id", "held_out", "lang_pred", "score")


QUERIES = {"op9_language_id": op9_language_id}
ORACLES: dict[str, str] = {}
