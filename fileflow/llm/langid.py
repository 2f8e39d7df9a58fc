"""Language identification with segmentation-marginalised unigrams.

The pieces are a fixed public vocabulary (byte strings; all single bytes are
among them).  Every language has a probability for each piece.  A word, with a
space in front, has the probability of all its segmentations into pieces
together, which a forward pass over its bytes sums.  Words are split at white
space, however long they are; the pass keeps the sums of the places that a piece
can still reach, rescaled, so a word without an end needs no more memory.  Texts
quote other languages: a word of a text in language l is taken to come from l,
or with probability ``QUOTED`` from any language, and so is each further
``RUN`` bytes of a longer word, given what came before; a text has the product
of these probabilities, so a short foreign passage doesn't outweigh the rest.

Training: expectation maximisation on a bounded sample of labelled rows, about
``rows_per_lang`` of each language, chosen by a hash of the id.  Spark counts
the sample's words by language; each round runs forward and backward over the
distinct words in tasks and sums the expected uses of each piece.  The model
(pieces times languages) goes through the driver; both are bounded and checked.

Prediction is map-only.  Workers remember the scores of words up to a bound.
The score is the posterior of the predicted language under equal priors.

Defined results: a text without any letter, or null, is ``und`` with score 0;
without any labelled row every text is ``und``; ties go to the first language
by code point.  Added columns replace columns of the same name.
"""

from __future__ import annotations

import base64
from collections import Counter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fileflow.llm.common import chunks, held_out, saved, table, without

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Bytes of a word that are quoted or not at once.
RUN = 48
#: Bytes of a long word whose lattice is held at once (a multiple of RUN), and between rescalings (a divisor of RUN).
WINDOW, RESCALE = 100 * RUN, 16
QUOTED = 0.5
#: Words whose scores a worker remembers before it starts afresh.
REMEMBERED = 300_000
#: Words of equal length whose lattices are computed at once.
BLOCK = 4096
MAX_PIECES, MAX_LANGS = 300_000, 200
LETTER = regex.compile(r"\p{L}")
_STEP = np.uint64(0x9E3779B97F4A7C15)


def read_vocabulary(path: str) -> list[bytes]:
    """Pieces of a rank file (base64 and rank a line); a bounded file on the driver."""
    with open(path, "rb") as f:
        pieces = [base64.b64decode(line.split()[0]) for line in f if line.strip()]
    pieces = sorted({*pieces, *(bytes([b]) for b in range(256))})
    if len(pieces) > MAX_PIECES:
        raise ValueError(f"the vocabulary has more than {MAX_PIECES} pieces")
    return pieces


def _longer(h: np.ndarray, byte: np.ndarray) -> np.ndarray:
    """Hashes of byte strings that are one byte longer."""
    with np.errstate(over="ignore"):
        h = (h + byte.astype(np.uint64) + np.uint64(1)) * _STEP
    return h ^ (h >> np.uint64(29))


class Pieces:
    """Finds the pieces that start and end at given places of many words of equal length.

    For every size a sorted table of hashes holds all beginnings of pieces of
    that size, with the piece's number or -1 where it only begins longer ones.
    """

    def __init__(self, pieces: list[bytes]):
        self.n = len(pieces)
        begun: dict[int, dict[bytes, int]] = {}
        for i, p in enumerate(pieces):
            for size in range(1, len(p)):
                begun.setdefault(size, {}).setdefault(p[:size], -1)
            begun.setdefault(len(p), {})[p] = i
        self.tables = []
        for size in sorted(begun):
            rows = np.array([list(p) for p in begun[size]], np.uint8)
            h = np.zeros(len(rows), np.uint64)
            for j in range(size):
                h = _longer(h, rows[:, j])
            order = np.argsort(h)
            h = h[order]
            if (h[1:] == h[:-1]).any():
                raise ValueError("two beginnings of pieces share a hash")
            self.tables.append((h, np.fromiter(begun[size].values(), np.int32, len(rows))[order]))

    def found(self, text: np.ndarray, k: int):
        """(bounds, sizes, ids) of the pieces that start at the first ``k`` places of one text, by start.

        Those of place i are at bounds[i] to bounds[i + 1].
        """
        starts, h, out = np.arange(k), np.zeros(k, np.uint64), []
        for size, (hashes, ids) in enumerate(self.tables, 1):
            room = starts + size <= len(text)
            starts, h = starts[room], _longer(h[room], text[starts[room] + size - 1])
            near = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
            going = hashes[near] == h  # the others begin no piece
            starts, h, near = starts[going], h[going], near[going]
            if not len(starts):
                break
            whole = ids[near] >= 0
            out.append((starts[whole], np.full(whole.sum(), size), ids[near][whole]))
        at, sizes, ids = (np.concatenate(c) for c in zip(*out)) if out else (np.zeros(0, np.int64),) * 3
        order = np.argsort(at, kind="stable")
        return np.searchsorted(at[order], np.arange(k + 1)), sizes[order], ids[order]

    def lattice(self, words: np.ndarray):
        """(start, size, rows, piece ids) of all pieces found in the rows of bytes ``words``."""
        n = words.shape[1]
        out = []
        for start in range(n):
            rows, h = np.arange(len(words)), np.zeros(len(words), np.uint64)
            for size, (hashes, ids) in enumerate(self.tables[: n - start], 1):
                h = _longer(h, words[rows, start + size - 1])
                near = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
                going = hashes[near] == h  # the others begin no piece
                rows, h, near = rows[going], h[going], near[going]
                if not len(rows):
                    break
                found = ids[near] >= 0
                if found.any():
                    out.append((start, size, rows[found], ids[near][found]))
        return out


def forward(lattice, n_words: int, n: int, p: np.ndarray) -> np.ndarray:
    """alpha[position, word, language]: probability of all segmentations up to the position."""
    alpha = np.zeros((n + 1, n_words, p.shape[1]))
    alpha[0] = 1
    for start, size, rows, ids in lattice:  # by start, so alpha[start] is complete
        alpha[start + size][rows] += alpha[start][rows] * p[ids]
    return alpha


def windows(word: bytes, pieces: Pieces):
    """(start, places, pieces found) of each window of a long word; pieces may end behind their window."""
    text = np.frombuffer(word, np.uint8)
    for at in range(0, len(text), WINDOW):
        k = min(WINDOW, len(text) - at)
        yield at, k, pieces.found(text[at: at + k + len(pieces.tables)], k)


def carried(k: int, found, p: np.ndarray, live: np.ndarray, log: np.ndarray):
    """The forward pass over a window of one word.

    ``live[j]`` has the sums so far of the j-th place from the window's start, up to the longest piece, all to be
    multiplied by exp(``log``).  Returns both at the window's end, where the live sums add up to 1; the logs of the
    window's own sums; and ``log`` at each RUN bytes, which is all that reaches or crosses that place.
    """
    bounds, sizes, ids = found
    q, reach = p[ids], len(live)
    alpha, logs, marks = np.zeros((k + reach, p.shape[1])), np.empty((k, p.shape[1])), []
    alpha[:reach] = live
    for i in range(k):
        logs[i] = log
        own = slice(bounds[i], bounds[i + 1])
        alpha[i + sizes[own]] += alpha[i] * q[own]
        if (i + 1) % RESCALE == 0 or i + 1 == k:
            ahead = alpha[i + 1: i + 1 + reach]
            mass = np.maximum(ahead.sum(axis=0), 1e-300)
            ahead /= mass
            log = log + np.log(mass)
            if (i + 1) % RUN == 0:
                marks.append(log)
    with np.errstate(divide="ignore"):
        return alpha[k:], log, np.log(alpha[:k]) + logs, marks


def start_of(pieces: Pieces, width: int):
    live = np.zeros((len(pieces.tables), width))
    live[0] = 1
    return live, np.zeros(width)


def long_steps(word: bytes, pieces: Pieces, p: np.ndarray) -> np.ndarray:
    """Log probability of each RUN bytes of a word after those before them, in each language.

    They add up to the logs of the sums over all segmentations of the whole word.
    """
    (live, log), marks = start_of(pieces, p.shape[1]), []
    for _, k, found in windows(word, pieces):
        live, log, _, some = carried(k, found, p, live, log)
        marks += some
    if len(word) % RUN:
        marks.append(log)
    return np.diff(np.array([np.zeros(p.shape[1]), *marks]), axis=0)


def long_uses(word: bytes, pieces: Pieces, q: np.ndarray):
    """(piece ids, expected uses) in a long word, a window at a time from its end; ``q`` is one language's column."""
    live, log = start_of(pieces, 1)
    begun = []  # where each window starts from
    for _, k, found in windows(word, pieces):
        begun.append((live, log))
        live, log, _, _ = carried(k, found, q[:, None], live, log)
    total = log[0]
    text, reach = np.frombuffer(word, np.uint8), len(pieces.tables)
    after = np.full(reach, -np.inf)  # logs of the sums from each place to the word's end
    after[0] = 0
    for at in reversed(range(0, len(word), WINDOW)):
        k = min(WINDOW, len(word) - at)
        bounds, sizes, ids = found = pieces.found(text[at: at + k + reach], k)
        alpha = carried(k, found, q[:, None], *begun.pop())[2][:, 0]
        logs, beta = np.log(np.maximum(q[ids], 1e-300)), np.concatenate([np.full(k, -np.inf), after])
        for i in reversed(range(k)):
            own = slice(bounds[i], bounds[i + 1])
            beta[i] = np.logaddexp.reduce(logs[own] + beta[i + sizes[own]])
        starts = np.repeat(np.arange(k), np.diff(bounds))
        yield ids, np.exp(alpha[starts] + logs + beta[starts + sizes] - total)
        after = beta[:reach] if k >= reach else np.concatenate([beta, np.full(reach, -np.inf)])[:reach]


def word_scores(words: list[bytes], pieces: Pieces, p: np.ndarray) -> np.ndarray:
    """Log probability of each word in a text of each language."""
    out = np.zeros((len(words), p.shape[1]))
    short = np.array([i for i, w in enumerate(words) if len(w) <= RUN], np.int64)
    for rows, block in by_length([words[i] for i in short]):
        lattice = pieces.lattice(block)
        each = np.maximum(forward(lattice, len(block), block.shape[1], p)[-1], 1e-300)
        out[short[rows]] = np.log((1 - QUOTED) * each + QUOTED * each.mean(axis=1, keepdims=True))
    for i, w in enumerate(words):
        if len(w) > RUN:
            steps = long_steps(w, pieces, p)
            any_lang = np.logaddexp.reduce(steps, axis=1, keepdims=True) - np.log(p.shape[1])
            out[i] = np.logaddexp(np.log(1 - QUOTED) + steps, np.log(QUOTED) + any_lang).sum(axis=0)
    return out


def by_length(words: list[bytes]):
    """(row numbers, rows of bytes) of words of equal length, in blocks."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(lengths, kind="stable")
    at = 0
    while at < len(order):
        n = lengths[order[at]]
        end = min(np.searchsorted(lengths, n, side="right", sorter=order), at + max(64, BLOCK * 8 // int(n)))
        rows = order[at:end]
        yield rows, np.frombuffer(b"".join(words[i] for i in rows), np.uint8).reshape(len(rows), n)
        at = end


def expected(words: list[bytes], counts: np.ndarray, lang: np.ndarray, pieces: Pieces, p: np.ndarray) -> np.ndarray:
    """Expected uses of each piece in each language: forward and backward over all segmentations."""
    out = np.zeros(pieces.n * p.shape[1])
    width = p.shape[1]
    for i, w in enumerate(words):
        if len(w) > RUN:
            for ids, uses in long_uses(w, pieces, p[:, lang[i]]):
                np.add.at(out, ids.astype(np.int64) * width + lang[i], uses * counts[i])
    short = np.array([i for i, w in enumerate(words) if len(w) <= RUN], np.int64)
    for rows, block in by_length([words[i] for i in short]):
        rows = short[rows]
        n, own = block.shape[1], lang[rows]
        lattice = pieces.lattice(block)
        lattice = [(s, z, r, ids, p[ids, own[r]]) for s, z, r, ids in lattice]
        alpha, beta = np.zeros((n + 1, len(rows))), np.zeros((n + 1, len(rows)))
        alpha[0] = beta[n] = 1
        for s, z, r, _, q in lattice:
            alpha[s + z][r] += alpha[s][r] * q
        for s, z, r, _, q in reversed(lattice):
            beta[s][r] += beta[s + z][r] * q
        scale = counts[rows] / np.maximum(alpha[n], 1e-300)
        for s, z, r, ids, q in lattice:
            np.add.at(out, ids.astype(np.int64) * width + own[r], alpha[s][r] * q * beta[s + z][r] * scale[r])
    return out.reshape(pieces.n, width)


def encoded(word: str) -> bytes:
    """A word with a space in front."""
    return b" " + word.encode("utf-8", "surrogatepass")


def sampled(docs: DataFrame, lang: str, rows_per_lang: int) -> DataFrame:
    """About ``rows_per_lang`` rows of each language, by a hash of the row's id: bounded, whatever the shares."""
    counts = docs.groupBy(lang).count().limit(MAX_LANGS + 1).collect()
    if len(counts) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    share = F.lit(0.0)
    for r in counts:
        share = F.when(F.col(lang) == r[lang], min(1.0, rows_per_lang / r["count"])).otherwise(share)
    return docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share * (1 << 20))


class Model:
    """Languages (in code point order) and their piece probabilities."""

    def __init__(self, langs: list[str], pieces: Pieces, p: np.ndarray):
        self.langs, self.pieces, self.p = langs, pieces, p


def train(docs: DataFrame, lang: str = "lang", text: str = "text", vocabulary: str = VOCABULARY,
          rows_per_lang: int = 250, rounds: int = 3, smoothing: float = 0.5) -> Model:
    """Fit the model on a bounded sample of the rows whose language is known."""
    spark = docs.sparkSession
    pieces = Pieces(read_vocabulary(vocabulary))
    known = docs.select("doc_id", F.col(lang).alias("lang"), F.col(text).alias("text")).where("lang is not null")
    sample = sampled(known, "lang", rows_per_lang)

    def words(batches):
        for batch in batches:
            for part in chunks(batch):
                by = {}
                for l, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    by.setdefault(l, Counter()).update((t or "").split())
                for l, words in by.items():
                    yield pa.RecordBatch.from_arrays([pa.array([l] * len(words), pa.string()), pa.array(map(encoded, words), pa.binary()),
                                                      pa.array(list(words.values()), pa.int64())], names=["lang", "word", "n"])

    counted = saved(sample.select("lang", "text").mapInArrow(words, "lang string, word binary, n long")
                    .groupBy("lang", "word").agg(F.sum("n").alias("n")), "lang-words")
    langs = sorted(r[0] for r in known.select("lang").distinct().collect())
    p = np.full((pieces.n, max(1, len(langs))), 1 / pieces.n)
    place = {l: i for i, l in enumerate(langs)}
    for _ in range(rounds if langs else 0):
        shared = spark.sparkContext.broadcast((pieces, p, place))

        def uses(batches):
            pieces, p, place = shared.value
            total = np.zeros_like(p)
            for batch in batches:
                for part in chunks(batch, 20_000):
                    total += expected(part.column(1).to_pylist(), np.array(part.column(2).to_pylist(), float),
                                      np.array([place[l] for l in part.column(0).to_pylist()]), pieces, p)
            i, l = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(l, pa.int32()), pa.array(total[i, l])],
                                             names=["piece", "lang", "uses"])

        # at most one row for each piece and language
        got = counted.mapInArrow(uses, "piece int, lang int, uses double").groupBy("piece", "lang").agg(F.sum("uses").alias("uses")).toPandas()
        shared.destroy()
        c = np.zeros_like(p)
        c[got["piece"], got["lang"]] = got["uses"]
        # every piece keeps some probability, more if other languages use it
        prior = (c.sum(axis=1) + 0.1) / (c.sum() + 0.1 * pieces.n)
        c += smoothing * len(langs) * 1000 * prior[:, None] / len(langs)
        p = c / c.sum(axis=0)
    return Model(langs, pieces, p)


class Scorer:
    """Scores texts; remembers words up to a bound and keeps the more frequent ones."""

    def __init__(self, model: Model):
        self.model, self.place = model, {}
        self.scores, self.uses = np.zeros((0, max(1, len(model.langs)))), np.zeros(0, np.int64)

    def forget(self) -> None:
        if len(self.place) > REMEMBERED:
            kept = np.argsort(-self.uses, kind="stable")[: REMEMBERED // 2]
            old = list(self.place)
            self.place = {old[i]: k for k, i in enumerate(kept.tolist())}
            self.scores, self.uses = self.scores[kept], self.uses[kept] // 2

    def learn(self, words: list[str]) -> None:
        for at in range(0, len(words), 50_000):
            some = words[at: at + 50_000]
            self.place.update(zip(some, range(len(self.place), len(self.place) + len(some))))
            self.scores = np.concatenate([self.scores, word_scores([*map(encoded, some)], self.model.pieces, self.model.p)])
        self.uses = np.concatenate([self.uses, np.zeros(len(words), np.int64)])

    def __call__(self, texts):
        """(language, score) of each text."""
        counts = [Counter(t.split()) if t and LETTER.search(t) else None for t in texts]
        self.forget()
        self.learn(list({w for c in counts if c for w in c if w not in self.place}))
        out = []
        for c in counts:
            if not c or not self.model.langs:
                out.append(("und", 0.0))
                continue
            at = np.fromiter(map(self.place.__getitem__, c), np.int64, len(c))
            times = np.fromiter(c.values(), np.int64, len(c))
            self.uses[at] += times
            total = times @ self.scores[at]
            best = int(total.argmax())
            out.append((self.model.langs[best], float(1 / np.exp(total - total[best]).sum())))
        return out


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score; map-only."""
    docs = without(docs, ["lang_pred", "score"])
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at, names = docs.columns.index(text), [*docs.columns, "lang_pred", "score"]

    def run(batches):
        scorer = Scorer(shared.value)
        for batch in batches:
            for part in chunks(batch):
                langs, scores = zip(*scorer(part.column(at).to_pylist()))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(langs), pa.array(scores)], names=names)

    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return docs.mapInArrow(run, schema)


def op1_langid(spark: SparkSession, sf_dir: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """Language of all ``documents``: doc_id, held_out, lang_pred, score; learned from the rows not held out."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", held_out("doc_id", 5, 0))
    model = train(docs.where("not held_out"), vocabulary=vocabulary)
    return predict(docs.select("doc_id", "held_out", "text"), model).drop("text")
