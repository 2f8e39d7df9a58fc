"""Toxicity: a counterfactually regularised classifier.

A logistic model over which features a text has: its words, and their first
and last letters.  Besides the labels' loss, training swaps identity terms
(groups of people, in four languages) in the labelled sentences for others of
their kind, inserts them into sentences that have none, and penalises the
squared change of the score before the logistic curve, so the mention of a
group alone does not raise it, neither by the word nor by letters that it
shares with toxic words.

Training: a bounded sample of labelled rows (``max_rows``, smallest hashes of
the id first).  Spark counts in how many toxic and other rows of it each
feature occurs; the ``max_features`` that tell most are kept, identity terms
always.  Spark also counts the changed copies by the terms that go and come.
The sparse rows of these features and the pairs of terms (bounded by both) are
fitted on the driver.  Scoring is map-only over whole texts; workers remember words up to a
bound.

Defined results: null and empty texts have no features and get the score of
none; without labels of both kinds every score is 0; a doc_id labelled more
than once counts as toxic if any of its labels says so; null labels are left
out.  Added columns replace columns of the same name.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fileflow.llm.common import chunks, held_out, saved, table, without

#: Identity terms by language and kind; a term is swapped for the others of its line.
IDENTITY = (
    # English
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "sikhs", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "sikh", "atheist"),
    ("black", "white", "brown"),
    ("african", "asian", "european", "american", "arab", "latino", "mexican", "indian", "chinese"),
    ("gay", "lesbian", "straight", "bisexual", "transgender"),
    ("immigrants", "refugees", "citizens", "foreigners"),
    ("disabled", "deaf", "blind"),
    # French
    ("femmes", "hommes", "filles", "garçons"),
    ("musulmans", "chrétiens", "juifs", "hindous", "bouddhistes", "athées"),
    ("africains", "asiatiques", "européens", "américains", "arabes", "mexicains", "indiens", "chinois"),
    ("homosexuels", "lesbiennes", "hétérosexuels", "bisexuels"),
    ("immigrés", "réfugiés", "citoyens", "étrangers"),
    ("handicapés", "sourds", "aveugles"),
    # German
    ("frauen", "männer", "mädchen", "jungen"),
    ("muslime", "christen", "juden", "buddhisten", "atheisten"),
    ("afrikaner", "asiaten", "europäer", "amerikaner", "araber", "mexikaner", "inder", "chinesen"),
    ("schwule", "lesben", "heterosexuelle", "bisexuelle"),
    ("einwanderer", "flüchtlinge", "bürger", "ausländer"),
    ("behinderte", "gehörlose", "blinde"),
    # Spanish
    ("mujeres", "hombres", "chicas", "chicos"),
    ("musulmanes", "cristianos", "judíos", "hindúes", "budistas", "ateos"),
    ("africanos", "asiáticos", "europeos", "americanos", "árabes", "mexicanos", "indios", "chinos"),
    ("homosexuales", "lesbianas", "heterosexuales", "bisexuales"),
    ("inmigrantes", "refugiados", "ciudadanos", "extranjeros"),
    ("discapacitados", "sordos", "ciegos"),
)
SWAPS = {w: tuple(x for x in ws if x != w) for ws in IDENTITY for w in ws}

WORD = re.compile(r"\w+")
#: Lengths of the word starts and ends that are features.
ENDS = (4, 5, 6)
#: Words whose features a worker remembers before it starts afresh.
REMEMBERED = 500_000
#: Counts of features that a worker holds before it hands them on.
HELD = 150_000


def words(text: str | None) -> set[str]:
    return set(WORD.findall(text.lower())) if text else set()


def features(word: str) -> list[str]:
    """A word, its first and its last letters."""
    return (["=" + word] + ["^" + word[:k] for k in ENDS if len(word) > k]
            + ["$" + word[-k:] for k in ENDS if len(word) > k])


def counterfactuals(found: set[str]) -> list[tuple[str, str]]:
    """(term that goes, term that comes) of each changed copy of a text with these words.

    A term is swapped for each of its kind that the text lacks.  A text without any term gets each term inserted
    (nothing goes).
    """
    held = sorted(found & SWAPS.keys())
    if not held:
        return [("", b) for b in SWAPS]
    return [(a, b) for a in held for b in SWAPS[a] if b not in found]


class Model:
    """Weights of the features, the score of a text without any, and how many changed copies the fit compared."""

    def __init__(self, weights: dict[str, float], bias: float, swapped: int = 0, inserted: int = 0):
        self.weights, self.bias, self.swapped, self.inserted = weights, bias, swapped, inserted
        self.place = {f: i for i, f in enumerate(weights)}
        self.values = np.fromiter(weights.values(), float, len(weights))


class Scorer:
    def __init__(self, model: Model):
        self.model, self.seen = model, {}

    def ids(self, word: str) -> tuple[int, ...]:
        got = self.seen.get(word)
        if got is None:
            if len(self.seen) > REMEMBERED:
                self.seen.clear()
            place = self.model.place
            got = self.seen[word] = tuple(place[f] for f in features(word) if f in place)
        return got

    def present(self, found: set[str]) -> set[int]:
        out: set[int] = set()
        seen, ids = self.seen, self.ids
        for w in found:
            got = seen.get(w)
            if got is None:
                got = ids(w)
            if got:
                out.update(got)
        return out

    def __call__(self, text: str | None) -> float:
        at = self.present(words(text))
        z = self.model.bias + float(self.model.values[sorted(at)].sum())
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


def changes(pairs: dict[tuple[str, str], int], place: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """What each (gone, new) pair of terms changes in the features, a row a pair, and the pair's share of the penalty.

    Swaps and insertions are averaged apart, so many texts without a term don't outweigh the few with one.  Features
    that another word of the text shares count as changed.  At most terms times the terms of a kind rows.
    """
    d = np.zeros((len(pairs), len(place) + 1), np.float32)
    for i, (gone, new) in enumerate(pairs):
        for sign, word in ((-1, gone), (1, new)):
            d[i, [place[f] for f in features(word) if f in place] if word else []] += sign
    n = np.fromiter(pairs.values(), float, len(pairs))
    kind = np.array([gone == "" for gone, _ in pairs], bool)
    for one in (kind, ~kind):
        n[one] /= max(1.0, n[one].sum())
    return d, n.astype(np.float32)


def gradient(w, x, y, share, d, weight, penalty: float, decay):
    """Of the loss: sum share * log loss + penalty * sum weight * (d w)^2 + decay * w^2 / 2."""
    p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
    return x.T @ (share * (p - y)) + decay * w + 2 * penalty * (d.T @ (weight * (d @ w)))


def fit(rows, labels, n_features: int, changed, penalty: float = 1.0, ridge: float = 0.02, steps: int = 300):
    """Weights and bias: balanced logistic loss + ridge + penalty on score changes of the changed copies.

    ``rows`` lists the features of each row; ``changed`` is what ``changes`` gives.  Accelerated gradient steps.
    """
    x = np.zeros((len(rows), n_features + 1), np.float32)
    for i, at in enumerate(rows):
        x[i, list(at)] = 1
    x[:, -1] = 1
    y = np.asarray(labels, np.float32)
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y == 0).sum())).astype(np.float32)
    decay = np.full(n_features + 1, ridge / 100, np.float32)
    decay[-1] = 0
    # adaptive steps need no bound on the curvature
    w, m, v = (np.zeros(n_features + 1, np.float32) for _ in range(3))
    for step in range(1, steps + 1):
        g = gradient(w, x, y, share, *changed, penalty, decay)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.08 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return w[:-1].astype(float), float(w[-1])


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", text: str = "text", max_rows: int = 6000,
          max_features: int = 1500, min_rows: int = 4, min_chi2: float = 20.0, penalty: float = 1.0) -> Model | None:
    """Fit on a bounded sample of ``labels`` (doc_id, label); None without labels of both kinds."""
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max(F.col(label).cast("int")).alias("_y"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)  # bounded by max_rows
    # one text an id, whatever repeats, so the sample is bounded too
    own = F.struct(F.xxhash64("_text"), F.col("_text"))
    sample = saved(docs.select("doc_id", F.col(text).alias("_text")).join(F.broadcast(chosen), "doc_id").groupBy("doc_id")
                   .agg(F.max("_y").alias("_y"), F.min_by("_text", own).alias("_text")).select("_y", "_text"), "toxicity-sample")

    def count(batches):
        held = Counter()

        def out():
            keys = list(held)
            rows = pa.RecordBatch.from_arrays([pa.array([f for f, _ in keys]), pa.array([y for _, y in keys], pa.int32()),
                                               pa.array([held[k] for k in keys], pa.int64())], names=["f", "y", "n"])
            held.clear()
            return rows

        for batch in batches:
            for part in chunks(batch, 64):
                for y, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    held.update((f, y) for f in {f for w in words(t) for f in features(w)})
                    held[("", y)] += 1
                if len(held) > HELD:
                    yield out()
        if held:
            yield out()

    counted = (sample.mapInArrow(count, "f string, y int, n long").groupBy("f")
               .agg(F.sum(F.when(F.col("y") > 0, F.col("n")).otherwise(0)).alias("pos"),
                    F.sum(F.when(F.col("y") > 0, 0).otherwise(F.col("n"))).alias("neg"))).where(F.col("pos") + F.col("neg") >= min_rows)
    counted = counted.persist()
    total = counted.where("f = ''").first()
    if total is None or not total["pos"] or not total["neg"]:
        counted.unpersist()
        return None
    n_pos, n_neg = total["pos"], total["neg"]
    n, has = n_pos + n_neg, F.col("pos") + F.col("neg")
    chi2 = n * (F.col("pos") * n_neg - F.col("neg") * n_pos).cast("double") ** 2 / (has * (n - has + 0.5) * n_pos * n_neg)
    # features that chance does not explain; those that tell most first
    kept = (counted.where("f <> ''").withColumn("chi2", chi2).where(F.col("chi2") >= min_chi2)
            .orderBy(F.col("chi2").desc(), "f").limit(max_features).collect())
    names = [r["f"] for r in kept]
    names += [f for f in ("=" + w for w in SWAPS) if f not in set(names)]
    counted.unpersist()
    blank = Model(dict.fromkeys(names, 0.0), 0.0)
    shared = docs.sparkSession.sparkContext.broadcast(blank)

    def encode(batches):
        scorer = Scorer(shared.value)
        for batch in batches:
            for part in chunks(batch, 64):
                at = [sorted(scorer.present(words(t))) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(at, pa.list_(pa.int32()))], names=["y", "at"])

    def copies(batches):
        n = Counter()  # at most the pairs of terms
        for batch in batches:
            for t in batch.column(1).to_pylist():
                n.update(counterfactuals(words(t)))
        yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in n], pa.string()), pa.array([b for _, b in n], pa.string()),
                                          pa.array(list(n.values()), pa.int64())], names=["gone", "new", "n"])

    rows = sample.mapInArrow(encode, "y int, at array<int>").collect()  # max_rows of max_features
    pairs = {(r["gone"], r["new"]): r["n"] for r in sample.mapInArrow(copies, "gone string, new string, n long")
             .groupBy("gone", "new").agg(F.sum("n").alias("n")).orderBy("gone", "new").collect()}
    weights, bias = fit([r["at"] for r in rows], [int(r["y"] > 0) for r in rows], len(names), changes(pairs, blank.place), penalty)
    inserted = sum(n for (a, _), n in pairs.items() if not a)
    return Model(dict(zip(names, weights)), bias, sum(pairs.values()) - inserted, inserted)


def score(docs: DataFrame, model: Model | None, threshold: float = 0.7, text: str = "text") -> DataFrame:
    """``docs`` with score (higher: toxic likelier) and predicted; map-only."""
    docs = without(docs, ["score", "predicted"])
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at, names = docs.columns.index(text), [*docs.columns, "score", "predicted"]

    def run(batches):
        scorer = Scorer(shared.value) if shared.value else lambda t: 0.0
        for batch in batches:
            for part in chunks(batch):
                scores = [scorer(t) for t in part.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores, pa.float64()),
                                                  pa.array([int(s >= threshold) for s in scores], pa.int32())], names=names)

    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return docs.mapInArrow(run, schema)


def trained_on(spark: SparkSession, sf_dir: str) -> Model | None:
    """The model from the labelled documents of the folder that are not held out."""
    labels = table(spark, sf_dir, "labels").where(~held_out("doc_id", 3, 1))
    return train(table(spark, sf_dir, "documents"), labels)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all ``documents``: doc_id, held_out, score, predicted."""
    docs = table(spark, sf_dir, "documents").select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "text")
    return score(docs, trained_on(spark, sf_dir)).drop("text")
