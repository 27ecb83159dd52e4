"""Toxicity by two class-conditional Kneser-Ney models whose backoff counts are shared.

Each class has an interpolated bigram model over the n-grams of its labelled documents:

    P_c(w | h) = x_c(h, w) / n_c(h) + l_c(h) P_c(w)         P_c(w) = x_c(w) / k_c + l_c P(w)

Counts are of contexts, as Kneser-Ney has them: a word counts once for each distinct history
and a bigram once for each distinct word before it, but neither more than once a document, so
a line that one text repeats, or one text in a thousand copies, weighs like one. The shared
distribution P counts the documents of the whole corpus that hold a word; P(w | h) is that of
both classes' bigrams. x is what an absolute discount leaves of a count, and l the mass that
the discounts free for the backoff. The discount is DISCOUNT beyond the count that the shared
distribution leads one to expect and DEVIATIONS standard deviations of it:

    x = max(0, n - m - DEVIATIONS sqrt(m (1 - q)) - DISCOUNT),  m = n_c(h) P(w | h)  or  k_c P(w)

where q is the class's share of the counts that are pooled. So whatever is rare, or as frequent in the class as elsewhere, is smoothed into the shared
counts in both classes, and its likelihoods differ by the backoff masses alone. A constant
discount was tried first; README has the figures. The classes are compared by the difference
of their log-likelihoods a word, and isotonic regression on a fold that the counts leave out
turns it into a score. In that difference P(w) cancels where neither class has a surplus x, so
the n-grams with a surplus are all that a scoring task needs to look up.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociq.llm.frames import SLICE_ROWS, flag_rows, fold_column, map_columns, mixed, schema_of, word_hashes
from lociq.plans.storage import discard, find_package, materialise

#: Labelled documents of each class that the classifier is fitted on, at most: those with the least hashes of their ids.
FIT_DOCS = 4000
DISCOUNT, DEVIATIONS = 0.75, 5.0
#: The history of a text's first word, and the word before that.
START = np.uint64(0x5BD1E9955BD1E995)
_WORDS = re.compile(r"\w+").findall
_ODD = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[str]:
    return _WORDS(text.lower()) if text else []


def hashed(text: str | None) -> np.ndarray:
    """64-bit hashes of the text's words in order."""
    words = words_of(text)
    return word_hashes(words) if words else np.empty(0, dtype=np.uint64)


def after(w: np.ndarray) -> np.ndarray:
    """The history of every word."""
    return np.concatenate([[START], w[:-1]])


def pair_keys(h: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mixed(mixed(h * _ODD) + w)


def _firsts(keys: np.ndarray) -> np.ndarray:
    """Where a key comes for the first time."""
    out = np.zeros(len(keys), dtype=bool)
    out[np.unique(keys, return_index=True)[1]] = True
    return out


_GRAMS = "g long, h long, w long, toxic boolean, pair int, word int"


def _grams(cols: dict) -> dict:
    """A row for each distinct (g, h, w) of a document; pair and word are 1 where the bigram and the word come first."""
    parts: dict[str, list] = {n.split()[0]: [] for n in _GRAMS.split(", ")}
    for text, toxic in zip(cols["text"], cols["toxic"], strict=True):
        w = hashed(text)
        if len(w):
            h = after(w)
            g = after(h)
            key = pair_keys(h, w)
            keep = _firsts(pair_keys(g, key))  # the first of a bigram or word is the first of its trigram too
            for n, v in (("g", g), ("h", h), ("w", w), ("toxic", np.full(len(w), toxic)), ("pair", _firsts(key).astype(np.int32)), ("word", _firsts(w).astype(np.int32))):
                parts[n].append(v[keep])
    out = {n: np.concatenate(v) if v else np.empty(0) for n, v in parts.items()}
    return {n: v.view(np.int64) if v.dtype == np.uint64 else v for n, v in out.items()}


def sample_counts(sample: DataFrame) -> DataFrame:
    """(h, w, n0, n1, d0, d1): by bigram and class, its count n and the documents d whose first w this is."""
    each = map_columns(sample.select("text", (F.col("toxic") > 0).alias("toxic")), _grams, _GRAMS)
    each = each.groupBy("h", "w", "g", "toxic").agg(F.sum("pair").alias("pair"), F.sum("word").alias("word"))
    of = lambda c, v: F.sum(F.when(F.col("toxic") == c, v).otherwise(0))
    count = lambda c: F.least(of(c, F.col("pair")), of(c, F.lit(1)))
    return each.groupBy("h", "w").agg(
        count(False).alias("n0"), count(True).alias("n1"), of(False, F.col("word")).alias("d0"), of(True, F.col("word")).alias("d1")
    )


def shared_counts(docs: DataFrame, vocabulary: np.ndarray) -> tuple[np.ndarray, int]:
    """How many of all documents hold each word of the sorted ``vocabulary``, and the sum of this over all words.

    Each task counts its own documents; what is gathered is a row a task and word.
    """
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have, total = known.value, 0
        counts = np.zeros(len(have) + 1, dtype=np.int64)
        for batch in batches:
            for lo in range(0, batch.num_rows, SLICE_ROWS):
                for text in batch.column(0).slice(lo, SLICE_ROWS).to_pylist():
                    words = np.unique(hashed(text))
                    total += len(words)
                    at = np.searchsorted(have, words)
                    at[at == len(have)] = 0
                    counts[at[have[at] == words]] += 1
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array([None, *at.tolist()], pa.int64()), pa.array([total, *counts[at].tolist()], pa.int64())], names=["place", "n"])

    find_package(docs.sparkSession)
    got = docs.select("text").mapInArrow(run, schema_of("place long, n long")).groupBy("place").agg(F.sum("n").alias("n")).toPandas()
    out, total = np.zeros(len(vocabulary), dtype=np.int64), got["place"].isna()
    out[got["place"][~total].to_numpy(dtype=np.int64)] = got["n"][~total]
    return out, int(got["n"][total].sum())


def surplus(n, expected, q):
    """What the discount leaves of a count, in numpy."""
    return np.maximum(0.0, n - expected - DEVIATIONS * np.sqrt(expected * max(0.0, 1 - q)) - DISCOUNT)


class Model:
    """Log-ratios of the n-grams that have a surplus, sorted by key, and the calibration.

    base is the ratio of any other word, and ``turns`` what a history with a surplus adds to
    the ratios of the words that have none after it.
    """

    def __init__(self) -> None:
        none = (np.empty(0, dtype=np.uint64), np.empty(0))
        self.words, self.pairs, self.turns, self.base = none, none, none, 0.0
        self.steps, self.levels = np.zeros(1), np.zeros(1)

    @staticmethod
    def _found(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        have, values = table
        if not len(have):
            return np.zeros(len(keys), dtype=bool), np.zeros(len(keys))
        at = np.searchsorted(have, keys)
        at[at == len(have)] = 0
        return have[at] == keys, values[at]

    def ratio(self, text: str | None) -> float:
        """The difference of the log-likelihoods, toxic less ordinary, a word; 0 without words."""
        w = hashed(text)
        if not len(w):
            return 0.0
        h = after(w)
        known, value = self._found(self.words, w)
        turned, turn = self._found(self.turns, h)
        out = np.where(known, value, self.base) + np.where(turned, turn, 0.0)
        if turned.any():
            paired, value = self._found(self.pairs, pair_keys(h, w))
            out[paired] = value[paired]
        return float(out.mean())

    def score(self, ratio) -> np.ndarray:
        """The isotonic level; a hundredth of the score follows the ratio alone, so that equal levels keep its order."""
        x = np.asarray(ratio, dtype=float)
        return 0.99 * np.interp(x, self.steps, self.levels) + 0.01 * (0.5 + np.arctan(100 * x) / math.pi)

    def calibrate(self, x: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> None:
        """Isotonic regression of the label on the ratio, by pooling adjacent violators; each block's share is smoothed by one row of the common share."""
        share = float((weight * toxic).sum() / weight.sum())
        blocks: list[list[float]] = []
        for value in np.unique(x):
            at = x == value
            blocks.append([value, value, float((weight * toxic)[at].sum()), float(weight[at].sum())])
            while len(blocks) > 1 and blocks[-2][2] * blocks[-1][3] >= blocks[-1][2] * blocks[-2][3]:
                _, hi, k, n = blocks.pop()
                blocks[-1] = [blocks[-1][0], hi, blocks[-1][2] + k, blocks[-1][3] + n]
        self.steps = np.array([v for lo, hi, _, _ in blocks for v in (lo, hi)])
        self.levels = np.maximum.accumulate([(k + share) / (n + 1) for _, _, k, n in blocks for _ in (0, 1)])


def _sorted(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.argsort(keys)
    return keys[at], values[at]


def _unsigned(column) -> np.ndarray:
    return column.to_numpy(dtype=np.int64).view(np.uint64)


def fit_classes(model: Model, docs: DataFrame, sample: DataFrame, weights: tuple[float, float]) -> None:
    """The two class models. ``weights`` bring the sampled documents of a class back to its share of the labels."""
    pairs = materialise(sample_counts(sample), "pairs")
    kinds = lambda c: F.least(F.sum(f"d{c}"), F.sum(F.when(F.col(f"n{c}") > 0, 1).otherwise(0)))
    one = pairs.groupBy("w").agg(kinds(0).alias("k0"), kinds(1).alias("k1")).toPandas()  # the words of 2 * FIT_DOCS documents
    one = one.assign(key=_unsigned(one["w"])).sort_values("key")
    key, k = one["key"].to_numpy(dtype=np.uint64), one[["k0", "k1"]].to_numpy(dtype=float).T
    if not len(key) or not k.sum(axis=1).all():
        discard(pairs)
        return
    held, total = shared_counts(docs, key)
    shared = (held + 0.5) / (total + 0.5 * (len(key) + 1))
    size = k.sum(axis=1)
    x = np.stack([surplus(k[c], size[c] * shared, size[c] / total) for c in (0, 1)])
    left = 1 - x.sum(axis=1) / size
    own = np.stack([x[c] / size[c] + left[c] * shared for c in (0, 1)])
    some = x.any(axis=0)
    model.words, model.base = (key[some], np.log(own[1] / own[0])[some]), float(np.log(left[1] / left[0]))

    histories = pairs.groupBy("h").agg(F.sum("n0").alias("h0"), F.sum("n1").alias("h1"))
    both = lambda a, b: F.col(a) * weights[0] + F.col(b) * weights[1]
    rest = pairs.join(histories, "h").withColumn("p", both("n0", "n1") / both("h0", "h1"))

    def beyond(c: int):
        n, mine = F.col(f"n{c}"), F.col(f"h{c}")
        expected, q = mine * F.col("p"), mine * weights[c] / both("h0", "h1")
        return F.greatest(F.lit(0.0), n - expected - DEVIATIONS * F.sqrt(expected * (1 - q)) - DISCOUNT) / F.greatest(mine, F.lit(1))

    two = rest.select("h", "w", beyond(0).alias("x0"), beyond(1).alias("x1")).filter("x0 > 0 or x1 > 0").toPandas()
    discard(pairs)
    if not len(two):
        return
    h, w, x = _unsigned(two["h"]), _unsigned(two["w"]), two[["x0", "x1"]].to_numpy(dtype=float).T
    turns, of = np.unique(h, return_inverse=True)
    back = np.stack([1 - np.bincount(of, x[c], len(turns)) for c in (0, 1)])
    p = own[:, np.searchsorted(key, w)]
    model.turns = (turns, np.log(back[1] / back[0]))
    model.pairs = _sorted(pair_keys(h, w), np.log((x[1] + back[1][of] * p[1]) / (x[0] + back[0][of] * p[0])))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on labelled rows whose fold is not 0; fold 4 calibrates, the others are counted.

    At most FIT_DOCS documents a class are read; the shared counts are of all documents. Rows
    with a null label or id are not used; where an id has several labels the larger counts,
    and every document with a labelled id is. With no labelled row of one class, every score
    is the share of the other (0 without any label). Where fold 4 lacks a class, the counted
    documents calibrate too.
    """
    rows = (
        labels.select("doc_id", "toxic").filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
        .withColumn("fold", fold_column()).filter("fold <> 0").withColumn("by", F.xxhash64("doc_id"))
    )
    sizes = {r.toxic: r.n for r in rows.groupBy((F.col("toxic") > 0).alias("toxic")).agg(F.count(F.lit(1)).alias("n")).collect()}
    n0, n1 = sizes.get(False, 0), sizes.get(True, 0)
    model = Model()
    model.levels = np.full(1, n1 / max(1, n0 + n1))
    if not n0 or not n1:
        return model
    least = lambda test: rows.filter(test).orderBy("by", "doc_id").limit(FIT_DOCS)
    picked = least("toxic > 0").unionByName(least("toxic <= 0")).select("doc_id", "toxic", "fold")
    # 2 * FIT_DOCS ids at most, so they are broadcast
    sample = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    weight = (n0 / min(n0, FIT_DOCS), n1 / min(n1, FIT_DOCS))
    fit_classes(model, docs, sample.filter("fold <> 4"), weight)
    # isotonic steps from as many numbers as there are sampled documents
    held = score_ratios(sample.select("text", "toxic", "fold"), model).toPandas()
    x, y, last = held["ratio"].to_numpy(), (held["toxic"] > 0).to_numpy(), (held["fold"] == 4).to_numpy()
    if len(x):
        use = last if y[last].any() and not y[last].all() else np.ones(len(x), dtype=bool)
        model.calibrate(x[use], y[use].astype(float), np.where(y[use], weight[1], weight[0]))
    return model


def score_ratios(sample: DataFrame, model: Model) -> DataFrame:
    return map_columns(sample, lambda c: {"ratio": [model.ratio(t) for t in c["text"]], "toxic": c["toxic"], "fold": c["fold"]}, "ratio double, toxic int, fold int")


def score_texts(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, ratio, score) for every row: the whole text's log-likelihood ratio a word, and the score.

    A text without words has ratio 0. Rows with the same doc_id, or a null one, each have theirs.
    """
    told = docs.sparkSession.sparkContext.broadcast(model)

    def run(cols: dict) -> dict:
        ratio = [told.value.ratio(t) for t in cols["text"]]
        return {"doc_id": cols["doc_id"], "ratio": ratio, "score": told.value.score(ratio).tolist()}

    return map_columns(docs.select("doc_id", "text"), run, "doc_id long, ratio double, score double")


def drop_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The documents whose score is below 0.5, with their columns and whole texts; every row is judged by its own text."""
    told = docs.sparkSession.sparkContext.broadcast(model)
    return flag_rows(docs, lambda text: bool(told.value.score(told.value.ratio(text)) < 0.5))
