"""Toxicity by a classifier chain of sparse linear models."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Container, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.llm.words import quoted, unused
from lectern.runtime import materialise, ship

#: Lengths of the word beginnings that are features beside whole words, for languages that inflect and compound.
PREFIXES = (3, 4, 5, 6)
#: A feature that makes up this share of a text's words also counts as frequent there.
FREQUENT = 1 / 200
_LETTERS = re.compile(r"[^\W\d_]+")


def word_counts(text: str | None) -> Counter[str]:
    """The lower-case letter runs of a whole text and how often each occurs."""
    found = Counter(text.lower().split()) if text else Counter()
    for w in [w for w in found if not w.isalpha()]:
        n = found.pop(w)
        for run in _LETTERS.findall(w):
            found[run] += n
    return found


def features(counts: Counter[str], whole: Container[str] | None = None, starts: dict[int, Container[str]] | None = None) -> set[str]:
    """Feature names: a word, ``^`` and a word's beginning, and either with ``!`` where it is frequent.

    With ``whole`` and ``starts`` (by length) only those words and beginnings are looked for.
    """
    total, least, found = counts.total(), 1, Counter()
    for w, n in counts.items():
        if whole is None or w in whole:
            found[w] += n
        for k in PREFIXES if starts is None else starts:
            if len(w) > k and (starts is None or w[:k] in starts[k]):
                found["^" + w[:k]] += n
    least = total * FREQUENT
    return found.keys() | {w + "!" for w, n in found.items() if n >= least}


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


@dataclass
class Rows:
    """Sparse 0/1 features: of row i, columns index[start[i]:start[i + 1]]; ``extra`` holds dense features."""

    start: np.ndarray
    index: np.ndarray
    width: int
    extra: np.ndarray

    def take(self, rows: np.ndarray) -> Rows:
        n = np.diff(self.start)[rows]
        index = np.concatenate([self.index[self.start[r] : self.start[r + 1]] for r in rows]) if len(rows) else self.index[:0]
        return Rows(np.concatenate(([0], np.cumsum(n))), index.astype(np.int64), self.width, self.extra[rows])

    def score(self, w: np.ndarray) -> np.ndarray:
        at = np.concatenate(([0.0], np.cumsum(w[: self.width][self.index])))
        return at[self.start[1:]] - at[self.start[:-1]] + self.extra @ w[self.width :]

    def back(self, r: np.ndarray) -> np.ndarray:
        sparse = np.bincount(self.index, weights=np.repeat(r, np.diff(self.start)), minlength=self.width)
        return np.concatenate((sparse, r @ self.extra))


def fit_linear(x: Rows, y: np.ndarray, rounds: int = 120) -> tuple[np.ndarray, float]:
    """Logistic regression: an L1-penalised fit selects features, a fit with a slight L2 penalty weighs those.

    A feature's penalty is the slope that chance alone would give the strongest of as many unrelated features of its
    spread, so few rows select few features. One class only: no features, and an intercept from the smoothed rate.
    """
    n, d = len(y), x.width + x.extra.shape[1]
    rate = (y.sum() + 0.5) / (n + 1.0)
    b0 = float(np.log(rate / (1 - rate)))
    if n == 0 or y.min() == y.max():
        return np.zeros(d), b0
    seen = np.bincount(x.index, minlength=x.width) / n
    spread = np.concatenate((np.sqrt(seen * (1 - seen)), x.extra.std(axis=0)))
    penalty = np.sqrt(2 * np.log(max(d, 2)) / n * rate * (1 - rate)) * spread
    size = np.mean(np.diff(x.start)) + (x.extra**2).sum(axis=1).mean() + 1.0
    step, w, b = 4.0 / min(size, 60.0), np.zeros(d), b0
    v, vb, t = w.copy(), b, 1.0
    loss_before = np.inf
    for _ in range(rounds):
        z = x.score(v) + vb
        r = (_sigmoid(z) - y) / n
        moved = v - step * x.back(r)
        w2 = np.sign(moved) * np.maximum(np.abs(moved) - step * penalty, 0.0)
        b2 = vb - step * r.sum()
        z2 = x.score(w2) + b2
        loss = float(np.mean(np.logaddexp(0, z2) - y * z2) + (penalty * np.abs(w2)).sum())
        if loss > loss_before + 1e-9:  # too long a step, or too much momentum
            step, v, vb, t = step / 2, w.copy(), b, 1.0
            continue
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, vb = w2 + (t - 1) / t2 * (w2 - w), b2 + (t - 1) / t2 * (b2 - b)
        w, b, t, loss_before = w2, b2, t2, loss
    kept = np.flatnonzero(w)
    if not len(kept):
        return w, b
    place = np.full(d, -1)
    place[kept] = np.arange(len(kept))
    dense = np.zeros((n, len(kept) + 1))
    dense[:, -1] = 1.0
    row, col = np.repeat(np.arange(n), np.diff(x.start)), place[x.index]
    dense[row[col >= 0], col[col >= 0]] = 1.0
    for k in range(x.extra.shape[1]):
        if place[x.width + k] >= 0:
            dense[:, place[x.width + k]] = x.extra[:, k]
    ridge = np.full(len(kept) + 1, 1e-3)
    ridge[-1] = 0.0
    u = np.append(w[kept], b)
    for _ in range(25):
        p = _sigmoid(dense @ u)
        grad = dense.T @ (p - y) / n + ridge * u
        hess = (dense * (p * (1 - p) / n)[:, None]).T @ dense + np.diag(ridge + 1e-9)
        move = np.linalg.solve(hess, grad)
        u -= move
        if np.abs(move).max() < 1e-8:
            break
    w = np.zeros(d)
    w[kept] = u[:-1]
    return w, float(u[-1])


def screened(docs_with: dict[int, int], y: np.ndarray, folds: int) -> int:
    """In how many documents a feature must be so that a fit can select it at all: rarer ones have weight 0 in each.

    ``docs_with``: how many features are in so many documents. A feature in k of n documents has a slope of under k / n, and is
    not selected where that is below its penalty: k < n c / (1 + c), with c the square of the penalty over the spread.
    The bound holds for each category, on all rows and on each fold's, and for the number of features that it leaves.
    """
    n, odds = len(y), []
    for k in range(y.shape[1]):
        for f in range(-1, folds):
            some = y[np.arange(n) % folds != f, k]
            if len(some) and some.min() != some.max():
                rate = (some.sum() + 0.5) / (len(some) + 1.0)
                odds.append((rate * (1 - rate), len(some)))
    least = 1
    while odds and docs_with:
        wide = max(2, sum(m for k, m in docs_with.items() if k > least))
        if any(least >= size * (c := 2 * np.log(wide) / size * spread) / (1 + c) for spread, size in odds):
            break
        least += 1
    return least


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


@dataclass
class Chain:
    """A fitted chain: for each category its words' weights, the weights of earlier categories' log odds, the intercept."""

    categories: list[str]
    words: list[dict[str, float]]
    earlier: list[list[float]]
    intercepts: list[float]

    def __post_init__(self) -> None:
        names = {w.rstrip("!") for words in self.words for w in words}
        self.whole = {w for w in names if w[0] != "^"}
        self.starts: dict[int, set[str]] = {}
        for w in names - self.whole:
            self.starts.setdefault(len(w) - 1, set()).add(w[1:])

    def probabilities(self, text: str | None) -> list[float]:
        found = features(word_counts(text), self.whole, self.starts)
        odds: list[float] = []
        for words, earlier, b in zip(self.words, self.earlier, self.intercepts):
            z = b + sum(words[w] for w in sorted(found & words.keys())) + sum(a * o for a, o in zip(earlier, odds))
            odds.append(float(np.clip(z, -13.8, 13.8)))
        return [1.0 / (1.0 + float(np.exp(-z))) for z in odds]


def fit_chain(rows: list[list[int]], vocabulary: list[str], labels: np.ndarray, categories: list[str], folds: int = 3) -> Chain:
    """Fit the chain on rows of feature numbers; see ``fit_flat``."""
    start = np.concatenate(([0], np.cumsum([len(r) for r in rows]))).astype(np.int64)
    return fit_flat(start, np.array([i for r in rows for i in r], dtype=np.int64), vocabulary, labels, categories, folds)


def fit_flat(start: np.ndarray, index: np.ndarray, vocabulary: list[str], labels: np.ndarray, categories: list[str], folds: int = 3) -> Chain:
    """Fit the chain on documents whose features are ``index[start[i]:start[i + 1]]``.

    Later models learn from earlier categories' out-of-fold probabilities, never from fitted ones.
    """
    n = len(start) - 1
    fold = np.arange(n) % folds
    extra = np.zeros((n, 0))
    words, earlier, intercepts = [], [], []
    for k in range(len(categories)):
        x, y = Rows(start, index, len(vocabulary), extra), labels[:, k].astype(float)
        w, b = fit_linear(x, y)
        words.append({vocabulary[i]: float(w[i]) for i in np.flatnonzero(w[: x.width])})
        earlier.append([float(v) for v in w[x.width :]])
        intercepts.append(b)
        if k + 1 < len(categories):
            unseen = np.zeros(n)
            for f in range(folds):
                a, held = np.flatnonzero(fold != f), np.flatnonzero(fold == f)
                wf, bf = fit_linear(x.take(a), y[a])
                unseen[held] = x.take(held).score(wf) + bf
            extra = np.column_stack((extra, _logit(_sigmoid(unseen))))
    return Chain(list(categories), words, earlier, intercepts)


def train(docs: DataFrame, labels: DataFrame, categories: dict[str, Column], max_rows: int = 4000, folds: int = 3) -> Chain:
    """Fit a chain on at most ``max_rows`` labelled documents, chosen by a hash of doc_id over all labelled documents.

    All features of those documents take part, whatever their length and number; those too rare for any fit to select
    them (see ``screened``) are left out beforehand, which changes no weight. Features are found and counted on the executors;
    the driver gets those that are left, and their numbers by document. Labels with a null take no part; of several
    labels or texts of one id the greatest counts. No labels: all probabilities are 0.5, and nothing is judged toxic.
    """
    spark = docs.sparkSession
    ship(spark)
    names = list(categories)
    known = labels.select("doc_id", *[c.cast("int").alias(f"__y{i}") for i, c in enumerate(categories.values())])
    known = known.dropna().groupBy("doc_id").agg(*[F.max(f"__y{i}").alias(f"__y{i}") for i in range(len(names))])
    chosen = known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    chosen = materialise(chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows), "labelled")

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [sorted(features(word_counts(t.as_py()))) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.list_(pa.string()))], names=["doc_id", "words"])

    # max_rows ids: a bounded table
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_semi")
    schema = docs.select("doc_id").schema.add("words", T.ArrayType(T.StringType()))
    bags = materialise(texts.mapInArrow(named, schema).groupBy("doc_id").agg(F.max("words").alias("words")), "bags")
    found = chosen.join(bags.select("doc_id"), "doc_id").orderBy("doc_id").drop("doc_id").toArrow().to_pydict()
    y = np.array([found[f"__y{i}"] for i in range(len(names))], dtype=float).T.reshape(-1, len(names))
    counted = materialise(bags.select(F.explode("words").alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n")), "features")
    docs_with = {r.n: r.m for r in counted.groupBy("n").agg(F.count(F.lit(1)).alias("m")).collect()}  # at most max_rows rows
    vocabulary = sorted(counted.where(F.col("n") >= screened(docs_with, y, folds)).select("w").toArrow().column("w").to_pylist())
    place = {w: i for i, w in enumerate(vocabulary)}

    def numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = [[place[w] for w in ws if w in place] for ws in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "at"])

    schema = docs.select("doc_id").schema.add("at", T.ArrayType(T.IntegerType()))
    at = bags.mapInArrow(numbers, schema).orderBy("doc_id").select("at").toArrow().column("at").combine_chunks()
    start = np.concatenate(([0], np.cumsum(at.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)))) if len(at) else np.zeros(1, np.int64)
    return fit_flat(start, at.flatten().to_numpy(zero_copy_only=False).astype(np.int64) if len(at) else np.zeros(0, np.int64), vocabulary, y, names, folds)


def judged(text: Column, chain: Chain) -> Column:
    """The chain's probabilities of a text, in the order of its categories."""

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([chain.probabilities(t.as_py()) for t in texts], pa.list_(pa.float64()))

    return run(text)


def score(docs: DataFrame, chain: Chain, threshold: float = 0.5) -> DataFrame:
    """``docs`` with a probability ``p_<category>`` for each category and ``is_<last category>`` (that probability > threshold).

    Whole texts are read. A null, empty or wordless text has the chain's base probabilities. Each row is judged by
    itself, so ties and repeated rows agree. Columns of ``docs`` with those names are replaced; others, of any type and name,
    stay: only the text goes to Python. An empty table gives an empty result.
    """
    ship(docs.sparkSession)
    new = [f"p_{c}" for c in chain.categories]
    flag = f"is_{chain.categories[-1]}"
    keep = [quoted(c) for c in docs.columns if c not in {*new, flag}]
    (p,) = unused(docs, "__p")
    rows = docs.withColumn(p, judged(F.col("text"), chain))
    return rows.select(*keep, *[F.col(p)[i].alias(c) for i, c in enumerate(new)], (F.col(p)[len(new) - 1] > threshold).alias(flag))


def label_categories() -> dict[str, Column]:
    """The categories that the labels table holds, in the chain's order: junk first, then toxicity."""
    return {"low_quality": F.lit(1) - F.col("quality"), "toxic": F.col("toxic")}


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, p_low_quality, p_toxic, is_toxic`` for every row of ``docs``.

    The chain is fitted on the labelled rows (see ``train``) and reads whole texts. A null, empty or wordless text has
    the base probabilities; null and repeated ids, ties and repeated rows are each judged by their text; other columns,
    whatever their names, are ignored; an empty table gives an empty result.
    """
    chain = train(docs, labels, label_categories())
    return score(docs.select("doc_id", "text"), chain).select("doc_id", "p_low_quality", "p_toxic", "is_toxic")


def reject(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose toxicity is not above ``threshold``, with the same columns.

    Odd rows as in ``score``; extra columns of any type and name are kept.
    """
    ship(docs.sparkSession)
    chain = train(docs, labels, label_categories())
    return docs.where(judged(F.col("text"), chain)[len(chain.categories) - 1] <= threshold)
