import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern.llm.toxicity import Rows, features, fit_chain, fit_linear, judge, label_categories, reject, score, screened, train, word_counts

BAD = ["scum", "moron", "clown"]


@pytest.fixture(scope="module")
def corpus(spark):
    rng = np.random.default_rng(4)
    vocabulary = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    docs, labels = [], []
    for i in range(900):
        words = rng.choice(vocabulary, int(rng.integers(5, 80))).tolist()
        toxic, junk = i % 7 == 0, i % 5 == 0
        if toxic:
            words.insert(int(rng.integers(len(words))), BAD[i % 3].upper() + ",")
        if junk:
            words += ["spam!!"] * 3
        docs.append((i, " ".join(words), toxic))
        if i % 2:
            labels.append((i, int(not junk), int(toxic)))
    return (
        spark.createDataFrame(docs, "doc_id long, text string, truth boolean"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


def test_held_out_accuracy(corpus):
    docs, labels = corpus
    got = judge(docs, labels).join(docs, "doc_id").join(labels, "doc_id", "left_anti").toPandas()
    assert (got.is_toxic == got.truth).mean() > 0.98
    left = reject(docs, labels)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == {r.doc_id for r in judge(docs, labels).where("not is_toxic").collect()}


def test_later_models_learn_from_unseen_folds():
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, (600, 2))
    y[:, 1] = y[:, 0]  # the second category follows the first
    features = [[0] if a and rng.random() < 0.9 else [1 + int(rng.integers(50))] for a in y[:, 0]]
    chain = fit_chain(features, ["wa", *(f"x{i}" for i in range(50))], y, ["a", "b"])
    assert chain.earlier[0] == [] and len(chain.earlier[1]) == 1
    a, b = chain.probabilities("wa")
    assert a > 0.9 and b > 0.9 and max(chain.probabilities("other")) < 0.5


def test_one_class_and_no_rows():
    x = Rows(np.array([0, 1, 2]), np.array([0, 0]), 1, np.zeros((2, 0)))
    w, b = fit_linear(x, np.array([1.0, 1.0]))
    assert not w.any() and b > 0
    empty = Rows(np.array([0]), np.array([], int), 1, np.zeros((0, 0)))
    assert fit_linear(empty, np.array([])) [1] == 0.0


def test_features():
    counts = word_counts("Idiot, you're a CLOWN%%% x1y a")
    assert counts == {"idiot": 1, "you": 1, "re": 1, "a": 2, "clown": 1, "x": 1, "y": 1}
    assert word_counts(None) == word_counts(" 12 ") == {}
    assert features(counts) >= {"a", "a!", "clown", "clown!", "^clo", "^clow", "^clo!"}
    long = word_counts("clown " + "word " * 500)
    assert features(long, {"clown", "word"}, {3: {"clo"}}) == {"clown", "word", "word!", "^clo"}
    assert features(word_counts("z" * 100)) >= {"^zzz", "z" * 100}  # words of any length


def test_odd_rows(spark, corpus, odd_docs, no_docs):
    labels = corpus[1]
    odd = labels.unionByName(labels).union(spark.createDataFrame([(None, 1, 1), (5, None, 1), (6, 1, None)], labels.schema))
    got = judge(odd_docs, odd)
    assert got.columns == ["doc_id", "p_low_quality", "p_toxic", "is_toxic"] and got.count() == odd_docs.count()
    assert judge(no_docs, odd).count() == 0
    assert reject(odd_docs, labels.limit(0)).columns == odd_docs.columns
    chain = train(odd_docs, labels.limit(0), label_categories())
    assert chain.probabilities("x") == pytest.approx([0.5, 0.5])
    same = got.where(F.col("doc_id") == 0).select("p_toxic").distinct()
    assert same.count() == 1


def dense_fit(x, y, kept):
    """Ridge logistic regression on some columns of a dense matrix, by gradient steps until they vanish."""
    x = np.column_stack((x[:, kept], np.ones(len(y))))
    u, ridge = np.zeros(x.shape[1]), np.append(np.full(len(kept), 1e-3), 0.0)
    step = 1.0 / (0.25 * np.linalg.eigvalsh(x.T @ x / len(y))[-1] + 1e-3)
    v, t = u.copy(), 1.0
    for _ in range(60_000):
        grad = x.T @ (1 / (1 + np.exp(-x @ v)) - y) / len(y) + ridge * v
        if np.abs(grad).max() < 1e-10:
            break
        u2 = v - step * grad
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        if grad @ (u2 - u) > 0:
            t2, u2_old = 1.0, u2
            v = u2_old
        else:
            v = u2 + (t - 1) / t2 * (u2 - u)
        u, t = u2, t2
    return u


def test_chain_equals_a_dense_refit():
    """The chain's weights against dense fits on the features that it selected, its second model on probabilities of
    folds that were not fitted on, and its judgement against the sums written out."""
    rng = np.random.default_rng(6)
    n, names = 450, [f"f{i}" for i in range(30)]
    x = (rng.random((n, 30)) < 0.2).astype(float)
    z = 2.5 * x[:, 0] + 2 * x[:, 1] - 1.5
    first = (rng.random(n) < 1 / (1 + np.exp(-z))).astype(int)
    second = (rng.random(n) < 1 / (1 + np.exp(-(2 * x[:, 2] + 1.5 * first - 1.5)))).astype(int)
    rows = [np.flatnonzero(r).tolist() for r in x]
    chain = fit_chain(rows, names, np.column_stack((first, second)), ["a", "b"])

    def refit(dense, y, weights):
        kept = np.flatnonzero(weights)
        assert len(kept)
        u = dense_fit(dense, y, kept)
        assert np.allclose(u[:-1], weights[kept], atol=1e-5)
        return kept, u

    whole = np.array([chain.words[0].get(w, 0.0) for w in names])
    kept, u = refit(x, first, whole)
    assert u[-1] == pytest.approx(chain.intercepts[0], abs=1e-5)
    unseen = np.zeros(n)
    for f in range(3):
        held = np.arange(n) % 3 == f
        part = [rows[i] for i in np.flatnonzero(~held)]
        start = np.concatenate(([0], np.cumsum([len(r) for r in part]))).astype(np.int64)
        w, b = fit_linear(Rows(start, np.array([i for r in part for i in r]), 30, np.zeros((len(part), 0))), first[~held].astype(float))
        kept, u = refit(x[~held], first[~held], w)
        unseen[held] = x[held][:, kept] @ u[:-1] + u[-1]
    weights = np.append([chain.words[1].get(w, 0.0) for w in names], chain.earlier[1])
    _, u = refit(np.column_stack((x, unseen)), second, weights)
    assert u[-1] == pytest.approx(chain.intercepts[1], abs=1e-5)
    for text in ("", "fa", " ".join(["fa", "fb", "fc"])):
        chain_of = type(chain)(["a", "b"], [{"fa": 2.0, "fb!": -1.0}, {"fc": 1.0}], [[], [0.5]], [-1.0, 0.25])
        a = -1.0 + 2.0 * ("fa" in text) - 1.0 * ("fb" in text)
        b = 0.25 + 1.0 * ("fc" in text) + 0.5 * a
        assert chain_of.probabilities(text) == pytest.approx([1 / (1 + np.exp(-a)), 1 / (1 + np.exp(-b))])


def test_screened_features_have_no_weight():
    """What the screen leaves out has weight 0 in fits of all features; what it keeps may have any."""
    rng = np.random.default_rng(9)
    n = 400
    y = np.column_stack((rng.random(n) < 0.4, rng.random(n) < 0.15)).astype(float)
    rows = [[0] * int(rng.random() < 0.1 + 0.8 * y[i, 1]) for i in range(n)]
    at = 1
    for k in (1, 1, 1, 2, 2, 3, 4, 5, 8, 12) * 60:  # rare features, found mostly in toxic documents
        likely = np.where(y[:, 1] > 0, 1.0, 0.02)
        for i in rng.choice(n, k, replace=False, p=likely / likely.sum()):
            rows[i].append(at)
        at += 1
    seen = np.bincount([j for r in rows for j in r], minlength=at)
    least = screened({int(k): int(m) for k, m in zip(*np.unique(seen[seen > 0], return_counts=True))}, y, 3)
    assert least > 1
    chain = fit_chain(rows, [f"f{j:04d}" for j in range(at)], y, ["a", "b"])
    for words in chain.words:
        assert all(seen[int(w[1:])] >= least for w in words)
    assert chain.words[1].get("f0000", 0) > 1
    assert screened({}, np.zeros((0, 2)), 3) == 1 and screened({1: 5}, np.zeros((4, 2)), 3) == 1


def test_columns_of_any_type_and_name(spark, corpus):
    docs, labels = corpus
    odd = docs.withColumns({"a.b": F.lit(1), "w`x": F.lit("y"), "span": F.expr("INTERVAL '1' MONTH"), "__p": F.lit(3)}).withColumn("is_toxic", F.lit("z"))
    left = reject(odd, labels)
    assert left.columns == odd.columns and left.schema["span"].dataType == odd.schema["span"].dataType
    assert 0 < left.count() < docs.count()
    scored = score(odd, train(docs, labels, label_categories()))
    assert scored.columns == [*odd.columns[:-1], "p_low_quality", "p_toxic", "is_toxic"] and scored.schema["is_toxic"].dataType.simpleString() == "boolean"
    assert scored.where("not is_toxic").count() == left.count()
