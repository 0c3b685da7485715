"""Approximate nearest neighbours by cross-polytope hashing."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.runtime import materialise, ship

#: Probe sequences are kept to so many cells a table.
MOST_PROBES = 16384
#: Rows a cell for which two hashes a table suffice; larger tables of vectors take three.
ROWS_PER_CELL = 4096


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of rows, scaled to keep lengths; the width is a power of two."""
    n, d = x.shape
    h = 1
    while h < d:
        x = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack((x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]), axis=2).reshape(n, d)
        h *= 2
    return x / np.sqrt(d)


def along(x: np.ndarray, table: int, seed: int, number: int = 0) -> np.ndarray:
    """Each row's length along every signed axis, after the pseudo-rotation of the table's hash of that number.

    The rotation is three rounds of random signs and a Hadamard transform. Axis i is number i, its opposite i + width.
    """
    d = 1 << max(0, int(x.shape[1] - 1).bit_length())
    y = np.zeros((len(x), d))
    y[:, : x.shape[1]] = x
    rng = np.random.default_rng([seed, table, number])
    for _ in range(3):
        y = hadamard(y * rng.choice([-1.0, 1.0], d))
    return np.concatenate((y, -y), axis=1)


def axes(x: np.ndarray, table: int, seed: int, probes: int, number: int = 0) -> np.ndarray:
    """For each row the ``probes`` nearest signed axes under a hash, nearest first."""
    lengths = along(x, table, seed, number)
    if probes == 1:
        return lengths.argmax(axis=1)[:, None]
    return np.argsort(-lengths, axis=1, kind="stable")[:, :probes]


def cells(x: np.ndarray, table: int, hashes: int, seed: int) -> np.ndarray:
    """The cell of each row: its nearest signed axis under each of the table's hashes, as one number."""
    out, sides = np.zeros(len(x), np.int64), sides_of(x.shape[1])
    for i in range(hashes):
        out = out * sides + axes(x, table, seed, 1, i)[:, 0]
    return out


def sides_of(width: int) -> int:
    """Signed axes of vectors of this width, filled up to a power of two."""
    return 2 << max(0, int(width - 1).bit_length())


def shortfalls(x: np.ndarray, table: int, hashes: int, seed: int) -> list[np.ndarray]:
    """For each hash of a table how much shorter each row is along every signed axis than along its nearest.

    A row's loss at a cell is the sum of these over the cell's axes, added up in the hashes' order.
    """
    lengths = (along(x, table, seed, i) for i in range(hashes))
    return [y.max(axis=1, keepdims=True) - y for y in lengths]


def probed(x: np.ndarray, table: int, hashes: int, seed: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """For each row the ``most`` cells of least loss, least first, and these losses."""
    sides = sides_of(x.shape[1])
    wide = min(sides, int(MOST_PROBES ** (1 / hashes) + 1e-9))
    loss, number = np.zeros((len(x), 1)), np.zeros((len(x), 1), np.int64)
    for short in shortfalls(x, table, hashes, seed):
        near = np.argsort(short, axis=1, kind="stable")[:, :wide]
        loss = (loss[:, :, None] + np.take_along_axis(short, near, axis=1)[:, None, :]).reshape(len(x), -1)
        number = (number[:, :, None] * sides + near[:, None, :]).reshape(len(x), -1)
    order = np.argsort(loss, axis=1, kind="stable")[:, :most]
    return np.take_along_axis(number, order, axis=1), np.take_along_axis(loss, order, axis=1)


def usable(v: Column) -> Column:
    """Not null, no null or non-finite component, and not all zero."""
    fine = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))
    return F.coalesce(fine & F.exists(v, lambda c: c != 0), F.lit(False))


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def cosines(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Cosine of each row of ``q`` with that of ``x`` in double precision; equal pairs get equal values wherever they stand.

    Rows are scaled by a power of two first, which changes no digit, so that squares neither overflow nor vanish.
    """
    q, x = (np.ldexp(v, -np.frexp(np.abs(v).max(axis=1, keepdims=True))[1]) for v in (q, x))
    return (x * q).sum(axis=1) / (np.sqrt((q * q).sum(axis=1)) * np.sqrt((x * x).sum(axis=1)))


def _matrix(column: pa.Array | pd.Series) -> np.ndarray:
    if isinstance(column, pd.Series):
        return np.stack(column.to_numpy()).astype(float)
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)


@dataclass(frozen=True)
class Plan:
    """Hashes a table, tables, and cells that a query probes in each; ``recall`` and ``met`` (share of the rows that a
    query is compared with, repeats counted) are what the sample gave."""

    hashes: int
    tables: int
    probes: int
    recall: float
    met: float


def choose(queries: np.ndarray, found: np.ndarray, of: np.ndarray, rows: np.ndarray, seed: int, recall: float, tables: int, most_hashes: int) -> Plan:
    """The plan that compares least among those which find ``recall`` of the sample's true neighbours.

    ``found`` are true neighbours of ``queries[of]``; ``rows`` are a sample of all rows. Where no plan does, every
    cell of one table is probed, which finds all.
    """
    best = Plan(1, 1, sides_of(queries.shape[1]), 1.0, 1.0)
    for hashes in range(1, most_hashes + 1):
        near, met = [], []
        for t in range(tables):
            order = probed(queries, t, hashes, seed, MOST_PROBES)[0]
            place = [{c: i for i, c in enumerate(r)} for r in order.tolist()]
            far = order.shape[1]
            near.append([place[q].get(c, far) for q, c in zip(of.tolist(), cells(found, t, hashes, seed).tolist())])
            sample = cells(rows, t, hashes, seed).tolist()
            met.append([[p.get(c, far) for c in sample] for p in place])
            within, seen = np.array(near).min(axis=0), np.array(met)
            # from one cell on, each number a fifth larger
            for n in sorted({int(1.2**i) for i in range(60) if 1.2**i <= min(far, MOST_PROBES // 4)}):
                share, got = float((seen < n).sum(axis=0).mean()), float((within < n).mean())
                if got >= recall and share < best.met:
                    best = Plan(hashes, t + 1, n, got, share)
    return best


def _top(qid: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int, slack: float) -> np.ndarray:
    """Places of each query's ``k`` best ids, each id at its best; with ``slack``, of all that reach the last of these or come that near, all where ids are fewer."""
    order = np.lexsort((-score, ids, qid))
    q, i, s = qid[order], ids[order], score[order]
    head = np.flatnonzero(np.concatenate(([True], (q[1:] != q[:-1]) | (i[1:] != i[:-1]))))
    best = s[head]
    by = np.lexsort((i[head], -best, q[head]))
    hq = q[head][by]
    first = np.flatnonzero(np.concatenate(([True], hq[1:] != hq[:-1])))
    rank = np.arange(len(hq)) - np.repeat(first, np.diff(np.append(first, len(hq))))
    if not slack:
        return order[head[by[rank < k]]]
    each = np.diff(np.append(first, len(hq)))
    last = np.where(each < k, -np.inf, best[by[first + np.minimum(each, k) - 1]])
    least = np.empty(len(head))
    least[by] = np.repeat(last, each)
    return order[s >= np.repeat(least, np.diff(np.append(head, len(s)))) - slack]


def _search(k: int, plan: Plan | None, seed: int):
    """The ``k`` best ids for each query of a group among the rows of the cells that it probes: those of a loss up to its ``bound``.

    Without a ``plan`` it probes all.
    """

    def run(key: tuple, q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"qid": np.empty(0, np.int64), "vec_id": np.empty(0, np.int64), "score": np.empty(0)})
        if not len(q) or not len(x):
            return none
        x = x.sort_values("cell", kind="stable")
        cell, xs, qs = x["cell"].to_numpy(), _matrix(x["v"]), _matrix(q["v"])
        xu, qu = unit(xs), unit(qs)
        ids, qid, bound = x["ids"].to_numpy(), q["qid"].to_numpy(), q["bound"].to_numpy()
        own = np.array([i[0] for i in ids])
        starts = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1]))).tolist()
        sides, out = sides_of(xs.shape[1]), []
        for at in range(0, len(qs), 1024):
            short = shortfalls(qu[at : at + 1024], int(key[0]) % plan.tables, plan.hashes, seed) if plan else []
            n, a, b, rough = len(qu[at : at + 1024]), [], [], []
            for lo, hi in zip(starts, [*starts[1:], len(cell)]):
                loss = np.zeros(n)
                for i, s in enumerate(short):
                    loss = loss + s[:, int(cell[lo]) // sides ** (len(short) - 1 - i) % sides]
                w = at + np.flatnonzero(loss <= bound[at : at + n] + 1e-9)
                if not len(w):
                    continue
                s = qu[w] @ xu[lo:hi].T
                # of one cell's rows no more than the k best can stay, if they are of different ids; ties and rounding are kept
                if s.shape[1] > 4 * k and len(np.unique(own[lo:hi])) == hi - lo:
                    i, j = np.nonzero(s >= np.partition(s, -2 * k, axis=1)[:, [-2 * k]] - 1e-9)
                else:
                    i, j = np.nonzero(np.ones(s.shape, bool))
                a.append(w[i])
                b.append(lo + j)
                rough.append(s[i, j])
            if a:
                out.append(_exact(qid, qs, xs, ids, np.concatenate(a), np.concatenate(b), np.concatenate(rough), k))
        return pd.concat(out) if out else none

    return run


def _exact(qid: np.ndarray, qs: np.ndarray, xs: np.ndarray, ids: np.ndarray, a: np.ndarray, b: np.ndarray, rough: np.ndarray, k: int) -> pd.DataFrame:
    """Rank the pairs ``(a, b)`` of queries and rows: by rough scores down to few, then exactly; a row stands for several ids, and an id may have several rows."""
    few = _top(a, np.array([i[0] for i in ids])[b], rough, k, 1e-9)
    a, b = a[few], b[few]
    s = cosines(qs[a], xs[b])
    held = [ids[i] for i in b.tolist()]
    n = [len(h) for h in held]
    a, s, vec = np.repeat(a, n), np.repeat(s, n), np.concatenate(held).astype(np.int64)
    best = _top(a, vec, s, k, 0)
    return pd.DataFrame({"qid": qid[a[best]], "vec_id": vec[best], "score": s[best]})


def nearest(vectors: DataFrame, queries: Column, k: int = 5, tables: int = 4, recall: float = 0.95, seed: int = 42, block: int = 4096, sample: int = 64, probes: int | None = None) -> DataFrame:
    """The ``k`` nearest found of every row that ``queries`` selects from ``vectors(vec_id, embedding)``, by largest cosine.

    Returns ``query_id, rank, vec_id, score``: rank from 1, nearest first, ties to the smaller vec_id; fewer rows if
    there are fewer candidates than ``k``. A row is no candidate of a query with its own vec_id.

    A table's cell is the nearest signed axis under each of its hashes; a query probes the cells of least loss. How
    many hashes, tables (``tables`` at most) and probes is fitted on ``sample`` queries: their true neighbours are
    found exactly, and the plan that compares least while it finds ``recall`` of them is taken; a given number of
    ``probes`` is used instead, with one hash a table. Every row is indexed.
    Equal vectors are one entry of the index with their ``k`` + 1 smallest ids, beyond which no query looks. Rows are
    dealt by runs of cells of about ``block`` rows; a query is sent once to each run that it probes in, with the greatest
    loss that it probes at, from which the task finds its cells. Runs of more rows are cut into
    blocks, each met by each block of queries in a task's group of its own. A query that finds fewer than ``k`` so is
    compared with all rows, in such blocks, as are vectors of another length than most, among themselves. Scores are
    exact cosines of the original vectors.

    Vectors that are null, zero, or hold null or non-finite components take no part, nor do null ids. A repeated id
    counts once, with its greatest score. No queries or an empty table: an empty result. Other columns are ignored.
    """
    spark = vectors.sparkSession
    ship(spark)
    v = F.col("embedding")
    fine = vectors.where(usable(v) & F.col("vec_id").isNotNull())
    fine = fine.select(F.col("vec_id").cast("long").alias("id"), v.alias("v"), F.coalesce(queries, F.lit(False)).alias("q"))
    # two hashes stand for a vector from here on
    fine = fine.select("*", F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(1), "v").alias("h2"), F.size("v").alias("d"))
    fine = fine.groupBy("h1", "h2", "id").agg(F.first("v").alias("v"), F.max("q").alias("q"), F.first("d").alias("d"))
    fine = materialise(fine, "vectors")
    same = Window.partitionBy("h1", "h2").orderBy("id")
    ids = fine.withColumn("at", F.row_number().over(same)).where(F.col("at") <= k + 1)
    index = ids.groupBy("h1", "h2").agg(F.first("v").alias("v"), F.first("d").alias("d"), F.collect_list("id").alias("ids"))
    index = materialise(index, "index")
    wanted = materialise(fine.where("q").select("id", "h1", "h2"), "wanted")
    asked = index.join(wanted.select("h1", "h2").distinct(), ["h1", "h2"], "left_semi").withColumn("qid", F.monotonically_increasing_id())
    asked = materialise(asked.select("qid", "h1", "h2", "v", "d"), "asked")
    lengths = index.groupBy("d").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if not lengths or asked.isEmpty():
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    width, rows = lengths.d, lengths.n
    main, ask = index.where(F.col("d") == width), asked.where(F.col("d") == width)
    plan = Plan(1, tables, probes, 0.0, 0.0) if probes else fit(ask, main, rows, width, k, tables, recall, seed, sample)

    # a dealing group is a run of cells that holds about a block of rows
    below = max(1, sides_of(width) ** plan.hashes * block // rows)

    @F.arrow_udf(T.ArrayType(T.LongType()))
    def lies(vs: pa.Array) -> pa.Array:
        x = unit(_matrix(vs))
        at = np.stack([cells(x, t, plan.hashes, seed) for t in range(plan.tables)], axis=1) if len(x) else np.empty((0, plan.tables), np.int64)
        return pa.array(list(at), pa.list_(pa.int64()))

    @F.arrow_udf("array<struct<g:bigint,bound:double>>")
    def looks(vs: pa.Array) -> pa.Array:
        out: list[list] = [[] for _ in range(len(vs))]
        x = unit(_matrix(vs)) if len(vs) else np.empty((0, 1))
        for t in range(plan.tables if len(vs) else 0):
            near, loss = probed(x, t, plan.hashes, seed, plan.probes)
            for i, g in enumerate(near // below):
                out[i] += [{"g": j * plan.tables + t, "bound": loss[i, -1]} for j in np.unique(g).tolist()]
        return pa.array(out, pa.list_(pa.struct([("g", pa.int64()), ("bound", pa.float64())])))

    at = F.posexplode(lies("v")).alias("t", "cell")
    dealt = main.select("v", "ids", "h1", at).withColumn("g", F.expr(f"(cell div {below}L) * {plan.tables}L + t")).drop("t")
    probing = ask.select("qid", "v", F.explode(looks("v")).alias("l")).select("qid", "v", "l.g", "l.bound")
    found = materialise(_best(probing, dealt, k + 1, block, plan, seed), "found")

    # those that found too few, and other lengths among themselves: one cell for each length
    full = found.groupBy("qid").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > k)
    rest = materialise(asked.join(full, "qid", "left_anti"), "rest")
    if not rest.isEmpty():
        every = index.select("v", "ids", "h1", F.col("d").cast("long").alias("g"), F.lit(0).cast("long").alias("cell"))
        again = rest.select("qid", "v", F.col("d").cast("long").alias("g"), F.lit(0.0).alias("bound"))
        exact = materialise(_best(again, every, k + 1, block, None, seed), "found")
        found = found.join(rest.select("qid"), "qid", "left_anti").unionByName(exact)
    named = found.join(asked.select("qid", "h1", "h2"), "qid").join(wanted, ["h1", "h2"]).where("id <> vec_id")
    named = named.groupBy(F.col("id").alias("query_id"), "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return named.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _best(asked: DataFrame, index: DataFrame, k: int, block: int, plan: Plan | None, seed: int) -> DataFrame:
    """``qid, vec_id, score``: the ``k`` best ids of each query ``(qid, v, g, bound)`` among rows ``(v, ids, h1, g, cell)`` of its groups; see ``_search``."""
    parts = lambda rows, name: rows.groupBy("g").agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("int").alias(name))
    split = materialise(parts(index, "ni").join(parts(asked, "nq"), "g"), "groups")

    def dealt(rows: DataFrame, own: str, other: str, key: str) -> DataFrame:
        mine = F.pmod(F.xxhash64(key), F.col(own)).cast("int")
        every = F.sequence(F.lit(0), F.col(other) - 1)
        pair = F.transform(every, lambda o: F.struct((mine if own == "ni" else o).alias("bi"), (o if own == "ni" else mine).alias("bq")))
        return rows.join(split, "g").withColumn("p", F.explode(pair)).select(*[c for c in rows.columns if c != "g"], "g", "p.bi", "p.bq")

    by = ["g", "bi", "bq"]
    left, right = dealt(asked, "nq", "ni", "qid"), dealt(index, "ni", "nq", "h1")
    found = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInPandas(_search(k, plan, seed), "qid long, vec_id long, score double")
    found = found.groupBy("qid", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("qid").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("at", F.row_number().over(order)).where(F.col("at") <= k).drop("at")


def fit(asked: DataFrame, index: DataFrame, rows: int, width: int, k: int, tables: int, recall: float, seed: int, sample: int) -> Plan:
    """Choose the plan on ``sample`` queries, their exact neighbours among all rows, and a sample of 2,000 rows; see ``choose``.

    The driver holds the sample queries, ``k`` neighbours of each, and the sample of rows.
    """
    some = asked.orderBy(F.xxhash64("h1", "h2"), "h1", "h2").limit(sample).select("h1", "h2", "v").toPandas()
    drawn = index.orderBy(F.xxhash64(F.lit(seed), "h1", "h2"), "h1", "h2").limit(2000).select("v").toPandas()
    qs = _matrix(some["v"])
    qu, own = unit(qs), some[["h1", "h2"]].to_numpy()

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            key = np.stack([b.column(i).to_numpy() for i in (0, 1)], axis=1)
            s = qu @ unit(_matrix(b.column(2))).T
            s[(own[:, None, :] == key[None, :, :]).all(axis=2)] = -np.inf
            n = min(k, s.shape[1])
            top = np.argpartition(-s, n - 1, axis=1)[:, :n]
            at = np.repeat(np.arange(len(qu)), n)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(s[at, top.ravel()]), b.column(2).take(pa.array(top.ravel()))], names=["at", "s", "v"])

    kind = index.schema["v"].dataType.simpleString()
    each = index.select("h1", "h2", "v").mapInArrow(near, f"at int, s double, v {kind}")
    order = Window.partitionBy("at").orderBy(F.desc("s"))
    true = each.withColumn("r", F.row_number().over(order)).where((F.col("r") <= k) & (F.col("s") > F.lit(float("-inf")))).toPandas()
    if not len(true):
        return Plan(1, 1, sides_of(width), 1.0, 1.0)
    hashes = 2 if rows <= ROWS_PER_CELL * (2 * width) ** 2 else 3
    return choose(qu, unit(_matrix(true["v"])), true["at"].to_numpy(), unit(_matrix(drawn["v"])), seed, recall, tables, hashes)
