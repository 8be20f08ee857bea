"""Statistics: tests from sufficient statistics, correlation, regression, clustering, components, survival, enrichment.

The data side is one aggregate or window; what reaches the driver is a row of sums for each test.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import probability as P
from .windows import adjust_p, tied_rank


def _one(spark: SparkSession, **values) -> DataFrame:
    return spark.createDataFrame([tuple(float(v) for v in values.values())], ", ".join(f"{k} double" for k in values))


def t_test(df: DataFrame, value: str, group: str, equal_var: bool = False) -> DataFrame:
    """Two-sample t test (Welch unless equal_var); group is boolean. One row: difference, t, df, p."""
    s = {r[0]: r for r in df.where(F.col(value).isNotNull()).groupBy(group).agg(F.count(value), F.avg(value), F.var_samp(value)).collect()}
    (n1, m1, v1), (n2, m2, v2) = (tuple(s[g][1:]) for g in (True, False))
    if equal_var:
        dof = n1 + n2 - 2
        se = math.sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / dof * (1 / n1 + 1 / n2))
    else:
        a, b = v1 / n1, v2 / n2
        se, dof = math.sqrt(a + b), (a + b) ** 2 / (a * a / (n1 - 1) + b * b / (n2 - 1))
    t = (m1 - m2) / se
    return _one(df.sparkSession, difference=m1 - m2, t=t, df=dof, p=P.t_two_sided(t, dof))


def wilcoxon(df: DataFrame, value: str, group: str) -> DataFrame:
    """Rank-sum test, normal approximation with ties and continuity. One row: w, z, p."""
    r = tied_rank(df.where(F.col(value).isNotNull()).select(value, group), value)
    s = r.agg(F.sum(F.when(F.col(group), F.col("rank"))).alias("w"), F.count_if(F.col(group)).alias("n1"), F.count_if(~F.col(group)).alias("n2")).first()
    ties = df.where(F.col(value).isNotNull()).groupBy(value).count().agg(F.sum(F.expr("cast(count as double) * count * count - count"))).first()[0] or 0.0
    n1, n2 = s["n1"], s["n2"]
    n, u = n1 + n2, s["w"] - n1 * (n1 + 1) / 2
    d = u - n1 * n2 / 2
    sd = math.sqrt(n1 * n2 / 12 * (n + 1 - ties / (n * (n - 1))))
    z = (d - math.copysign(0.5, d)) / sd if d else 0.0
    return _one(df.sparkSession, w=u, z=z, p=min(1.0, P.normal_two_sided(z)))


def correlation(df: DataFrame, x: str, y: str, method: str = "pearson") -> DataFrame:
    """Pearson or Spearman correlation with its t test. One row: r, t, p."""
    d = df.select(x, y).where(F.col(x).isNotNull() & F.col(y).isNotNull())
    if method == "spearman":
        d = tied_rank(tied_rank(d, x, name="__x"), y, name="__y").select(F.col("__x").alias(x), F.col("__y").alias(y))
    r, n = d.agg(F.corr(x, y), F.count("*")).first()
    t = r * math.sqrt((n - 2) / max(1 - r * r, 1e-300))
    return _one(df.sparkSession, r=r, t=t, p=P.t_two_sided(t, n - 2))


def fisher(df: DataFrame, a: str, b: str) -> DataFrame:
    """Fisher's exact test of two boolean columns. One row: odds, p."""
    A, B = F.col(a), F.col(b)
    n = df.agg(F.count_if(A & B), F.count_if(A & ~B), F.count_if(~A & B), F.count_if(~A & ~B)).first()
    return _one(df.sparkSession, odds=n[0] * n[3] / (n[1] * n[2]) if n[1] * n[2] else math.inf, p=P.fisher_two_sided(*n))


def binomial(df: DataFrame, flag: str, p: float = 0.5) -> DataFrame:
    k, n = df.agg(F.count_if(F.col(flag)), F.count(flag)).first()
    return _one(df.sparkSession, share=k / n, p=P.binomial_two_sided(k, n, p))


def polynomial_test(df: DataFrame, x: str, y: str) -> DataFrame:
    """Null, linear and quadratic least squares by F tests. One row: p_linear (1 over 0), p_quadratic (2 over 1), p_both (2 over 0)."""
    m = df.agg(F.avg(x), F.stddev_samp(x)).first()
    z = (F.col(x) - m[0]) / (m[1] or 1.0)
    s = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).agg(F.count("*"), *(F.sum(F.pow(z, F.lit(float(k)))) for k in range(1, 5)), *(F.sum(F.pow(z, F.lit(float(k))) * F.col(y)) for k in range(3)), F.sum(F.col(y) * F.col(y))).first()
    n, moments, cross, yy = s[0], [s[0], *s[1:5]], s[5:8], s[8]
    rss = []
    for k in range(3):
        xtx = np.array([[moments[i + j] for j in range(k + 1)] for i in range(k + 1)], float)
        xty = np.array(cross[: k + 1], float)
        rss.append(yy - xty @ np.linalg.solve(xtx, xty))
    f = lambda small, big, d, dof: P.f_upper((small - big) / d / (big / dof), d, dof)
    return _one(df.sparkSession, p_linear=f(rss[0], rss[1], 1, n - 2), p_quadratic=f(rss[1], rss[2], 1, n - 3), p_both=f(rss[0], rss[2], 2, n - 3))


def kmeans(df: DataFrame, vector: str, k: int, seed: int = 1) -> tuple[DataFrame, float]:
    """Rows with their cluster, and the cost."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    d = df.withColumn("__v", array_to_vector(F.col(vector).cast("array<double>")))
    model = KMeans(k=k, seed=seed, featuresCol="__v", predictionCol="cluster").fit(d)
    return model.transform(d).drop("__v"), model.summary.trainingCost


def kmeans_costs(df: DataFrame, vector: str, ks: list[int], seed: int = 1) -> DataFrame:
    return df.sparkSession.createDataFrame([(k, float(kmeans(df, vector, k, seed)[1])) for k in ks], "k int, cost double")


def principal_components(df: DataFrame, vector: str, n: int) -> tuple[DataFrame, list[float]]:
    """Rows with their n component scores, and the share of variance of each component."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector, vector_to_array

    d = df.withColumn("__v", array_to_vector(F.col(vector).cast("array<double>")))
    model = PCA(k=n, inputCol="__v", outputCol="__p").fit(d)
    return model.transform(d).withColumn("scores", vector_to_array("__p")).drop("__v", "__p"), model.explainedVariance.toArray().tolist()


def scaling(distances: np.ndarray, n: int = 2) -> np.ndarray:
    """Classical multidimensional scaling of a small distance matrix."""
    j = np.eye(len(distances)) - 1 / len(distances)
    w, v = np.linalg.eigh(-j @ (distances**2) @ j / 2)
    top = np.argsort(-w)[:n]
    return v[:, top] * np.sqrt(np.maximum(w[top], 0))


def linkage(points: np.ndarray, method: str = "ward") -> np.ndarray:
    """Agglomerative clustering (ward, average, complete, single): rows (left, right, distance, size) as merges happen.

    Chains of nearest neighbours: time grows with the square of the points, not the cube. Ward distances come from the
    centroids, so that no matrix of all pairs is held; the other methods hold one.
    """
    n = len(points)
    sizes, alive, merged, chain = np.ones(n), np.ones(n, bool), [], []
    centre = np.array(points, float)
    pairs = None if method == "ward" else np.stack([np.sqrt(((centre - x) ** 2).sum(1)) for x in centre])
    while len(merged) < n - 1:
        if not chain:
            chain.append(int(alive.argmax()))
        i = chain[-1]
        if pairs is None:
            apart = centre - centre[i]
            d = np.sqrt(np.einsum("ij,ij->i", apart, apart) * (2 * sizes[i] * sizes / (sizes[i] + sizes)))
        else:
            d = pairs[i].copy()
        d[~alive] = d[i] = np.inf
        j = int(d.argmin())
        if len(chain) < 2 or d[j] < d[chain[-2]]:
            chain.append(j)
            continue
        a, b = sorted(chain[-2:])  # each is the other's nearest
        merged.append((d[chain[-2]], a, b))
        del chain[-2:]
        if pairs is None:
            centre[a] = (sizes[a] * centre[a] + sizes[b] * centre[b]) / (sizes[a] + sizes[b])
        else:
            new = {"average": (sizes[a] * pairs[a] + sizes[b] * pairs[b]) / (sizes[a] + sizes[b]), "complete": np.maximum(pairs[a], pairs[b]), "single": np.minimum(pairs[a], pairs[b])}[method]
            pairs[a], pairs[:, a] = new, new
        sizes[a] += sizes[b]
        alive[b] = False
    up, out = list(range(2 * n - 1)), []  # chains find merges out of order
    count = [1] * n

    def top(x: int) -> int:
        while up[x] != x:
            up[x] = x = up[up[x]]
        return x

    for k, (dij, a, b) in enumerate(sorted(merged)):
        a, b = sorted((top(a), top(b)))
        up[a] = up[b] = n + k
        count.append(count[a] + count[b])
        out.append((a, b, dij, count[-1]))
    return np.array(out, float).reshape(-1, 4)


def cut_tree(z: np.ndarray, distance: float) -> np.ndarray:
    """Cluster numbers (from 1, in order of first member) below a distance."""
    n = len(z) + 1
    parent = list(range(2 * n - 1))
    for i, (a, b, d, _) in enumerate(z):
        if d <= distance:
            parent[int(a)] = parent[int(b)] = n + i

    for i in range(2 * n - 2, -1, -1):  # a merge comes after what it merges
        parent[i] = parent[parent[i]]
    roots = parent[:n]
    order = {r: k for k, r in enumerate(dict.fromkeys(roots), 1)}
    return np.array([order[r] for r in roots])


def tree_order(z: np.ndarray) -> list[int]:
    """Leaves from left to right."""
    n = len(z) + 1
    walk, out = [2 * n - 2], []
    while walk:
        i = walk.pop()
        if i < n:
            out.append(i)
        else:
            walk += [int(z[i - n][1]), int(z[i - n][0])]
    return out


def hierarchical(df: DataFrame, row: str, vector: str, distance: float, keys: list[str] | None = None, method: str = "ward") -> DataFrame:
    """Clusters of each key's rows, keys in parallel; the time for a key grows with the square of its rows."""
    keys = keys or []
    kinds = dict(df.dtypes)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(row)
        z = linkage(np.stack(pdf[vector]).astype(float), method)
        return pdf[[*keys, row]].assign(cluster=cut_tree(z, distance))

    schema = ", ".join(f"`{c}` {kinds[c]}" for c in [*keys, row]) + ", cluster bigint"
    grouped = df.select(*keys, row, vector)
    return grouped.groupBy(*(keys or [F.lit(0).alias("__all")])).applyInPandas(run, schema)


def kaplan_meier(df: DataFrame, time: str, status: str, keys: list[str] | None = None) -> DataFrame:
    """Kaplan-Meier: keys, time, at_risk, events, survival at each event time. Counts first, then windows over times."""
    keys = keys or []
    part = keys or [F.lit(0)]
    c = df.where(F.col(time).isNotNull()).groupBy(*keys, time).agg(F.count("*").alias("n"), F.sum(F.col(status).cast("bigint")).alias("events"))
    later = Window.partitionBy(*part).orderBy(F.desc(time)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    c = c.withColumn("at_risk", F.sum("n").over(later)).where("events > 0")
    upto = Window.partitionBy(*part).orderBy(time).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    gone = F.max((F.col("events") == F.col("at_risk")).cast("int")).over(upto)
    step = F.sum(F.when(F.col("events") < F.col("at_risk"), F.log(1 - F.col("events") / F.col("at_risk"))).otherwise(0.0)).over(upto)
    return c.select(*keys, time, "at_risk", "events", F.when(gone == 1, 0.0).otherwise(F.exp(step)).alias("survival"))


def log_rank(df: DataFrame, time: str, status: str, group: str) -> DataFrame:
    """Log-rank test of two groups (boolean). One row: chi2, p."""
    c = df.groupBy(time).agg(F.count_if(F.col(group)).alias("a"), F.count_if(~F.col(group)).alias("b"), F.sum(F.when(F.col(group), F.col(status)).otherwise(0)).alias("da"), F.sum(status).alias("d"))
    later = Window.orderBy(F.desc(time)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    c = c.withColumns({"na": F.sum("a").over(later), "n": F.sum(F.col("a") + F.col("b")).over(later)}).where("d > 0")
    na, n, d = F.col("na"), F.col("n"), F.col("d")
    var = F.when(n > 1, d * (na / n) * (1 - na / n) * (n - d) / (n - 1)).otherwise(0.0)
    o, e, v = c.agg(F.sum("da"), F.sum(d * na / n), F.sum(var)).first()
    chi2 = (float(o) - float(e)) ** 2 / float(v) if v else 0.0
    return _one(df.sparkSession, chi2=chi2, p=P.chi2_upper(chi2, 1))


def cox(df: DataFrame, time: str, status: str, covariates: list[str], steps: int = 12) -> DataFrame:
    """Cox regression (Breslow ties) by Newton steps; each step is one aggregate by time and one over times."""
    beta = np.zeros(len(covariates))
    k = len(covariates)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    info = np.eye(k)
    for _ in range(steps):
        w = F.exp(sum((F.col(c) * float(b) for c, b in zip(covariates, beta, strict=True)), F.lit(0.0)))
        per = df.groupBy(time).agg(F.sum(w).alias("s0"), *(F.sum(w * F.col(c)).alias(f"s1_{i}") for i, c in enumerate(covariates)), *(F.sum(w * F.col(covariates[i]) * F.col(covariates[j])).alias(f"s2_{i}_{j}") for i, j in pairs), F.sum(status).alias("d"), *(F.sum(F.col(status) * F.col(c)).alias(f"x_{i}") for i, c in enumerate(covariates)))
        later = Window.orderBy(F.desc(time)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        per = per.withColumns({c: F.sum(c).over(later) for c in per.columns if c.startswith("s")}).where("d > 0")
        mean = [F.col(f"s1_{i}") / F.col("s0") for i in range(k)]
        r = per.agg(*(F.sum(F.col(f"x_{i}") - F.col("d") * mean[i]) for i in range(k)), *(F.sum(F.col("d") * (F.col(f"s2_{i}_{j}") / F.col("s0") - mean[i] * mean[j])) for i, j in pairs)).first()
        info = np.zeros((k, k))
        for (i, j), v in zip(pairs, r[k:], strict=True):
            info[i, j] = info[j, i] = v
        move = np.linalg.solve(info + 1e-12 * np.eye(k), np.array(r[:k], float))
        beta = beta + move
        if np.abs(move).max() < 1e-9:
            break
    se = np.sqrt(np.diag(np.linalg.inv(info + 1e-12 * np.eye(k))))
    rows = [(c, float(b), float(s), P.normal_two_sided(b / s)) for c, b, s in zip(covariates, beta, se, strict=True)]
    return df.sparkSession.createDataFrame(rows, "covariate string, coef double, se double, p double")


def enrichment(foreground: DataFrame, background: DataFrame, terms: DataFrame, gene: str, term: str) -> DataFrame:
    """Over-represented terms by Fisher's exact upper tail with BH: term, hits, size, p, adjusted. Counts by joins, tails on one row a term."""
    bg = background.select(gene).distinct()
    fg = foreground.select(gene).distinct().join(bg, gene, "left_semi")
    n, r = bg.count(), fg.count()
    pairs = terms.select(gene, term).distinct().join(bg, gene, "left_semi").join(fg.withColumn("__f", F.lit(1)), gene, "left")
    counts = pairs.groupBy(term).agg(F.count("__f").alias("hits"), F.count("*").alias("size"))

    @F.pandas_udf("double")
    def tail(a: pd.Series, s: pd.Series) -> pd.Series:
        return pd.Series([P.hypergeometric_upper(int(x), r, int(y), n) for x, y in zip(a, s, strict=True)])

    return adjust_p(counts.withColumn("p", tail("hits", "size")), "p")


def set_scores(values: DataFrame, sets: DataFrame, gene: str, sample: str, value: str, name: str) -> DataFrame:
    """Combined z-score of each gene set in each sample: the sum of z-scores over the root of the set's size."""
    stats = values.groupBy(gene).agg(F.avg(value).alias("__m"), F.stddev_samp(value).alias("__s"))
    z = values.join(stats, gene).where("__s > 0").withColumn("z", (F.col(value) - F.col("__m")) / F.col("__s"))
    return z.join(sets.select(gene, name).distinct(), gene).groupBy(name, sample).agg((F.sum("z") / F.sqrt(F.count("*"))).alias("score"))
