"""One-factor models per pillar: seeded sub-samples, moments, maximum-likelihood loadings."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equitrace.functions.grouping import PANEL_KEY, seeded_sample, with_group_stats
from equitrace.schemas import FACTOR_FIT
from equitrace.spec import RefreshSpec

ALL_CATEGORIES = "ALL CATEGORY"


def clean_before_fit(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop metrics without any value, by exact name; fill the others with their mean."""
    stats = with_group_stats(
        rows, [*keys, "var"], F.avg("value").alias("mean"), F.count("value").alias("non_null")
    )
    return (
        stats.where(F.col("non_null") > 0)
        .withColumn("value", F.coalesce("value", "mean"))
        .select(*rows.columns)
    )


def sample_moments(rows: DataFrame, keys: Sequence[str], spec: RefreshSpec) -> DataFrame:
    """Sums of products of the centred metrics per key, seed and metric pair.

    A missing value stands at its mean, so it adds nothing to a centred sum and needs no row.
    Each seed leaves out 5 % of the panel rows; the sums of a sample are the total sums less
    those of the rows left out, so a panel row is read 1.4 times for 8 seeds, not 8 times.
    """
    scope = [k for k in keys if k == "category"]
    sample = seeded_sample(rows, PANEL_KEY, spec.sample_pct, spec.sample_seeds, scope)
    sizes = (
        rows.select(*PANEL_KEY)
        .distinct()
        .groupBy(*scope)
        .agg(F.floor(F.count("*") * F.lit(spec.sample_pct) / F.lit(100)).alias("n_rows"))
    )
    left_out = (
        sample.where(~F.col("taken")).groupBy(*PANEL_KEY).agg(F.collect_list("seed").alias("seeds"))
    )
    centred = with_group_stats(rows, [*keys, "var"], F.avg("value").alias("mean")).where(
        F.col("value").isNotNull()
    )
    cell = [*keys, *[c for c in PANEL_KEY if c not in keys]]
    cells = centred.groupBy(*cell).agg(
        F.array_sort(
            F.collect_list(F.struct("var", (F.col("value") - F.col("mean")).alias("x")))
        ).alias("m")
    )
    pairs = F.expr(
        "flatten(transform(m, (a, i) -> array_append(transform(slice(m, i + 1, size(m)), b -> "
        "struct(a.var as var1, b.var as var2, a.x * b.x as s)), "
        "struct(a.var as var1, '' as var2, a.x as s))))"
    )
    seeds = F.concat(F.array(F.lit(0)), F.coalesce("seeds", F.array().cast("array<int>")))
    sums = (
        cells.join(left_out, list(PANEL_KEY), "left")
        .withColumn("seed", F.explode(seeds))
        .select(*keys, "seed", F.explode(pairs).alias("p"))
        .select(*keys, "seed", "p.*")
        .groupBy(*keys, "seed", "var1", "var2")
        .agg(F.sum("s").alias("s"))
    )
    totals = sums.where(F.col("seed") == 0).select(
        *keys,
        F.explode(F.array(*[F.lit(s) for s in spec.sample_seeds])).alias("seed"),
        "var1",
        "var2",
        F.col("s").alias("total"),
    )
    sized = totals.join(sizes, scope) if scope else totals.withColumn("n_rows", sizes.scalar())
    return (
        sized.join(sums.where(F.col("seed") > 0), [*keys, "seed", "var1", "var2"], "left")
        .select(
            *keys,
            "seed",
            "var1",
            "var2",
            (F.col("total") - F.coalesce("s", F.lit(0.0))).alias("s"),
            "n_rows",
        )
    )


LEAST_UNIQUE = 1e-6
#: gradient below which a factor fit counts as converged
CONVERGED = 1e-5


def _profile(r: np.ndarray, x: np.ndarray):
    """Misfit at the log unique variances x, its gradient and curvature, and the best loadings."""
    root = np.exp(x / 2.0)
    values, vectors = np.linalg.eigh(r / np.outer(root, root))
    rest, top = values[:-1], vectors[:, -1]
    misfit = float(np.sum(rest - np.log(rest) - 1.0))
    gradient = (vectors[:, :-1] ** 2) @ (1.0 - rest)
    curvature = (np.eye(len(x)) - np.outer(top, top)) ** 2
    return misfit, gradient, curvature, root * top * np.sqrt(max(values[-1] - 1.0, 0.0))


def one_factor(
    r: np.ndarray, steps: int = 200, tol: float = 1e-10
) -> tuple[np.ndarray, np.ndarray, bool]:
    """Loadings, unique variances of a correlation matrix, latent variance 1; and whether it converged.

    Maximum likelihood over the unique variances alone, for which the best loadings are known
    from the largest eigenvalue (Joreskog 1967); Newton steps on their logs, halved until the
    misfit falls, with a lower bound.
    """
    low = np.log(LEAST_UNIQUE)
    x = np.clip(np.log((1.0 - 0.5 / len(r)) / np.diag(np.linalg.inv(r))), low, None)
    misfit, gradient, curvature, load = _profile(r, x)
    for _ in range(steps):
        free = ~((x <= low) & (gradient > 0.0))
        if not free.any() or np.abs(gradient[free]).max() < tol:
            break
        bent = curvature[np.ix_(free, free)] + 1e-8 * np.eye(int(free.sum()))
        move = np.zeros(len(x))
        move[free] = np.clip(-np.linalg.solve(bent, gradient[free]), -2.0, 2.0)
        size = 1.0
        while size > 1e-8:
            ahead = np.clip(x + size * move, low, None)
            found = _profile(r, ahead)
            if found[0] < misfit:
                break
            size /= 2.0
        else:
            break
        x, (misfit, gradient, curvature, load) = ahead, found
    free = ~((x <= low) & (gradient > 0.0))
    converged = not free.any() or float(np.abs(gradient[free]).max()) < CONVERGED
    return (load if load.sum() >= 0 else -load), np.exp(x), converged


def fit_indices(r: np.ndarray, load: np.ndarray, unique: np.ndarray, n: int) -> tuple[float, float, float]:
    """CFI, TLI and RMSEA of the one-factor model against independence."""
    p = len(load)
    sigma = np.outer(load, load) + np.diag(unique)
    log_r = np.linalg.slogdet(r)[1]
    f = np.linalg.slogdet(sigma)[1] + np.trace(r @ np.linalg.inv(sigma)) - log_r - p
    chi2, df = n * max(f, 0.0), p * (p + 1) // 2 - 2 * p
    chi2_0, df_0 = -n * log_r, p * (p - 1) // 2
    if df == 0:
        return 1.0, 1.0, 0.0
    over, over_0 = max(chi2 - df, 0.0), max(chi2 - df, chi2_0 - df_0, 0.0)
    cfi = 1.0 - over / over_0 if over_0 > 0 else 1.0
    base = chi2_0 / df_0
    tli = (base - chi2 / df) / (base - 1.0) if base != 1.0 else 1.0
    return cfi, tli, float(np.sqrt(over / (df * n)))


def fit_moments(pdf: pd.DataFrame) -> pd.DataFrame:
    """Fit one key and seed from its pair sums; the input has one row per metric pair."""
    n = int(pdf["n_rows"].iloc[0])
    names = sorted(pdf["var1"].unique())
    pos = {v: i for i, v in enumerate(names)}
    p = len(names)
    sums, cross = np.zeros(p), np.zeros((p, p))
    for a, b, s in zip(pdf["var1"], pdf["var2"], pdf["s"], strict=True):
        if b == "":
            sums[pos[a]] = s
        else:
            cross[pos[a], pos[b]] = cross[pos[b], pos[a]] = s
    cov = cross / n - np.outer(sums / n, sums / n)
    sd = np.sqrt(np.clip(np.diag(cov), 0.0, None))
    load, fits, status = np.full(p, np.nan), (np.nan,) * 3, "not identified"
    if p >= 3 and n > p and sd.min() > 1e-9:
        r = cov / np.outer(sd, sd)
        if np.linalg.eigvalsh(r)[0] > 1e-8:
            load, unique, converged = one_factor(r)
            fits = fit_indices(r, load, unique, n)
            status = "improper" if unique.min() <= 10 * LEAST_UNIQUE else "ok"
            status = status if converged else "not converged"
    return pd.DataFrame(
        {"var": names, "est_std": load, "cfi": fits[0], "tli": fits[1], "rmsea": fits[2],
         "n_rows": n, "status": status}
    )


def _fit_group(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    pillar, seed = str(pdf["pillar"].iloc[0]), int(pdf["seed"].iloc[0])
    out = fit_moments(pdf)
    out.insert(0, "category", str(pdf["category"].iloc[0]))
    out.insert(1, "pillar", f"{pillar}_pillar")
    out.insert(2, "seed", seed)
    out.insert(3, "op", "=~")
    return out.astype(object).where(out.notna(), None)


def factor_fits(moments: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fit every key and seed; a fit that is not identified gives a status, not an error."""
    if "category" not in keys:
        moments = moments.withColumn("category", F.lit(ALL_CATEGORIES))
    return moments.groupBy("category", "pillar", "seed").applyInPandas(_fit_group, FACTOR_FIT)


def pooled_factors(rows: DataFrame, spec: RefreshSpec) -> DataFrame:
    """One factor per pooled pillar and seed, over all categories."""
    chosen = rows.where(F.col("pillar").isin(*spec.pooled_pillars))
    return factor_fits(sample_moments(chosen, ["pillar"], spec), ["pillar"])


def category_factors(rows: DataFrame, spec: RefreshSpec) -> DataFrame:
    """One factor per category, category pillar and seed."""
    keys = ["category", "pillar"]
    chosen = rows.where(F.col("pillar").isin(*spec.category_pillars))
    return factor_fits(sample_moments(chosen, keys, spec), keys)
