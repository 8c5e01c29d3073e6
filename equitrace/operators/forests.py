"""Tree-ensemble driver models of every key: grid search, refit, exact attribution.

One row holds a key's series (its size is set by the calendar and the dictionary). Spark deals out units of
work: a forest's trees in blocks, a boosted ensemble as one chain a setting. All trees of a unit grow
together, level by level. A forest is grown once at the largest depth for each number of features: shallower
ones are its trees cut at a level and smaller ones its first trees, so their scores come from the same sums.
A boosted chain likewise gives the scores of all its round numbers. Sums over blocks, fold errors, the choice
and the reports are Spark aggregates.

Bootstrap counts and feature draws depend on the key, the fold and the tree alone, so a retry gives the same.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equitrace.functions.exprs import ratio
from equitrace.operators import stats
from equitrace.operators.drivers import fit_report, selection_table
from equitrace.operators.trees import Trees, attributions, codes, gains, grow
from equitrace.sources.workspace import stage
from equitrace.spec import BOOSTED, FOREST, ModelSpec, TreeGrid

SEED = 42
#: trees of a block, chains that grow together, units that a task gets
BLOCK_TREES, CHAINS, TASK_UNITS = 50, 128, 128
MOST_TASKS = 20_000
#: added to a leaf's weight in boosted trees
SHRINK = 1.0

SERIES_FIELDS = "vars array<string>, dates array<date>, dv array<double>, split array<string>, fold array<int>, x array<array<double>>"


def grid_settings(grid: TreeGrid) -> list[dict[str, float]]:
    """Every combination of a grid, in its order."""
    named = {
        "max_depth": grid.max_depth,
        "n_trees": grid.n_trees,
        "max_features": grid.max_features,
        "learning_rate": grid.learning_rate,
    }
    used = {k: v for k, v in named.items() if v}
    return [dict(zip(used, combo, strict=True)) for combo in itertools.product(*used.values())]


def series_rows(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: its features, dates and samples; a missing value stands at the feature's mean."""
    key_list = list(keys)

    def gather(pdf: pd.DataFrame) -> pd.DataFrame:
        x = pdf.pivot(index="date", columns="var", values="value").sort_index().sort_index(axis=1).dropna(axis=1, how="all")
        at = pdf.drop_duplicates("date").set_index("date").loc[x.index]
        x = x.fillna(x.mean())
        line = {
            **{k: pdf[k].iloc[0] for k in key_list},
            "vars": list(x.columns), "dates": list(x.index), "dv": at["dv"].tolist(), "split": at["split"].tolist(),
            "fold": at["fold"].fillna(0).astype(int).tolist(), "x": x.to_numpy(float).tolist(),
        }
        return pd.DataFrame([line])

    schema = ", ".join(f"{k} string" for k in keys) + ", " + SERIES_FIELDS
    known = rows.where(F.col("dv").isNotNull()).select(*keys, "date", "var", "value", "dv", "split", "fold")
    return known.groupBy(*keys).applyInPandas(gather, schema).where(F.size("vars") > 0)


class Series:
    """A key's samples as arrays."""

    def __init__(self, row: dict, keys: Sequence[str]):
        self.key = [row[k] for k in keys]
        self.dates, self.x, self.y = row["dates"], np.array(row["x"], dtype=float), np.array(row["dv"], dtype=float)
        self.fold, self.train = np.array(row["fold"]), np.array([s == "train" for s in row["split"]])

    def used(self, fold: int) -> np.ndarray:
        """Training rows outside the fold; fold 0 leaves none out."""
        return self.train & (self.fold != fold) if fold else self.train

    def shown(self, fold: int) -> np.ndarray:
        """Rows to score: the fold left out, or all."""
        return self.train & (self.fold == fold) if fold else np.ones(len(self.y), dtype=bool)


def forest_block(series: Series, fold: int, trees: range, depth: int, max_features: int) -> tuple[Trees, float]:
    """The trees of a block, on centred values, and the centre."""
    use, (n, p) = series.used(fold), series.x.shape
    draw = np.random.default_rng([SEED, zlib.crc32("~".join(map(str, series.key)).encode()), fold, trees.start])
    weight = np.zeros((len(trees), n))
    weight[:, use] = draw.multinomial(use.sum(), np.full(use.sum(), 1 / use.sum()), size=len(trees))
    lots = [draw.random((len(trees), 1 << d, p)) for d in range(depth)]  # the same for any number of features

    def allowed(level: int) -> np.ndarray:
        return lots[level].argsort(axis=2).argsort(axis=2) < max_features

    centre = series.y[use].mean()
    x = series.x[None]
    target = np.broadcast_to(series.y - centre, weight.shape)
    return grow(x, codes(x), weight, target, depth, 0.0, allowed), centre


def _padded(batch: list[Series]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """x, y and which rows are real, for series of different sizes."""
    n, p = max(len(s.y) for s in batch), max(s.x.shape[1] for s in batch)
    x, y, real = np.zeros((len(batch), n, p)), np.zeros((len(batch), n)), np.zeros((len(batch), n), dtype=bool)
    for k, s in enumerate(batch):
        x[k, : len(s.y), : s.x.shape[1]], y[k, : len(s.y)], real[k, : len(s.y)] = s.x, s.y, True
    return x, y, real


def boosted_chains(
    batch: list[Series], folds: list[int], depth: int, rates: np.ndarray, rounds: int, each: Callable[[int, Trees], None]
) -> tuple[np.ndarray, Iterator[tuple[int, np.ndarray]]]:
    """Base values, and (round, predictions) after every round of chains that grow in step."""
    x, y, _ = _padded(batch)
    weight = np.zeros(y.shape)
    for k, (s, f) in enumerate(zip(batch, folds, strict=True)):
        weight[k, : len(s.y)] = s.used(f)
    base = (weight * y).sum(axis=1) / np.maximum(weight.sum(axis=1), 1)
    coded = codes(x)

    def run() -> Iterator[tuple[int, np.ndarray]]:
        predicted = np.repeat(base[:, None], y.shape[1], axis=1)
        for no in range(1, rounds + 1):
            trees = grow(x, coded, weight, y - predicted, depth, SHRINK)
            each(no, trees)
            predicted = predicted + rates[:, None] * trees.predict(depth)
            yield no, predicted

    return base, run()


def _spread(units: DataFrame, n: int, by: Sequence[str]) -> DataFrame:
    """Few bytes and much work: the number of tasks follows the units, not the size."""
    return units.repartition(max(1, min(MOST_TASKS, n // TASK_UNITS + 1)), *by)


def _map_units(units: DataFrame, schema: str, names: list[str], handle: Callable[[list[dict]], Iterator[tuple]]) -> DataFrame:
    """Rows that a function yields for slices of units."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, CHAINS):
                out = list(handle(batch.slice(start, CHAINS).to_pylist()))
                if out:
                    columns = [pa.array(list(c), t) for c, t in zip(zip(*out, strict=True), arrow.types, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    return units.mapInArrow(run, schema)


def tree_blocks(n_trees: Sequence[int]) -> list[tuple[int, int]]:
    """(first, end) of blocks of few trees that end at every number of trees of the grid."""
    ends = sorted({*n_trees, *range(BLOCK_TREES, max(n_trees), BLOCK_TREES)})
    return list(zip([0, *ends[:-1]], ends, strict=True))


def forest_fold_scores(series: DataFrame, keys: Sequence[str], grid: TreeGrid, folds: int) -> DataFrame:
    """keys, grid_no, fold, dv, predicted of the rows of every fold left out, for every setting."""
    key_list, depths, blocks = list(keys), sorted(set(grid.max_depth)), tree_blocks(grid.n_trees)
    block = F.array(*[F.struct(F.lit(a).alias("first"), F.lit(b).alias("end")) for a, b in blocks])
    most = F.size("vars").alias("most")
    given = F.array(*[F.least(F.lit(m), F.size("vars")) for m in grid.max_features or (10**6,)])
    units = series.select("*", most, F.explode(F.sequence(F.lit(1), F.lit(folds))).alias("left"), F.array_distinct(given).alias("given"))
    units = units.select("*", F.explode("given").alias("used")).select("*", F.inline(block))
    n = series.count() * folds * max(1, len(grid.max_features)) * len(blocks)

    def handle(rows: list[dict]) -> Iterator[tuple]:
        for row in rows:
            s = Series(row, key_list)
            shown = np.flatnonzero(s.shown(row["left"]))
            if len(shown) == 0 or not s.used(row["left"]).any():
                continue
            trees, centre = forest_block(s, row["left"], range(row["first"], row["end"]), depths[-1], row["used"])
            sums = np.stack([(trees.predict(d) + centre).sum(axis=0)[shown] for d in depths], axis=1)
            for k, at in enumerate(shown):
                yield (*s.key, row["left"], row["most"], row["used"], row["end"], s.dates[at], s.y[at], sums[k].tolist())

    names = [*key_list, "fold", "most", "used", "end", "date", "dv", "sums"]
    schema = ", ".join(f"{k} string" for k in keys) + ", fold int, most int, used int, end int, date date, dv double, sums array<double>"
    parts = _map_units(_spread(units, n, [*key_list, "left", "used", "first"]), schema, names, handle)
    # the first n trees of every n of the grid, in one aggregate by partial sums
    sizes = F.array(*[F.lit(t) for t in sorted(set(grid.n_trees))])
    sums = parts.select("*", F.explode(F.filter(sizes, lambda t: t >= F.col("end"))).alias("n_trees"))
    per_depth = [F.sum(F.get("sums", F.lit(k))).alias(f"sum{k}") for k in range(len(depths))]
    sums = sums.groupBy(*keys, "fold", "most", "used", "n_trees", "date", "dv").agg(*per_depth)
    options = []
    for no, s in enumerate(grid_settings(grid)):
        predicted = F.col(f"sum{depths.index(s['max_depth'])}") / s["n_trees"]
        mine = (F.col("n_trees") == s["n_trees"]) & (F.col("used") == F.least(F.lit(s.get("max_features", 10**6)), F.col("most")))
        options.append(F.when(mine, F.struct(F.lit(no).alias("grid_no"), predicted.alias("predicted"))))
    scored = sums.select(*keys, "fold", "dv", F.explode(F.filter(F.array(*options), lambda v: v.isNotNull())).alias("s"))
    return scored.select(*keys, "s.grid_no", "fold", "dv", "s.predicted")


def boosted_fold_scores(series: DataFrame, keys: Sequence[str], grid: TreeGrid, folds: int) -> DataFrame:
    """keys, grid_no, fold, dv, predicted of the rows of every fold left out, for every setting."""
    key_list, settings = list(keys), grid_settings(grid)
    chains = sorted({(s["max_depth"], s["learning_rate"]) for s in settings})
    numbers = {(s["max_depth"], s["learning_rate"], s["n_trees"]): no for no, s in enumerate(settings)}
    stops, chain = sorted(set(grid.n_trees)), F.array(*[F.struct(F.lit(d).alias("depth"), F.lit(r).alias("rate")) for d, r in chains])
    units = series.select("*", F.explode(F.sequence(F.lit(1), F.lit(folds))).alias("left"))
    units = units.select("*", F.inline(chain))

    def handle(rows: list[dict]) -> Iterator[tuple]:
        for depth in sorted({r["depth"] for r in rows}):
            some = [(Series(r, key_list), r["left"], r["rate"]) for r in rows if r["depth"] == depth]
            some = [u for u in some if u[0].used(u[1]).any()]
            if not some:
                continue
            batch, left, rates = ([u[k] for u in some] for k in range(3))
            _, steps = boosted_chains(batch, left, depth, np.array(rates), stops[-1], lambda no, t: None)
            for no, predicted in steps:
                if no in stops:
                    for k, (s, f, rate) in enumerate(some):
                        grid_no = numbers[depth, rate, no]
                        for at in np.flatnonzero(s.shown(f)):
                            yield (*s.key, grid_no, f, s.y[at], predicted[k, at])

    schema = ", ".join(f"{k} string" for k in keys) + ", grid_no int, fold int, dv double, predicted double"
    n = series.count() * folds * len(chains)
    return _map_units(_spread(units, n, [*key_list, "left", "rate"]), schema, [*key_list, "grid_no", "fold", "dv", "predicted"], handle)


FIT_FIELDS = "date date, predicted double, effects array<double>, gains array<double>"


def forest_fits(chosen: DataFrame, keys: Sequence[str], grid: TreeGrid) -> DataFrame:
    """keys, date, predicted, effects and gains of the chosen forests, each a sum over a block's trees."""
    key_list = list(keys)
    block = F.array(*[F.struct(F.lit(a).alias("first"), F.lit(b).alias("end")) for a, b in tree_blocks(grid.n_trees)])
    units = chosen.select("*", F.inline(F.filter(block, lambda b: b["end"] <= F.col("n_trees"))))

    def handle(rows: list[dict]) -> Iterator[tuple]:
        for row in rows:
            s, n, depth = Series(row, key_list), row["n_trees"], row["max_depth"]
            p = s.x.shape[1]
            trees, centre = forest_block(s, 0, range(row["first"], row["end"]), max(grid.max_depth), min(row.get("max_features") or p, p))
            predicted = (trees.predict(depth) + centre).sum(axis=0) / n
            effects = attributions(s.x[None], trees, depth).sum(axis=0) / n
            gained = gains(trees, p, depth)
            gained = (gained / np.maximum(gained.sum(axis=1, keepdims=True), 1e-300)).sum(axis=0) / n
            for k, date in enumerate(s.dates):
                yield (*s.key, date, predicted[k], effects[:, k].tolist(), gained.tolist() if k == 0 else None)

    schema = ", ".join(f"{k} string" for k in keys) + ", " + FIT_FIELDS
    n = chosen.count() * len(tree_blocks(grid.n_trees))
    return _map_units(_spread(units, n, [*key_list, "first"]), schema, [*key_list, "date", "predicted", "effects", "gains"], handle)


def boosted_fits(chosen: DataFrame, keys: Sequence[str], grid: TreeGrid) -> DataFrame:
    """keys, date, predicted, effects and gains (mean gain of a split) of the chosen chains."""
    key_list = list(keys)

    def handle(rows: list[dict]) -> Iterator[tuple]:
        settings = sorted({(r["max_depth"], r["n_trees"]) for r in rows})
        for depth, rounds in settings:
            some = [r for r in rows if (r["max_depth"], r["n_trees"]) == (depth, rounds)]
            batch, rates = [Series(r, key_list) for r in some], np.array([r["learning_rate"] for r in some])
            x, y, _ = _padded(batch)
            p = x.shape[2]
            effects, gained, splits = np.zeros((len(batch), p, y.shape[1])), np.zeros((len(batch), p)), np.zeros((len(batch), p))

            def each(no: int, trees: Trees, effects=effects, gained=gained, splits=splits, x=x, rates=rates, depth=depth, p=p) -> None:
                effects += rates[:, None, None] * attributions(x, trees, depth)
                gained += gains(trees, p, depth)
                for f in trees.feature:
                    splits += (f[:, :, None] == np.arange(p)).sum(axis=1)

            _, steps = boosted_chains(batch, [0] * len(batch), depth, rates, rounds, each)
            for _, predicted in steps:
                pass
            gained /= np.maximum(splits, 1)
            for k, s in enumerate(batch):
                q = s.x.shape[1]
                for i, date in enumerate(s.dates):
                    yield (*s.key, date, predicted[k, i], effects[k, :q, i].tolist(), gained[k, :q].tolist() if i == 0 else None)

    schema = ", ".join(f"{k} string" for k in keys) + ", " + FIT_FIELDS
    return _map_units(_spread(chosen, 8 * chosen.count(), key_list), schema, [*key_list, "date", "predicted", "effects", "gains"], handle)


def tree_model(samples: DataFrame, kind: str, model: ModelSpec, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Grid search, refit and report of one kind of ensemble for every key: results and predictions.

    samples: keys, date, var, value, dv, split, fold. The importance of a feature is its share of the gains;
    its attribution is the mean absolute Shapley value over the training rows.
    """
    if kind not in (FOREST, BOOSTED):
        raise ValueError(f"unknown model {kind!r}")
    grid = model.forest if kind == FOREST else model.boosted
    fold_scores, fits = (forest_fold_scores, forest_fits) if kind == FOREST else (boosted_fold_scores, boosted_fits)
    key_list = list(keys)
    series = stage(series_rows(samples, keys), f"{kind}-series")
    scored = stage(fold_scores(series, keys, grid, model.folds), f"{kind}-folds")
    metrics = stats.regression_metrics(scored, [*keys, "grid_no", "fold"])
    best = selection_table(metrics, keys, ["grid_no"]).where(F.col("rank") == 1)
    settings = grid_settings(grid)
    listed = F.array(*[
        F.struct(*[F.lit(v).alias(k) for k, v in s.items()], F.lit(", ".join(f"{k}={v}" for k, v in s.items())).alias("best_params"))
        for s in settings
    ])
    best = stage(best.withColumn("s", F.get(listed, F.col("grid_no"))).select(*keys, "r2_fold", "mape_fold", "s.*"), f"{kind}-best")
    chosen = series.join(best.drop("r2_fold", "mape_fold", "best_params"), key_list)
    parts = stage(fits(chosen, keys, grid), f"{kind}-fits")

    rows = series.select(*keys, F.inline(F.arrays_zip("dates", "dv", "split"))).withColumnRenamed("dates", "date")
    predicted = parts.groupBy(*keys, "date").agg(F.sum("predicted").alias("predicted"))
    predictions = rows.join(predicted, [*key_list, "date"])
    effects = parts.select(*keys, "date", F.posexplode("effects").alias("at", "effect"))
    effects = effects.groupBy(*keys, "date", "at").agg(F.sum("effect").alias("effect"))
    train = rows.where(F.col("split") == "train").select(*keys, "date")
    effects = effects.join(train, [*key_list, "date"], "left_semi").groupBy(*keys, "at").agg(F.avg(F.abs("effect")).alias("attribution"))
    gained = parts.select(*keys, F.posexplode("gains").alias("at", "gain")).groupBy(*keys, "at").agg(F.sum("gain").alias("gain"))
    total = gained.groupBy(*keys).agg(F.sum("gain").alias("total"))
    names = series.select(*keys, F.posexplode("vars").alias("at", "var"))
    results = (
        names.join(effects, [*key_list, "at"], "left")
        .join(gained, [*key_list, "at"], "left")
        .join(total, key_list, "left")
        .select(*keys, "var", ratio("gain", "total").alias("importance"), "attribution")
        .join(fit_report(predictions, keys), key_list, "left")
        .join(best.select(*keys, "r2_fold", "mape_fold", "best_params"), key_list, "left")
        .join(stats.latest_dv(samples, keys), key_list, "left")
        .withColumn("model", F.lit(kind))
    )
    return results, predictions
