"""Linear projection of fantasy points, with Spark ML or from mergeable cross products."""

from dataclasses import dataclass
from fractions import Fraction
from itertools import combinations_with_replacement

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from gridledger import fixed_values as fv
from gridledger.functions.numeric import to_number
from gridledger.operators.clean import where
from gridledger.operators.names import best_match
from gridledger.operators.quality import missing_columns

GAMES = 17


def _features(stats, divisor=1.0):
    return stats.withColumns(
        {f"_x_{c}": to_number(F.col(c).cast("string")) / divisor for c in fv.PROJECTION_FEATURES}
    )


def _training_rows(stats):
    missing = missing_columns(stats, fv.PROJECTION_FEATURES)
    if missing:
        raise ValueError(f"missing columns for training: {missing}")
    return _features(stats).withColumn("label", F.coalesce(F.col("fantasy_points"), F.lit(0.0)))


def train_projection(stats):
    """Ordinary least squares over all player-seasons, missing values as 0."""
    rows = _training_rows(stats)
    assembler = VectorAssembler(
        inputCols=[f"_x_{c}" for c in fv.PROJECTION_FEATURES], outputCol="features"
    )
    regression = LinearRegression(solver="normal", regParam=0.0)
    return Pipeline(stages=[assembler, regression]).fit(
        rows.select("label", *[f"_x_{c}" for c in fv.PROJECTION_FEATURES])
    )


#: The constant, the features and the label; their products are summed in this order.
_TERMS = ["_one", *[f"_x_{c}" for c in fv.PROJECTION_FEATURES], "label"]
_PAIRS = list(combinations_with_replacement(range(len(_TERMS)), 2))


def cross_products(stats, by=("season",)):
    """Per group of player-seasons, the sums of all products of features and label.

    They are exact (six decimals a value, twelve a product) and add up over groups, so a
    season that changed replaces its own row and no other player-season is read again.
    """
    rows = _training_rows(stats).withColumn("_one", F.lit(1))
    exact = [F.col(c).cast("decimal(18,6)") for c in _TERMS]
    sums = [F.sum(exact[i] * exact[j]) for i, j in _PAIRS]
    return rows.groupBy(*by).agg(F.array(*sums).alias("products"))


@dataclass(frozen=True)
class Projection:
    """Weights of a fitted projection; used like the model of ``train_projection``."""

    intercept: float
    weights: tuple

    def transform(self, rows):
        terms = zip(self.weights, fv.PROJECTION_FEATURES, strict=True)
        value = sum((F.lit(w) * F.col(f"_x_{c}") for w, c in terms), F.lit(self.intercept))
        return rows.withColumn("prediction", value)


def fit_products(products):
    """The least-squares fit to all player-seasons behind the summed products.

    One row of a few dozen numbers comes to the driver. A feature that earlier ones (or
    the constant) determine carries nothing and gets weight 0, as do all without rows.
    """
    sums = [F.sum(F.col("products")[k]).alias(f"p{k}") for k in range(len(_PAIRS))]
    row = products.agg(*sums).first()
    value = {pair: Fraction(row[k] or 0) for k, pair in enumerate(_PAIRS)}
    size = len(_TERMS) - 1
    # Normal equations with the label's column last, solved in fractions.
    lines = [[value[min(i, j), max(i, j)] for j in range(size + 1)] for i in range(size)]
    for k in range(size):
        if lines[k][k] == 0:
            continue
        lines[k] = [v / lines[k][k] for v in lines[k]]
        for i in range(size):
            if i != k:
                lines[i] = [v - lines[i][k] * u for v, u in zip(lines[i], lines[k], strict=True)]
    intercept, *weights = (float(lines[k][size]) if lines[k][k] else 0.0 for k in range(size))
    return Projection(intercept, tuple(weights))


def project_next_game(model, stats, games=GAMES):
    """Points per player from season totals over the number of games."""
    scored = model.transform(_features(stats, float(games)))
    return scored.withColumn("projected_fantasy_points", F.round("prediction", 2)).select(
        *stats.columns, "projected_fantasy_points"
    )


def project_by_name(lookups, players, stats, model, season):
    """Projection for each looked-up name (q), with a note where stats lack."""
    found = best_match(lookups, players, stats, season).drop("fantasy_points", "season")
    projected = project_next_game(model, where(stats, season=season)).select(
        "gsis_id", "projected_fantasy_points"
    )
    note = (
        F.when(F.col("gsis_id").isNull(), fv.PROJECTION_UNKNOWN)
        .when(
            F.col("projected_fantasy_points").isNull(),
            fv.PROJECTION_NO_STATS.format(season=season),
        )
        .otherwise(fv.PROJECTION_NOTE.format(season=season))
    )
    return found.join(projected, "gsis_id", "left").withColumn("note", note)
