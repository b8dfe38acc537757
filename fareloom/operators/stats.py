"""Correlations, tests and regression by aggregation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareloom import schema as S
from fareloom.functions.exprs import ratio
from fareloom.functions.tails import chi2_tail, student_tail
from fareloom.operators.profile import n_rows


def safe_corr(x: Column, y: Column) -> Column:
    """Correlation over rows where both are present; null when either does not vary.

    Spark's own ``corr`` divides by zero there. ``regr_r2`` is null for a constant ``x``
    and 1, at zero covariance, for a constant ``y``.
    """
    r2, cov = F.regr_r2(y, x), F.covar_pop(x, y)
    return F.when(~((cov == 0) & (r2 == 1)), F.signum(cov) * F.sqrt(r2))


def corr_matrix(t: DataFrame, cols: Sequence[str] = tuple(S.CORRELATION_COLUMNS)) -> DataFrame:
    """(left, right, correlation) for every pair of columns, each with itself included.

    One pass: the columns as rows on the left, an aggregate per column on the right, so the plan
    grows with the number of columns, not of pairs.
    """
    keep = [F.col(c).cast("double").alias(f"_y{j}") for j, c in enumerate(cols)]
    wide = t.select(*keep, *[F.col(c).cast("double").alias(c) for c in cols])
    long = wide.unpivot([f"_y{j}" for j in range(len(cols))], list(cols), "left", "x")
    per_left = long.groupBy("left").agg(*[safe_corr(F.col("x"), F.col(f"_y{j}")).alias(f"c{j}") for j in range(len(cols))])
    cells = [
        F.struct("left", F.lit(c).alias("right"), F.when(F.col("left") == c, F.signum(f"c{j}")).otherwise(F.col(f"c{j}")).alias("correlation"))
        for j, c in enumerate(cols)
    ]
    return per_left.select(F.inline(F.array(*cells)))


def target_correlations(
    t: DataFrame,
    cols: Sequence[str],
    targets: Sequence[str] = ("total_amount", "fare_amount", "tip_amount"),
    top: int | None = None,
    bottom: int | None = None,
) -> DataFrame:
    """(target, feature, correlation), each feature against each target.

    With ``top`` and ``bottom``, only the strongest positive and negative ones per target.
    """
    keep = [F.col(y).cast("double").alias(f"_y{j}") for j, y in enumerate(targets)]
    wide = t.select(*keep, *[F.col(c).cast("double").alias(c) for c in cols])
    long = wide.unpivot([f"_y{j}" for j in range(len(targets))], list(cols), "feature", "x")
    per_feature = long.groupBy("feature").agg(
        *[safe_corr(F.col("x"), F.col(f"_y{j}")).alias(f"c{j}") for j in range(len(targets))]
    )
    cells = [
        F.struct(F.lit(y).alias("target"), F.col("feature"), F.col(f"c{j}").alias("correlation"))
        for j, y in enumerate(targets)
    ]
    out = per_feature.select(F.inline(F.array(*cells))).where(F.col("target") != F.col("feature"))
    if top is None and bottom is None:
        return out
    high = Window.partitionBy("target").orderBy(F.desc_nulls_last("correlation"), "feature")
    low = Window.partitionBy("target").orderBy(F.asc_nulls_last("correlation"), "feature")
    return (
        out.withColumn("_hi", F.row_number().over(high))
        .withColumn("_lo", F.row_number().over(low))
        .where(
            ((F.col("_hi") <= (top or 0)) & (F.col("correlation") > 0))
            | ((F.col("_lo") <= (bottom or 0)) & (F.col("correlation") < 0))
        )
        .drop("_hi", "_lo")
    )


# -- independence of two codes --------------------------------------------------------


def chi2(t: DataFrame, a: Column, b: Column) -> DataFrame:
    """Pearson statistic and degrees of freedom of two coded columns, from one scan for their counts."""
    counts = t.groupBy(a.alias("a"), b.alias("b")).agg(n_rows().alias("n")).where("a is not null and b is not null")
    sums = counts.withColumn("row_n", F.sum("n").over(Window.partitionBy("a"))).withColumn("col_n", F.sum("n").over(Window.partitionBy("b")))
    # sum over cells of (o - e)^2 / e  =  total * sum(o^2 / (row * col)) - total
    share = F.sum(F.col("n") * F.col("n") / (F.col("row_n") * F.col("col_n").cast("double")))
    return (
        sums.agg(
            share.alias("share"),
            F.sum("n").alias("total"),
            F.count_distinct("a").alias("r"),
            F.count_distinct("b").alias("c"),
        )
        .select(
            (F.col("total") * F.col("share") - F.col("total")).alias("statistic"),
            ((F.col("r") - 1) * (F.col("c") - 1)).alias("dof"),
        )
    )


def chi2_test(t: DataFrame, a: Column, b: Column) -> DataFrame:
    """Statistic, degrees of freedom, p-value, and whether that is below 0.05."""
    found = chi2(t, a, b).withColumn("p_value", chi2_tail(F.col("statistic"), F.col("dof")))
    return found.withColumn("significant", F.col("p_value") < 0.05)


# -- difference of two means ----------------------------------------------------------


def welch_t(
    t: DataFrame, group: Column, cols: Sequence[str] = tuple(S.COMPARED_COLUMNS)
) -> DataFrame:
    """Unequal-variance t statistic and its degrees of freedom, group true against false."""
    inside = F.coalesce(group, F.lit(False))
    aggs = []
    for i, c in enumerate(cols):
        for side, cond in (("a", inside), ("b", ~inside)):
            x = F.when(cond, F.col(c).cast("double"))
            aggs += [
                F.count(x).alias(f"n{side}{i}"),
                F.avg(x).alias(f"m{side}{i}"),
                F.var_samp(x).alias(f"v{side}{i}"),
            ]
    rows = []
    for i, c in enumerate(cols):
        na, nb = F.col(f"na{i}"), F.col(f"nb{i}")
        ea, eb = ratio(F.col(f"va{i}"), na), ratio(F.col(f"vb{i}"), nb)
        rows.append(
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"ma{i}").alias("mean_in"),
                F.col(f"mb{i}").alias("mean_out"),
                ratio(F.col(f"ma{i}") - F.col(f"mb{i}"), F.sqrt(ea + eb)).alias("t"),
                ratio((ea + eb) * (ea + eb), ratio(ea * ea, na - 1) + ratio(eb * eb, nb - 1)).alias("dof"),
            )
        )
    return t.agg(*aggs).select(F.inline(F.array(*rows)))


def welch_test(t: DataFrame, group: Column, cols: Sequence[str] = tuple(S.COMPARED_COLUMNS)) -> DataFrame:
    """``welch_t`` with two-sided p-values."""
    found = welch_t(t, group, cols).withColumn("p_value", student_tail(F.col("t"), F.col("dof")))
    return found.withColumn("significant", F.col("p_value") < 0.05)


# -- one-feature regression -----------------------------------------------------------


@dataclass(frozen=True)
class Line:
    """A least-squares line: the baseline every trained model has to beat."""

    feature: str
    target: str
    slope: float
    intercept: float

    def expr(self) -> Column:
        return F.lit(self.intercept) + F.lit(self.slope) * F.col(self.feature)


def fit_line(train: DataFrame, feature: str = "fare_amount", target: str = S.TARGET) -> Line:
    row = train.agg(
        F.regr_slope(target, feature).alias("s"), F.regr_intercept(target, feature).alias("i")
    ).first()
    return Line(feature, target, row["s"] or 0.0, row["i"] or 0.0)


def apply_line(t: DataFrame, line: Line, name: str = S.PREDICTED) -> DataFrame:
    return t.withColumn(name, line.expr())


def fit_fold_lines(
    t: DataFrame, fold: str, k: int, feature: str = "fare_amount", target: str = S.TARGET
) -> list[Line]:
    """One line per fold, fitted on the rows outside it.

    One pass collects means and centred moments of each fold, ``k`` rows in all; those of
    the other folds are then pooled.
    """
    x, y = F.col(feature).cast("double"), F.col(target).cast("double")
    found = (
        t.where(x.isNotNull() & y.isNotNull())
        .groupBy(fold)
        .agg(
            n_rows().alias("n"),
            F.avg(x).alias("mx"),
            F.avg(y).alias("my"),
            F.var_pop(x).alias("vx"),
            F.covar_pop(x, y).alias("cxy"),
        )
        .collect()
    )
    return [_pooled([r for r in found if r[fold] != f], feature, target) for f in range(k)]


def _pooled(parts: Sequence, feature: str, target: str) -> Line:
    n = sum(r["n"] for r in parts)
    if not n:
        return Line(feature, target, 0.0, 0.0)
    mx = sum(r["n"] * r["mx"] for r in parts) / n
    my = sum(r["n"] * r["my"] for r in parts) / n
    sxx = sum(r["n"] * (r["vx"] + (r["mx"] - mx) ** 2) for r in parts)
    sxy = sum(r["n"] * (r["cxy"] + (r["mx"] - mx) * (r["my"] - my)) for r in parts)
    slope = sxy / sxx if sxx else 0.0
    return Line(feature, target, slope, my - slope * mx)


def apply_fold_lines(t: DataFrame, lines: Sequence[Line], fold: str, name: str = S.PREDICTED) -> DataFrame:
    """Predict each row with the line that has not seen its fold."""
    out = F.lit(None).cast("double")
    for f, line in enumerate(lines):
        out = F.when(F.col(fold) == f, line.expr()).otherwise(out)
    return t.withColumn(name, out)


def regression_metrics(
    t: DataFrame, label: str = S.TARGET, prediction: str = S.PREDICTED, by: Sequence[str] = ()
) -> DataFrame:
    """n, MSE, RMSE, MAE and R² in one aggregation, over rows that have both values."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    scored = t.where(y.isNotNull() & p.isNotNull())
    miss = y - p
    mse = F.avg(miss * miss)
    aggs = [
        n_rows().alias("n"),
        mse.alias("mse"),
        F.sqrt(mse).alias("rmse"),
        F.avg(F.abs(miss)).alias("mae"),
        (1 - ratio(mse, F.var_pop(y))).alias("r2"),
    ]
    return scored.groupBy(*by).agg(*aggs) if by else scored.agg(*aggs)


def cv_summary(fold_metrics: DataFrame, metrics: Sequence[str] = ("mse", "r2")) -> DataFrame:
    """Mean and population deviation of each metric over the folds."""
    return fold_metrics.agg(
        n_rows().alias("folds"),
        *[f(m).alias(f"{p}_{m}") for m in metrics for p, f in (("avg", F.avg), ("std", F.stddev_pop))],
    )


def residuals(t: DataFrame, label: str = S.TARGET, prediction: str = S.PREDICTED) -> DataFrame:
    return t.withColumn("residual", F.col(label) - F.col(prediction))
