"""Feature columns: selection, scaling, label encoding and perturbation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from conceptlink.functions.hashing import order_key, uniform
from conceptlink.operators.sampling import class_sizes


def choose_columns(
    df: DataFrame, cols_x: Sequence[str] = (), cols_y: Sequence[str] = (), untracked: Sequence[str] = ()
) -> tuple[list[str], list[str]]:
    """Feature and label columns: the named ones and the rest; with neither, all are features."""
    names = [c for c in df.columns if c not in set(untracked)]
    if cols_x:
        return list(cols_x), [c for c in names if c not in set(cols_x)]
    if cols_y:
        return [c for c in names if c not in set(cols_y)], list(cols_y)
    return names, []


def to_features(
    df: DataFrame,
    cols_x: Sequence[str] = (),
    cols_y: Sequence[str] = (),
    untracked: Sequence[str] = (),
    key: Sequence[str] = (),
    scaler: str | None = None,
) -> DataFrame:
    """``(key..., features vector, label columns...)``; key columns stay out of the features."""
    xs, ys = choose_columns(df, cols_x, cols_y, [*untracked, *key])
    if scaler:
        df = fit_scaler(df, xs, scaler).transform(df)
    return VectorAssembler(inputCols=xs, outputCol="features").transform(df).select(*key, "features", *ys)


def from_features(df: DataFrame, cols_x: Sequence[str], features: str = "features") -> DataFrame:
    """Named columns back from a feature vector."""
    values = vector_to_array(features)
    rest = [c for c in df.columns if c != features]
    return df.select(*rest, *[values[i].alias(c) for i, c in enumerate(cols_x)])


@dataclass(frozen=True)
class Scaler:
    """Fitted scaling of columns; ``shift`` and ``scale`` hold one number per column."""

    columns: tuple[str, ...]
    method: str
    shift: tuple[float, ...] = ()
    scale: tuple[float, ...] = ()
    norm: str = "l2"

    def transform(self, df: DataFrame) -> DataFrame:
        if self.method == "norm":
            size = F.lit(0.0)
            for c in self.columns:
                x = F.col(c).cast("double")
                size = F.greatest(size, F.abs(x)) if self.norm == "max" else size + (F.abs(x) if self.norm == "l1" else x * x)
            size = F.sqrt(size) if self.norm == "l2" else size
            return df.withColumns({c: F.when(size > 0, F.col(c) / size).otherwise(0.0) for c in self.columns})
        return df.withColumns(
            {c: (F.col(c) - m) / s for c, m, s in zip(self.columns, self.shift, self.scale)}
        )


def fit_scaler(df: DataFrame, columns: Sequence[str], method: str, norm: str = "l2") -> Scaler:
    """Population z-score ('standard'/'z'), 'minmax' or row 'norm'; constant columns divide by one."""
    if method.startswith("norm"):
        return Scaler(tuple(columns), "norm", norm=norm)
    if method.startswith(("stand", "z")):
        low, width = F.avg, F.stddev_pop
    elif method.startswith("minmax"):
        low, width = F.min, lambda c: F.max(c) - F.min(c)
    else:
        raise ValueError(f"unknown scaling: {method}")
    row = df.agg(*[low(c).cast("double") for c in columns], *[width(c).cast("double") for c in columns]).first()
    k = len(columns)
    return Scaler(tuple(columns), method, tuple(row[:k]), tuple(s or 1.0 for s in row[k:]))


def scale(df: DataFrame, columns: Sequence[str], scaler: str | Scaler | None = None, norm: str = "l2") -> DataFrame:
    """Scale columns by a named method or a fitted scaler; None leaves them."""
    if scaler is None:
        return df
    fitted = scaler if isinstance(scaler, Scaler) else fit_scaler(df, columns, scaler, norm)
    return fitted.transform(df)


def one_vs_all(df: DataFrame, label: str, positive, out: str = "target", pos: int = 1, neg: int = 0) -> DataFrame:
    return df.withColumn(out, F.when(F.col(label) == F.lit(positive), pos).otherwise(neg))


def encode_labels(df: DataFrame, label: str, positive, out: str = "target") -> tuple[DataFrame, DataFrame]:
    """One-vs-all labels and their class sizes."""
    encoded = one_vs_all(df, label, positive, out)
    return encoded, class_sizes(encoded, out)


def perturb(
    df: DataFrame, columns: Sequence[str], id_cols: Sequence[str], lower_bound: float = 0.0, alpha: float = 100.0, seed: int = 7
) -> DataFrame:
    """Add noise between m/10a and m/a, m being the smallest value above the bound."""
    above = [F.min(F.when(F.col(c) > lower_bound, F.col(c))).cast("double").alias(c) for c in columns]
    smallest = min(v for v in df.agg(*above).first() if v is not None)
    low, high = smallest / (alpha * 10), smallest / alpha
    noise = {c: uniform(order_key(seed, *id_cols, F.lit(c))) * (high - low) + low for c in columns}
    return df.withColumns({c: F.col(c) + noise[c] for c in columns})
