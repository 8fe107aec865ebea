"""Feature encoding (E3-E7, E10, E11, P9) as column expressions and as
persistable Spark ML stages.

The population-std scaler and the string mode imputer do not exist in
Spark ML (``StandardScaler`` divides by the sample std; ``Imputer`` is
numeric-only), so they are small Estimators whose fitted statistics are
stored as params; ``Pipeline`` saves and loads them with the built-in
stages.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .impute import fit_modes
from .ordering import global_row_number


# ---------------------------------------------------------------- E3 E4
def fit_population_scaler(train: DataFrame, cols: Sequence[str]) -> dict[str, tuple]:
    """E3 fit: mean and population std (ddof 0) per column, one pass."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}")]
    row = train.agg(*aggs).first()
    return {c: (row[f"m_{c}"], row[f"s_{c}"]) for c in cols}


def scale_expr(c: str, mean: float | None, std: float | None) -> Column:
    """(x - mean) / std; a zero std maps present values to 0; NULL stays."""
    x = F.col(c)
    if mean is None:
        return x.cast("double")
    if not std:
        return F.when(x.isNotNull(), F.lit(0.0))
    return (x - F.lit(mean)) / F.lit(std)


def standardize(df: DataFrame, stats: Mapping[str, tuple], suffix: str = "") -> DataFrame:
    return df.select(*[scale_expr(c, *stats[c]).alias(c + suffix) if c in stats
                       else F.col(c) for c in df.columns])


def inverse_standardize(df: DataFrame, stats: Mapping[str, tuple]) -> DataFrame:
    """X * std + mean."""
    out = []
    for c in df.columns:
        if c in stats and stats[c][0] is not None:
            m, s = stats[c]
            out.append((F.col(c) * F.lit(s or 0.0) + F.lit(m)).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


# ---------------------------------------------------------------- E5 E6 E7
def levels(train: DataFrame, col: str) -> list[str]:
    """Sorted distinct non-null levels of a categorical column (the level
    list sizes the output columns, so it is needed on the driver)."""
    return [r[0] for r in train.where(F.col(col).isNotNull()).select(col).distinct()
            .orderBy(col).collect()]


def one_hot(df: DataFrame, col: str, lvls: Sequence[str], drop_first: bool = False,
            keep_source: bool = False) -> DataFrame:
    """One 0/1 column per level named ``<col>_<level>``.  Unknown and
    NULL values give all zeros.  ``drop_first`` drops the first level."""
    use = list(lvls)[1:] if drop_first else list(lvls)
    dummies = [F.coalesce((F.col(col) == F.lit(v)).cast("int"), F.lit(0)).alias(f"{col}_{v}")
               for v in use]
    base = df.columns if keep_source else [c for c in df.columns if c != col]
    return df.select(*base, *dummies)


def level_table(train: DataFrame, col: str) -> DataFrame:
    """E7 fit: (level, code) with codes 0..L-1 in sorted level order."""
    d = train.where(F.col(col).isNotNull()).select(F.col(col).alias("level")).distinct()
    r = global_row_number(d, ["level"], "__rn")       # distributed, no one-task window
    return r.select("level", (F.col("__rn") - 1).cast("int").alias("code"))


def ordinal_encode(df: DataFrame, col: str, table: DataFrame, out: str) -> DataFrame:
    """Level -> code; unknown -> -1; NULL stays NULL.  The level table
    (one row per category) carries no hint: Spark broadcasts it by its size in bytes, and
    beyond that adaptive execution splits a dominant level."""
    j = df.join(table, df[col] == table["level"], "left")
    code = F.when(F.col(col).isNull(), F.lit(None).cast("int")).otherwise(
        F.coalesce(F.col("code"), F.lit(-1)))
    return j.select(*df.columns, code.alias(out))


def ordinal_decode(df: DataFrame, code_col: str, table: DataFrame, out: str) -> DataFrame:
    """E7 inverse: code -> level (unknown/NULL -> NULL)."""
    t = table.select(F.col("level").alias(out), F.col("code").alias("__code"))
    j = df.join(t, df[code_col] == t["__code"], "left")
    return j.select(*df.columns, out)


# ---------------------------------------------------------------- ML stages
class _StatsParams(HasInputCols, HasOutputCols):
    stats = Param(Params._dummy(), "stats", "fitted statistics as JSON",
                  typeConverter=TypeConverters.toString)


class PopulationScalerModel(Model, _StatsParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fitted E3 stage: (x - mean) / population std, zero std -> 0."""

    @keyword_only
    def __init__(self, inputCols=None, outputCols=None, stats=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        st = json.loads(self.getOrDefault(self.stats))
        outs = self.getOutputCols()
        return df.withColumns({o: scale_expr(i, *st[i])
                               for i, o in zip(self.getInputCols(), outs)})


class PopulationScaler(Estimator, _StatsParams, DefaultParamsReadable, DefaultParamsWritable):
    """E3 estimator (``StandardScaler`` uses the sample std instead)."""

    @keyword_only
    def __init__(self, inputCols=None, outputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> PopulationScalerModel:
        st = fit_population_scaler(df, self.getInputCols())
        return PopulationScalerModel(inputCols=self.getInputCols(),
                                     outputCols=self.getOutputCols(), stats=json.dumps(st))


class StringModeImputerModel(Model, _StatsParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fitted E2 stage: NULL strings -> the training mode."""

    @keyword_only
    def __init__(self, inputCols=None, outputCols=None, stats=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        st = json.loads(self.getOrDefault(self.stats))
        return df.withColumns({o: F.coalesce(F.col(i), F.lit(st[i]))
                               for i, o in zip(self.getInputCols(), self.getOutputCols())})


class StringModeImputer(Estimator, _StatsParams, DefaultParamsReadable, DefaultParamsWritable):
    """E2 estimator: most frequent training value, ties -> smallest."""

    @keyword_only
    def __init__(self, inputCols=None, outputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> StringModeImputerModel:
        st = fit_modes(df, self.getInputCols())
        return StringModeImputerModel(inputCols=self.getInputCols(),
                                      outputCols=self.getOutputCols(), stats=json.dumps(st))


def feature_encoder(num_cols: Sequence[str], cat_cols: Sequence[str],
                     passthrough: Sequence[str] = (), features: str = "features"):
    """Numbers -> mean impute -> population scale; strings -> mode
    impute -> sorted-level one-hot (unknown/NULL -> zero vector, all levels
    kept); then numbers, one-hots, passthrough assembled in that order.
    Raises when either column list is empty, as the reference did."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import Imputer, OneHotEncoder, StringIndexer, VectorAssembler
    num_cols, cat_cols = list(num_cols), list(cat_cols)
    if not num_cols or not cat_cols:
        raise ValueError("feature_encoder needs numeric and categorical columns")
    imp = [f"__imp_{c}" for c in num_cols]
    sc = [f"__sc_{c}" for c in num_cols]
    cimp = [f"__cimp_{c}" for c in cat_cols]
    idx = [f"__idx_{c}" for c in cat_cols]
    oh = [f"{c}_onehot" for c in cat_cols]
    stages = [
        Imputer(strategy="mean", inputCols=num_cols, outputCols=imp),
        PopulationScaler(inputCols=imp, outputCols=sc),
        StringModeImputer(inputCols=cat_cols, outputCols=cimp),
        StringIndexer(inputCols=cimp, outputCols=idx, stringOrderType="alphabetAsc",
                      handleInvalid="keep"),
        OneHotEncoder(inputCols=idx, outputCols=oh, dropLast=True, handleInvalid="error"),
        VectorAssembler(inputCols=sc + oh + list(passthrough), outputCol=features,
                        handleInvalid="keep"),
    ]
    return Pipeline(stages=stages)


def encoded_columns(encoder) -> tuple[list[str], list[tuple[str, int]]]:
    """Of a fitted ``feature_encoder``: its scaled numbers, and (level number, levels) of each categorical column."""
    indexer = encoder.stages[3]
    return encoder.stages[1].getOutputCols(), [(c, len(v)) for c, v in zip(indexer.getOutputCols(), indexer.labelsArray)]


def one_hot_all(train: DataFrame, df: DataFrame, col: str) -> DataFrame:
    """E5 with Spark ML: ``StringIndexer`` (sorted, keep) + ``OneHotEncoder``
    (dropLast) fitted on train; the vector is returned as named columns."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder, StringIndexer
    from pyspark.ml.functions import vector_to_array
    p = Pipeline(stages=[
        StringIndexer(inputCol=col, outputCol="__idx", stringOrderType="alphabetAsc",
                      handleInvalid="keep"),
        OneHotEncoder(inputCol="__idx", outputCol="__oh", dropLast=True,
                      handleInvalid="error")]).fit(train)
    lvls = p.stages[0].labels
    out = p.transform(df).withColumn("__a", vector_to_array("__oh"))
    return out.select(*[c for c in df.columns if c != col],
                      *[F.col("__a")[i].alias(f"{col}_{v}") for i, v in enumerate(lvls)])
