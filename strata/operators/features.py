"""Feature engineering (E-01 .. E-10, V-01 .. V-04).

Thin, parameterised factories over ``pyspark.ml.feature`` so that every
fitted step can live inside one ``Pipeline`` and be fitted on training rows
only (the reference fits indexers and scalers before splitting, D-06).
Row-wise Python conversions of the reference (``rdd.map(Vectors.dense)``)
become ``VectorAssembler`` / ``array_to_vector`` in the JVM.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import (HashingTF, OneHotEncoder, StandardScaler, StringIndexer,
                                Tokenizer, VectorAssembler)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the zero floor before the log target, as in the reference.
LOG_FLOOR = 0.0001


def nonzero_flag(c: Column) -> Column:
    """1 when the count is positive, else 0 (E-07)."""
    return F.when(c > 0, F.lit(1)).otherwise(F.lit(0))


def floored(c: Column, floor: float = LOG_FLOOR) -> Column:
    """Zero replaced by ``floor`` so its logarithm exists (E-06)."""
    return F.when(c == 0, F.lit(floor)).otherwise(c)


def log_target(c: Column, floor: float = LOG_FLOOR) -> Column:
    """Natural log of a count with zero floored (E-06)."""
    return F.log(floored(c, floor))


def indexer(cols: Sequence[str], suffix: str = "_idx", order: str = "frequencyDesc",
            invalid: str = "error") -> StringIndexer:
    """Category → index by descending frequency, ties alphabetical (E-01).

    A null or unseen category is an error by default; ``invalid="skip"``
    drops its row, ``"keep"`` adds one level (and one-hot slot) for it.
    """
    return StringIndexer(inputCols=list(cols), outputCols=[c + suffix for c in cols],
                         stringOrderType=order, handleInvalid=invalid)


def one_hot(cols: Sequence[str], suffix: str = "_vec", drop_last: bool = True) -> OneHotEncoder:
    """One-hot encode index columns: n - 1 slots for n levels, the last one dropped (E-02)."""
    return OneHotEncoder(inputCols=list(cols), outputCols=[c + suffix for c in cols],
                         dropLast=drop_last, handleInvalid="error")


def assembler(cols: Sequence[str], out: str = "features", invalid: str = "error") -> VectorAssembler:
    """Numbers and vectors → one vector column (E-03, V-01 .. V-03); nulls are an error."""
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid=invalid)


def scaler(in_col: str, out_col: str, with_mean: bool = True, with_std: bool = True) -> StandardScaler:
    """Standardise (E-04) or centre only (E-05, ``with_std=False``)."""
    return StandardScaler(inputCol=in_col, outputCol=out_col, withMean=with_mean, withStd=with_std)


def text_features(text_col: str = "text", words_col: str = "words", out: str = "features",
                  num_features: int = 1 << 18) -> list:
    """Lower-case whitespace tokens → hashed term frequencies (E-08, E-09)."""
    return [Tokenizer(inputCol=text_col, outputCol=words_col),
            HashingTF(inputCol=words_col, outputCol=out, numFeatures=num_features)]


def tabular_stages(categories: Sequence[str], numerics: Sequence[str],
                   out: str = "features", standardise: bool = True) -> list:
    """Indexer → one-hot → numeric assembler → scaler → final assembler (J-13)."""
    stages: list = []
    idx = [c + "_idx" for c in categories]
    if categories:
        stages += [indexer(categories), one_hot(idx)]
    num_vec = "__numeric"
    stages.append(assembler(numerics, num_vec))
    parts = [num_vec]
    if standardise:
        stages.append(scaler(num_vec, "__numeric_std"))
        parts = ["__numeric_std"]
    parts += [c + "_vec" for c in idx]
    stages.append(assembler(parts, out))
    return stages


def fit_transform(df: DataFrame, stages: list) -> DataFrame:
    return Pipeline(stages=stages).fit(df).transform(df)


def vector_columns(df: DataFrame, vec_col: str, names: Sequence[str]) -> DataFrame:
    """Spread a vector column into named double columns."""
    arr = vector_to_array(F.col(vec_col))
    return df.withColumns({n: arr[i] for i, n in enumerate(names)}).drop(vec_col)


def array_vector(df: DataFrame, arr_col: str, out: str = "features") -> DataFrame:
    """``array<float|double>`` → ML dense vector (V-03, V-04)."""
    return df.withColumn(out, array_to_vector(F.col(arr_col).cast("array<double>")))
