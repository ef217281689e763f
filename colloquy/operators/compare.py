"""Comparison of two labelling runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Cell texts that a default table reader takes for missing.
MISSING = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def with_missing(df: DataFrame) -> DataFrame:
    """Text cells that mean missing become null."""
    return df.withColumns({f.name: F.when(~F.col(f.name).isin(*MISSING), F.col(f.name)) for f in df.schema.fields if f.dataType.simpleString() == "string"})


def pair_up(a: DataFrame, b: DataFrame, key: str, columns: list[str], names: tuple[str, str]) -> DataFrame:
    """Rows of both runs by key, columns suffixed by the run's name; repeated keys multiply."""
    if names[0] == names[1]:
        raise ValueError("the two runs need different names")
    left, right = (df.select(key, *[F.col(c).alias(f"{c}_{n}") for c in columns]) for df, n in zip((a, b), names))
    return left.join(right, key)


def agreement(pairs: DataFrame, columns: list[str], names: tuple[str, str]) -> DataFrame:
    """One row: number of pairs and, for each column, agreeing pairs and their share in percent; missing never agrees."""
    same = {c: F.coalesce(F.col(f"{c}_{names[0]}") == F.col(f"{c}_{names[1]}"), F.lit(False)) for c in columns}
    counts = [F.count("*").alias("n")]
    for c in columns:
        counts += [F.count_if(same[c]).alias(f"{c}_agree"), F.round(F.try_divide(100.0 * F.count_if(same[c]), F.count("*")), 1).alias(f"{c}_percent")]
    return pairs.agg(*counts)


def disagreements(pairs: DataFrame, columns: list[str], names: tuple[str, str]) -> DataFrame:
    """Pairs that differ in any column; two missing values differ."""
    apart = F.lit(False)
    for c in columns:
        apart = apart | ~F.coalesce(F.col(f"{c}_{names[0]}") == F.col(f"{c}_{names[1]}"), F.lit(False))
    return pairs.filter(apart)


def distribution(df: DataFrame, column: str) -> DataFrame:
    """label and count, missing left out."""
    return df.filter(F.col(column).isNotNull()).groupBy(F.col(column).cast("string").alias("label")).agg(F.count("*").alias("label_count"))
