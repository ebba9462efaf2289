"""Unicode normal forms, which Spark lacks, as Arrow-batched functions. Null stays null."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def _normal(form: str, c: Column) -> Column:
    @F.pandas_udf("string")
    def normal(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else unicodedata.normalize(form, t))

    return normal(c)


def nfd(c: Column) -> Column:
    return _normal("NFD", c)


def nfkc(c: Column) -> Column:
    return _normal("NFKC", c)
