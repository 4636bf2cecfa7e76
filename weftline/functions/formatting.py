"""Numbers as text the way Python writes them; the JVM rounds other ties."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def python_format(spec: str):
    """A Column function that formats doubles with a Python format such as ".4f" or ".8g"; null and NaN give ""."""

    @F.pandas_udf("string")
    def text(values: pd.Series) -> pd.Series:
        return values.map(lambda x: "" if x is None or x != x else format(x, spec))

    def apply(c: Column | str) -> Column:
        return text((F.col(c) if isinstance(c, str) else c).cast("double"))

    return apply
