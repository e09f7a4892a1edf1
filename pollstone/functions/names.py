"""Column naming rules."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame


def snake_case(name: str) -> str:
    """``"Response ID"`` -> ``response_id``, ``" IndicatorName "`` -> ``indicator_name``."""
    words = re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", name.strip())
    return "_".join(re.findall(r"[a-z0-9]+", words.lower()))


def plain_name(name: str) -> str:
    """Weaker rule for direct table loads: lower case, blanks and dashes to underscores."""
    return re.sub(r"[ -]", "_", name.lower().strip())


def rename_columns(df: DataFrame, rule: Callable[[str], str] = snake_case) -> DataFrame:
    """Rename every column in one projection; two columns may not end up with one name."""
    renamed = [rule(name) for name in df.columns]
    clashes = sorted({name for name in renamed if renamed.count(name) > 1})
    if clashes:
        raise ValueError(f"Column names collide after renaming: {clashes}")
    return df.toDF(*renamed)
