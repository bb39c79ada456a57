"""Un-nesting and the entity-attribute-value pivot.

All narrow operations (``explode``/``inline`` are generators inside the
scan's stage) except the pivot, which is one hash aggregate: conditional
``max``/``avg`` per attribute, partially aggregated before the shuffle.
``groupBy().pivot()`` is not used: it plans two shuffles for the same result.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.coerce import RULES, first

AGGS = {"max": F.max, "avg": F.avg, "min": F.min, "sum": F.sum}


def fixture_param() -> Column:
    """``parameters.fixture`` as a long key (the reference left it a string)."""
    return F.col("parameters.fixture").try_cast("long")


def explode_response(env: DataFrame, *keep: Column | str, alias: str = "r") -> DataFrame:
    """One row per ``response`` element; empty or NULL arrays drop the document."""
    return env.select(*keep, F.explode("response").alias(alias))


def path(c: Column, dotted: str) -> Column:
    """Nested struct field by dotted path."""
    for part in dotted.split("."):
        c = c.getField(part)
    return c


def first_path(arr: Column, dotted: str) -> Column:
    """P2+P3: field of the first element of an array of structs (NULL-safe)."""
    return path(first(arr), dotted)


def eav_pivot(df: DataFrame, keys: Sequence[str], attr: Column, value: Column,
              spec: Sequence[tuple[str, str, Callable[[Column], Column], str]]) -> DataFrame:
    """A2: long (key, attribute, value) rows -> one wide row per key.

    ``spec`` rows are (attribute label, output column, value function,
    aggregate name). Rows with an unknown attribute still produce the key
    with all-NULL values.
    """
    aggs = [AGGS[agg](F.when(attr == F.lit(label), fn(value))).alias(out)
            for label, out, fn, agg in spec]
    return df.groupBy(*keys).agg(*aggs)


def team_stat_spec(fields, strict: bool = True):
    return [(label, out, (lambda v, r=rule: RULES[r](v, strict)), agg)
            for label, out, rule, agg in fields]
