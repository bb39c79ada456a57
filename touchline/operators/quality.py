"""Key and reference checks.

The warehouse declares primary and foreign keys without enforcing them.
These checks are distributed aggregates: duplicates are found with a
partially aggregated ``groupBy(key).count()``; all references are checked in
one pass that reads every table once (``fk_report``), reduced to one row per
value map-side, so a hot reference never crosses the network row by row (NULL
references are not orphans). A check whose table lacks a column raises an
error; it is never left out.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.schemas import FOREIGN_KEYS, PRIMARY_KEYS


def pk_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their row count."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("Duplicates"))
            .where(F.col("Duplicates") > 1))


def fk_orphan_rows(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose non-NULL reference has no parent row."""
    keys = parent.select(F.col(parent_column).alias(column)).distinct()
    return child.where(F.col(column).isNotNull()).join(keys, column, "left_anti")


def _require(table: str, df: DataFrame, columns: Sequence[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{table} lacks {', '.join(missing)}: its check cannot run")


def fk_report(star, foreign_keys=FOREIGN_KEYS) -> DataFrame:
    """One row per declared foreign key with its orphan count.

    Every table is read once and gives a row for each of its references and
    each of its referenced keys: (key, value, number of the reference among
    those to that key, or none). One aggregate per (key, value), map-side
    combined, says whether the key has the value and how many rows of each
    reference name it; a second one adds up what is not there. No join, and two
    exchanges whatever the number of references.
    """
    keys = sorted({(parent, pcol) for _, _, parent, pcol in foreign_keys})
    to_key: dict[tuple[str, str], list[tuple[str, str]]] = {k: [] for k in keys}
    for child, col, parent, pcol in foreign_keys:
        to_key[parent, pcol].append((child, col))
    most = max(map(len, to_key.values()))
    columns = {(child, col) for child, col, _, _ in foreign_keys} | set(keys)
    for table, column in sorted(columns):
        _require(table, getattr(star, table), [column])
    whole = all(getattr(star, t).schema[c].dataType.simpleString() in ("int", "bigint") for t, c in columns)
    parts = []
    for table in sorted({t for child, _, parent, _ in foreign_keys for t in (child, parent)}):
        df, roles = getattr(star, table), []
        own = [(pcol, keys.index((parent, pcol)), -1) for parent, pcol in keys if parent == table]
        own += [(col, i, n) for i, k in enumerate(keys) for n, (child, col) in enumerate(to_key[k]) if child == table]
        for column, key, n in own:
            roles.append(F.struct(F.lit(key).alias("key"), F.col(column).cast("long" if whole else "string").alias("value"), F.lit(n).alias("n")))
        parts.append(df.select(F.inline(F.array(*roles))))
    rows = reduce(DataFrame.unionAll, parts).where(F.col("value").isNotNull())
    per_value = rows.groupBy("key", "value").agg(
        F.count_if(F.col("n") < 0).alias("held"),
        *[F.count_if(F.col("n") == n).alias(f"r{n}") for n in range(most)])
    missing = per_value.where(F.col("held") == 0)
    orphans = missing.agg(*[
        F.coalesce(F.sum(F.when(F.col("key") == i, F.col(f"r{n}"))), F.lit(0)).alias(f"k{i}r{n}")
        for i, k in enumerate(keys) for n in range(len(to_key[k]))])
    return orphans.select(F.inline(F.array(*[
        F.struct(F.lit(child).alias("Child_Table"), F.lit(col).alias("Child_Column"), F.lit(parent).alias("Parent_Table"),
                 F.col(f"k{i}r{n}").alias("Orphan_Rows"))
        for i, (parent, pcol) in enumerate(keys) for n, (child, col) in enumerate(to_key[parent, pcol])])))


def pk_report(star, primary_keys=PRIMARY_KEYS) -> DataFrame:
    """One row per table: number of key values held by more than one row."""
    parts = []
    for table, keys in primary_keys.items():
        df = getattr(star, table)
        _require(table, df, keys)
        n = pk_duplicates(df.select(*keys), keys).agg(F.count(F.lit(1)).alias("Duplicate_Keys"))
        parts.append(n.select(F.lit(table).alias("Table_Name"), "Duplicate_Keys"))
    return reduce(DataFrame.unionByName, parts)
