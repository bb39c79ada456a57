"""Schema bootstrap and drift of the landed documents.

``observed_schema`` asks the documents for their schema in one aggregate
(``schema_of_variant_agg``: partial schemas are merged map-side, one per task
reaches the last step). ``drift`` compares it with the declared schema, field
by field: what is new, what is missing, what has another type. The work on
the driver is on two schemas, whatever the number of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.schemas import envelope_ddl

#: Observed type names -> declared ones that hold them without loss.
HOLDS = {
    "BIGINT": ("bigint", "double", "variant"), "DECIMAL": ("double", "decimal", "variant"),
    "DOUBLE": ("double", "variant"), "STRING": ("string", "variant"), "BOOLEAN": ("boolean", "variant"),
    "VARIANT": ("variant",),
}
DRIFT = "Endpoint string, Path string, Change string, Declared string, Observed string"


def observed_schema(docs: DataFrame, column: str = "doc") -> str:
    """The schema of JSON documents held as text, as one type; documents that do not parse are left out."""
    parsed = docs.select(F.try_parse_json(column).alias("v")).where(F.col("v").isNotNull())
    return parsed.agg(F.schema_of_variant_agg("v")).first()[0] or "VOID"


def _parts(text: str) -> list[str]:
    """Split at the commas that are outside of brackets."""
    out, depth, start = [], 0, 0
    for i, c in enumerate(text):
        depth += (c in "<(") - (c in ">)")
        if c == "," and depth == 0:
            out.append(text[start:i])
            start = i + 1
    return [p.strip() for p in [*out, text[start:]] if p.strip()]


def observed_fields(schema: str, path: str = "") -> dict[str, str]:
    """Path -> type of the leaves; ``[]`` marks an array's elements."""
    if schema.startswith("OBJECT<"):
        out: dict[str, str] = {}
        for part in _parts(schema[len("OBJECT<"):-1]):
            name, _, kind = part.partition(":")
            out |= observed_fields(kind.strip(), f"{path}.{name.strip().strip('`')}".lstrip("."))
        return out
    if schema.startswith("ARRAY<"):
        return observed_fields(schema[len("ARRAY<"):-1], path + "[]")
    return {path: schema}


def declared_fields(kind: T.DataType, path: str = "") -> dict[str, str]:
    if isinstance(kind, T.StructType):
        out: dict[str, str] = {}
        for f in kind.fields:
            out |= declared_fields(f.dataType, f"{path}.{f.name}".lstrip("."))
        return out
    if isinstance(kind, T.ArrayType):
        return declared_fields(kind.elementType, path + "[]")
    return {path: kind.simpleString()}


def _below(path: str, fields: dict[str, str]) -> bool:
    return any(p.startswith((path + ".", path + "[")) for p in fields)


def drift(docs: DataFrame, endpoint: str, column: str = "doc") -> DataFrame:
    """Endpoint, Path, Change (new, missing, retyped), Declared, Observed; one row per field that differs.

    A field that is only ever null says nothing about its type and is left
    out. A declared ``variant`` takes any value.
    """
    spark = docs.sparkSession
    seen = observed_fields(observed_schema(docs, column))
    want = declared_fields(T.StructType.fromDDL(envelope_ddl(endpoint)))
    rows = []
    for path in sorted(seen.keys() | want.keys()):
        have, told = seen.get(path), want.get(path)
        if have == "VOID" or (have is None and "VOID" in (seen.get(path[:i]) for i, c in enumerate(path) if c in ".[")):
            continue
        if told is None and path:
            above = next((p for p in want if want[p] == "variant" and path.startswith((p + ".", p + "["))), None)
            if above is None:
                rows.append((endpoint, path, "retyped" if _below(path, want) else "new", None, have))
        elif have is None:
            if not _below(path, seen):
                rows.append((endpoint, path, "missing", told, None))
        elif told not in HOLDS.get(have.partition("(")[0], ()):
            rows.append((endpoint, path, "retyped", told, have))
    return spark.createDataFrame(rows, DRIFT)


def bootstrap_ddl(docs: DataFrame, column: str = "doc") -> str:
    """Column-list DDL of the documents: a first declared schema to edit and keep."""
    def ddl(schema: str) -> str:
        if schema.startswith("OBJECT<"):
            fields = [p.partition(":") for p in _parts(schema[len("OBJECT<"):-1])]
            return "struct<" + ", ".join(f"{n.strip()}: {ddl(k.strip())}" for n, _, k in fields) + ">"
        if schema.startswith("ARRAY<"):
            return f"array<{ddl(schema[len('ARRAY<'):-1])}>"
        return {"VOID": "string", "DECIMAL": "double"}.get(schema.partition("(")[0], schema.lower())
    whole = observed_schema(docs, column)
    if not whole.startswith("OBJECT<"):
        raise ValueError(f"the documents are no JSON objects but {whole}")
    fields = [p.partition(":") for p in _parts(whole[len("OBJECT<"):-1])]
    return ", ".join(f"{n.strip()} {ddl(k.strip())}" for n, _, k in fields)
