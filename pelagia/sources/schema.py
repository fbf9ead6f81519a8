"""Declared schemas: type names, column attributes, merging and validation of job settings."""

from __future__ import annotations

import re
from typing import Any

from pyspark.sql import types as T

#: Type names of job settings and the Spark type of each; unsigned types widen.
TYPES: dict[str, T.DataType] = {
    "int8": T.ByteType(), "int16": T.ShortType(), "int32": T.IntegerType(), "int64": T.LongType(),
    "uint8": T.ShortType(), "uint16": T.IntegerType(), "uint32": T.LongType(), "uint64": T.DecimalType(20, 0),
    "float": T.FloatType(), "float32": T.FloatType(), "float64": T.DoubleType(), "double": T.DoubleType(),
    "string": T.StringType(), "object": T.StringType(), "|S1": T.StringType(), "byte": T.BinaryType(), "bool": T.BooleanType(),
    "datetime64[ns]": T.TimestampType(), "timestamp[ns]": T.TimestampType(), "timestamp[ms]": T.TimestampType(),
    "timedelta64[ns]": T.LongType(), "date32[day]": T.DateType(), "time32[s]": T.LongType(), "time64[us]": T.LongType(),
    "list<element: string>": T.ArrayType(T.StringType()),
}


def spark_type(name: str) -> T.DataType:
    if name not in TYPES:
        raise ValueError(f"unsupported type {name!r}")
    return TYPES[name]


def struct_of(schema: dict[str, Any] | list[str]) -> T.StructType:
    """A StructType of {"name": {"type": ..., attributes}} or ["name: type", ...]; attributes become field metadata."""
    if isinstance(schema, list):
        schema = {n.strip(): {"type": t.strip()} for n, _, t in (s.partition(":") for s in schema)}
    fields = []
    for name, spec in schema.items():
        if not isinstance(spec, dict):
            raise TypeError(f"{name}: a dict is wanted, not {type(spec).__name__}")
        if "type" not in spec:
            raise KeyError(f"{name}: no type")
        attributes = {k: v for k, v in spec.items() if k != "type" and isinstance(v, (str, int, float, bool))}
        fields.append(T.StructField(name, spark_type(spec["type"]), True, attributes))
    return T.StructType(fields)


def full_schema(config: dict[str, Any]) -> dict[str, Any]:
    """Declared columns and added ones, without dropped ones."""
    options = config.get("schema_transformation", {})
    out = dict(config.get("schema", {}))
    for name, spec in options.get("add_variables", {}).items():
        out[name] = spec.get("schema", spec)
    return {k: v for k, v in out.items() if k not in set(options.get("drop_variables", []))}


def merge_settings(parent: dict[str, Any], child: dict[str, Any]) -> dict[str, Any]:
    """Child values win; dicts merge to any depth, except `schema`, which the child replaces whole."""
    out = dict(parent)
    for key, value in child.items():
        if key != "schema" and isinstance(value, dict) and isinstance(out.get(key), dict):
            out[key] = merge_settings(out[key], value)
        else:
            out[key] = value
    return out


def settings_errors(config: dict[str, Any]) -> list[str]:
    """What is wrong with the settings of a tabular job, as messages."""
    errors, schema = [], full_schema(config)
    options = config.get("schema_transformation", {})
    keys = [p.get("source_variable", p) if isinstance(p, dict) else p for p in options.get("partitioning", [])]
    errors += [f"partitioning lacks {k}" for k in ("timestamp", "polygon") if k not in keys]
    errors += [f"partition key {k} is not in the schema" for k in keys if k not in schema]
    for part in options.get("partitioning", []):
        extent = part.get("time_extent") or part.get("spatial_extent") if isinstance(part, dict) else None
        for role in ("time_varname", "lat_varname", "lon_varname"):
            if extent and role in extent and extent[role] not in schema:
                errors.append(f"{role} {extent[role]} is not in the schema")
        if extent and "partition_period" in extent and extent["partition_period"] not in ("Y", "Q", "M", "W", "D", "h", "min", "s", "ms", "us", "ns"):
            errors.append(f"no period {extent['partition_period']}")
    readers = [k for k in ("pandas_read_csv_config", "polars_read_csv_config") if config.get(k)]
    if len(readers) > 1:
        errors.append("more than one CSV reader")
    for path in config.get("paths", []):
        try:
            for pattern in path.get("filter", []):
                re.compile(pattern)
        except re.error as e:
            errors.append(f"filter: {e}")
        if re.search(r"FILL ?UP|TODO", str(path.get("s3_uri", ""))):
            errors.append("a placeholder is left in a path")
    return errors


def cube_settings_errors(config: dict[str, Any]) -> list[str]:
    """What is wrong with the settings of a gridded job: one append dimension, known dimensions, a sort key among them."""
    errors, dims = [], config.get("dimensions", {})
    append = [k for k, d in dims.items() if d.get("append_dim")]
    if len(append) > 1:
        errors.append("more than one append dimension")
    names = {d.get("name", k) for k, d in dims.items()}
    errors += [f"dimension {n} is not in the schema" for n in sorted(names) if n not in config.get("schema", {})]
    by = config.get("dataset_sort_by")
    errors += [f"sort key {k} is no dimension" for k in ([by] if isinstance(by, str) else by or []) if k not in names]
    return errors
