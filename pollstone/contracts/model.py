"""A data contract and the DataFrame operations that enforce it."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pollstone.functions.expr import lenient_cast

# The contract type vocabulary.
TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "integer": T.IntegerType(),
    "long": T.LongType(),
    "float": T.DoubleType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}

ERRORS = "contract_errors"


@dataclass(frozen=True)
class ContractField:
    name: str
    type: str
    required: bool = False
    default: str | None = None

    @property
    def spark_type(self) -> T.DataType:
        if self.type not in TYPES:
            raise ValueError(f"Unknown contract type {self.type!r} for column {self.name}")
        return TYPES[self.type]


@dataclass(frozen=True)
class Contract:
    dataset: str
    fields: tuple[ContractField, ...]
    primary_key: tuple[str, ...] = ()
    version: str = "1.0.0"

    @classmethod
    def of(
        cls,
        dataset: str,
        columns: Mapping[str, str],
        primary_key: Sequence[str] = (),
        defaults: Mapping[str, str] | None = None,
    ) -> Contract:
        """Short form: a type name per column, with ``!`` after it for required ones."""
        return cls(
            dataset,
            tuple(
                ContractField(name, kind.rstrip("!"), kind.endswith("!"), (defaults or {}).get(name))
                for name, kind in columns.items()
            ),
            tuple(primary_key),
        )

    @classmethod
    def from_mapping(cls, document: Mapping) -> Contract:
        """Build from the parsed form of a contract file."""
        return cls(
            document["dataset"],
            tuple(
                ContractField(name, spec["type"], bool(spec.get("required", False)), spec.get("default"))
                for name, spec in (document.get("fields") or {}).items()
            ),
            tuple(document.get("primary_key") or ()),
            str(document.get("version", "1.0.0")),
        )

    @classmethod
    def load(cls, path: str) -> Contract:
        """Read a YAML or JSON contract file."""
        file = Path(path)
        if not file.exists():
            raise FileNotFoundError(f"Data contract not found: {path}")
        text = file.read_text(encoding="utf-8")
        if file.suffix == ".json":
            return cls.from_mapping(json.loads(text))
        try:
            import yaml
        except ImportError as error:
            raise RuntimeError("Reading YAML contracts needs PyYAML; use a JSON contract instead") from error
        return cls.from_mapping(yaml.safe_load(text))

    @property
    def columns(self) -> list[str]:
        return [field.name for field in self.fields]

    @property
    def required(self) -> list[str]:
        return [field.name for field in self.fields if field.required]

    def schema(self) -> T.StructType:
        return T.StructType(
            [T.StructField(field.name, field.spark_type, not field.required) for field in self.fields]
        )

    def text_schema(self) -> T.StructType:
        """All columns as text, for raw files whose values are checked after reading."""
        return T.StructType([T.StructField(field.name, T.StringType()) for field in self.fields])

    def missing_required(self, df: DataFrame) -> list[str]:
        """Required columns the DataFrame does not have; a schema check, no job runs."""
        return [name for name in self.required if name not in df.columns]

    def _value(self, df: DataFrame, field: ContractField) -> Column:
        if field.name not in df.columns:
            return F.lit(field.default).cast(field.spark_type)
        value = lenient_cast(F.col(field.name), df.schema[field.name].dataType, field.spark_type)
        if field.default is None:
            return value
        return F.coalesce(value, F.lit(field.default).cast(field.spark_type))

    def conform(self, df: DataFrame, keep_extra: bool = False) -> DataFrame:
        """Contract columns in contract order and type.

        A missing column or NULL takes the field's default; a value that does
        not fit the type becomes NULL.
        """
        extra = [F.col(name) for name in df.columns if keep_extra and name not in self.columns]
        return df.select(*[self._value(df, field).alias(field.name) for field in self.fields], *extra)

    def with_errors(self, df: DataFrame, keep_extra: bool = False) -> DataFrame:
        """Conformed rows plus the list of fields each row violates (empty when it fits)."""
        extra = [name for name in df.columns if keep_extra and name not in self.columns]
        values = [self._value(df, field).alias(field.name) for field in self.fields]
        given = [F.col(name).isNotNull().alias(f"_given_{name}") for name in self.columns if name in df.columns]
        broken: list[tuple[Column, str]] = []
        for field in self.fields:
            absent = F.col(field.name).isNull()
            if field.name in df.columns:
                present = F.col(f"_given_{field.name}")
                broken.append((present & absent, f"{field.name}: not a {field.type}"))
                absent = absent & ~present
            if field.required:
                broken.append((absent, f"{field.name}: required"))
        listed = F.array_compact(F.array(*[F.when(test, F.lit(text)) for test, text in broken]))
        # Only rows with an error pay for building the list.
        any_broken = reduce(lambda left, right: left | right, [test for test, _ in broken], F.lit(False))
        errors = F.when(any_broken, listed).otherwise(F.array().cast("array<string>")).alias(ERRORS)
        return df.select(*values, *extra, *given).select(*self.columns, *extra, errors)

    def split(self, df: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(rows that keep the contract, rejected rows with their errors)."""
        checked = self.with_errors(df)
        clean = F.size(ERRORS) == 0
        return checked.filter(clean).drop(ERRORS), checked.filter(~clean)

    def key_check(self, df: DataFrame) -> DataFrame:
        """One row: rows, rows with a NULL in the primary key, and keys that occur more than once.

        The counts are combined per key before the shuffle. A contract without
        a key, or rows without one of its columns, is an error.
        """
        lacking = [name for name in self.primary_key if name not in df.columns]
        if lacking or not self.primary_key:
            raise ValueError(f"No primary key to check in {self.dataset}: {lacking or 'none declared'}")
        absent = reduce(lambda left, right: left | right, [F.col(name).isNull() for name in self.primary_key])
        per_key = df.groupBy(*self.primary_key).agg(F.count(F.lit(1)).alias("_n"))
        total = lambda value: F.coalesce(F.sum(value), F.lit(0)).cast("bigint")
        return per_key.agg(
            total("_n").alias("rows"),
            total(F.when(absent, F.col("_n"))).alias("null_keys"),
            F.count_if(F.col("_n") > 1).alias("repeated_keys"),
        ).select(F.lit(self.dataset).alias("dataset_name"), F.array_join(F.array(*map(F.lit, self.primary_key)), ",").alias("key"), "*")
