"""Reading fields of a parsed JSON record (VARIANT), where a field may change type by row."""

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.StringType())
def _last_wins(text: pd.Series) -> pd.Series:
    def once(t: str) -> str:
        try:
            return json.dumps(json.loads(t), ensure_ascii=False, allow_nan=False)
        except (ValueError, RecursionError):
            return t

    return text.map(once, na_action="ignore")


def _mended(raw: Column) -> Column:
    """Text that Spark's parser refuses, with each key once: the last value holds, at every depth. Only such texts travel to Python."""
    return _last_wins(F.when(F.try_parse_json(raw).isNull(), raw))


def parse(raw: Column) -> Column:
    """JSON text as VARIANT, whatever the session says of keys that an object repeats; text that is no JSON ends the job."""
    return F.coalesce(F.try_parse_json(raw), F.parse_json(_mended(raw)))


def try_parse(raw: Column) -> Column:
    """The same with null for text that is no JSON."""
    return F.coalesce(F.try_parse_json(raw), F.try_parse_json(_mended(raw)))


def text(record: Column, path: str) -> Column:
    """Field as text, null when absent or null. Nested values come as JSON text."""
    return F.try_variant_get(record, path, "string")


def text_or(record: Column, path: str, default: str) -> Column:
    """Field as text; the default stands in for an absent field, not for an explicit null."""
    return F.when(~is_null(record, path), F.coalesce(text(record, path), F.lit(default)))


def is_null(record: Column, path: str) -> Column:
    """True only for a field that is present and null."""
    return F.coalesce(F.is_variant_null(F.try_variant_get(record, path, "variant")), F.lit(False))


def items(record: Column, path: str) -> Column:
    """List field as ARRAY<VARIANT>, null when the field is anything else."""
    return F.try_variant_get(record, path, "array<variant>")


def is_object(value: Column) -> Column:
    return F.startswith(F.schema_of_variant(value), F.lit("OBJECT"))


def is_text(value: Column) -> Column:
    return F.schema_of_variant(value) == "STRING"


def is_list(value: Column) -> Column:
    return F.startswith(F.schema_of_variant(value), F.lit("ARRAY"))
