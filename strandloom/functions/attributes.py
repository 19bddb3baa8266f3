"""The attribute column of feature tables: a map from a semicolon list, and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _entry(token: Column) -> Column:
    token = F.trim(token)
    at = F.instr(token, "=")
    key = F.when(at > 0, F.trim(F.substring(token, F.lit(1), at - 1))).otherwise(F.lit("Note"))
    value = F.when(at > 0, F.trim(F.substring(token, at + 1, F.length(token)))).otherwise(token)
    value = F.regexp_replace(value, r"\*$", "")
    return F.struct(key.alias("key"), F.regexp_replace(value, '^"(.*)"$', "$1").alias("value"))


def attribute_map(text: Column) -> Column:
    """Map of key=value tokens; a bare token goes to Note; of repeated keys the last one wins; null and '.' give null."""
    tokens = F.filter(F.split(text, ";"), lambda x: F.trim(x) != "")
    entries = F.transform(tokens, _entry)
    # the last entry of each key, keys in order of first sight
    keys = F.array_distinct(F.transform(entries, lambda e: e["key"]))
    last = F.map_from_entries(F.transform(keys, lambda k: F.struct(k, F.element_at(F.filter(entries, lambda e: e["key"] == k), -1)["value"])))
    return F.when(text.isNotNull() & (text != "."), last)


def asterisk(text: Column) -> Column:
    """Whether any token ends in an asterisk."""
    return F.coalesce(text.rlike(r"\*\s*(;|$)"), F.lit(False))


def attribute(text: Column, key: str) -> Column:
    """S3: one attribute's value by pattern, null if absent."""
    return F.nullif(F.regexp_extract(text, f"(?:^|;)\\s*{key}=([^;]+)", 1), F.lit(""))


def escaped(value: Column) -> Column:
    """a value with reserved characters as %XX."""
    return F.replace(F.url_encode(value), F.lit("+"), F.lit("%20"))


def attribute_string(attributes: Column) -> Column:
    """K1: key=value tokens in order of key; null for an empty map."""
    entries = F.array_sort(F.map_entries(attributes))
    return F.nullif(F.array_join(F.transform(entries, lambda e: F.concat_ws("=", e["key"], e["value"])), ";"), F.lit(""))


def column_or_attribute(df: DataFrame, name: str, attributes: str = "attributes") -> Column:
    """A column by name, else that attribute; a leading asterisk cuts the value at its first point."""
    plain = name.removeprefix("*")
    col = F.col(plain) if plain in df.columns else F.col(attributes)[plain]
    return F.substring_index(col, ".", 1) if name.startswith("*") else col
