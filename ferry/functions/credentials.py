"""Removing credentials from anything that is logged."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ferry.functions.columns import column

# The fields that never reach a log.
CREDENTIAL_FIELDS = ("username", "password", "accessKeyId", "secretAccessKey", "properties")

# Credentials written inside a url: user and password before the last @ of the authority, with
# slashes in the password too, the same without slashes before them, and parameters named for any.
URL_PATTERNS = (
    (r"//[^\s/@:?#;]+:[^\s?#;]*@", "//"),
    (r"//[^\s/?#;]*@", "//"),
    (r"(?i)(jdbc:\w+:\w+:)[^\s?;:@/]+/[^\s?;]*@", "$1@"),
    (
        # A value in braces may hold what ends others, and a closing brace that is doubled.
        r"(?i)[?;&,][^\s=;&?,]*(?:password|passwd|pwd|secret|token|key|user)[^\s=;&?,]*=(?:\{(?:[^}]|\}\})*\}|[^\s;&]*)",
        "",
    ),
)

# A secret named in free text, outside any url.
_NAMED = re.compile(r"(?i)\b((?:password|passwd|pwd|secret|token)\s*=\s*)(?:\{(?:[^}]|\}\})*\}|'[^']*'|\"[^\"]*\"|[^\s;,&'\"]+)")


def strip_url(url: str | Column) -> Any:
    """Text or a column of text, in which urls lose ``user:pass@`` and ``;password=…``."""
    for pattern, left in URL_PATTERNS:
        if isinstance(url, Column):
            url = F.regexp_replace(url, pattern, left)
        else:
            url = re.sub(pattern, left.replace("$1", r"\1"), url)
    return url


def without_secrets(text: str, secrets: Sequence[str] = ()) -> str:
    """Free text, such as an error, without urls' credentials and without the given secrets."""
    for secret in sorted({s for s in secrets if s}, key=len, reverse=True):
        text = text.replace(secret, "***")
    return _NAMED.sub(r"\1***", strip_url(text))


def without_credentials(config: Any, fields: Sequence[str] = CREDENTIAL_FIELDS) -> Any:
    """A nested config of dicts and lists, less its credential fields."""
    if isinstance(config, Mapping):
        return {
            k: strip_url(v) if k == "url" and isinstance(v, str) else without_credentials(v, fields)
            for k, v in config.items()
            if k not in fields
        }
    if isinstance(config, (list, tuple)):
        return [without_credentials(v, fields) for v in config]
    return config


def redact(
    df: DataFrame,
    name: str,
    fields: Sequence[str] = CREDENTIAL_FIELDS,
    url_field: str | None = "url",
) -> DataFrame:
    """Replace a struct or array-of-structs column by JSON text without credentials."""
    dtype = df.schema[name].dataType
    record = dtype.elementType if isinstance(dtype, T.ArrayType) else dtype
    if not isinstance(record, T.StructType):
        raise TypeError(f"{name} is neither a struct nor an array of structs")
    present = [f for f in record.fieldNames() if f in fields]
    has_url = url_field is not None and url_field in record.fieldNames()

    def clean(x: Column) -> Column:
        if has_url:
            x = x.withField(url_field, strip_url(x[url_field]))
        return x.dropFields(*present) if present else x

    col = column(name)
    cleaned = F.transform(col, clean) if isinstance(dtype, T.ArrayType) else clean(col)
    return df.withColumn(name, F.to_json(cleaned, {"ignoreNullFields": "false"}))
