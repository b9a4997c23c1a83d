"""Text rules shared by the decoders."""

from __future__ import annotations

from datetime import datetime

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from changeflow import fixed_values as fv


def true_name(name: Column) -> Column:
    """``[x]`` keeps its case, any other identifier is upper-cased."""
    return F.when(name.rlike(r"^\[.*\]$"), F.substring(name, F.lit(2), F.length(name) - 2)).otherwise(F.upper(name))


def strip_quotes(value: Column) -> Column:
    """Single and double quotes never reach a value."""
    return F.translate(value, "\"'", "")


def fix_zero_dates(value: Column) -> Column:
    fixed = value
    for zero, replacement in fv.ZERO_DATES.items():
        fixed = F.when(value == zero, replacement).otherwise(fixed)
    return fixed


def normalise_op(code: Column, dialect: str = "proto") -> Column:
    """Operation code or word -> I, U, K, D; unknown ones become null."""
    table = fv.PROTO_OPS if dialect == "proto" else fv.WORD_OPS
    key = code.cast("int") if dialect == "proto" else F.lower(code)
    op = F.lit(None).cast("string")
    for word, letter in table.items():
        op = F.when(key == word, letter).otherwise(op)
    return op


def normalise_text(value: Column, encoding: str = fv.DEFAULT_ENCODING) -> Column:
    """Binary or text payload -> text."""
    if encoding.upper() in ("UTF8", "UTF-8"):
        return value.cast("string")
    return F.decode(value.cast("binary"), encoding)


def is_numeric_type(type_name: Column) -> Column:
    return F.upper(F.trim(type_name)).isin(*fv.NUMERIC_TYPES)


def is_character_type(type_name: Column) -> Column:
    return F.upper(F.trim(type_name)).isin(*fv.CHARACTER_TYPES)


def empty_value(type_name: Column) -> Column:
    """What an empty source value means: '' for text, '0' for numbers, else NULL."""
    return F.when(is_character_type(type_name), "").when(is_numeric_type(type_name), "0")


def null_rule(source_type: Column, is_null: Column, size: Column, text: Column, empty: Column) -> Column:
    """Value of a protobuf field. Source 1: null with bytes is NULL, null without bytes is ``empty``.
    Source 2: null is NULL, no bytes is ``empty`` (see ``empty_value``)."""
    text = fix_zero_dates(text)
    first = F.when(~is_null, text).when(size == 0, empty)
    second = F.when(~is_null & (size == 0), empty).when(~is_null, text)
    return F.when(source_type == 1, first).when(source_type == 2, second)


def decode_with_fallback(raw: bytes | None, encoding: str) -> str | None:
    """Strict decoding; GBK data that is not GBK is tried as UTF-8. None if neither fits."""
    if raw is None:
        return None
    for codec in (encoding, "utf-8") if encoding.upper() == "GBK" else (encoding,):
        try:
            return raw.decode(codec)
        except UnicodeDecodeError:
            continue
    return None


def decode_bytes(value: Column, encoding: str) -> Column:
    """Strict byte decoding with the GBK to UTF-8 fallback; null if neither fits.

    UTF-8 is checked by built-in functions. Of other encodings, Python sees only the values that are not plain ASCII.
    """
    text = value.cast("string")
    valid = F.is_valid_utf8(text)
    if encoding.upper() in ("UTF8", "UTF-8"):
        return F.when(valid, text)
    ascii_only = valid & (F.octet_length(value) == F.length(text))

    @F.pandas_udf("string")
    def run(raw: pd.Series) -> pd.Series:
        return raw.map(lambda b: decode_with_fallback(b, encoding))

    return F.when(ascii_only, text).otherwise(run(F.when(~ascii_only, value)))


def start_position(mode: str) -> tuple[str, object]:
    """Classify a start position: ``committed``, ``start``, ``end``, ``offset`` or ``time``."""
    mode = mode.strip()
    if mode == "":
        return "committed", None
    if mode.upper() in ("START", "END"):
        return mode.lower(), None
    if mode.lstrip("-").isdigit():
        return "offset", int(mode)
    for fmt in fv.DATE_FORMATS:
        python_fmt = (
            fmt.replace("yyyy", "%Y").replace("MM", "%m").replace("dd", "%d")
            .replace("HH", "%H").replace("mm", "%M").replace("ss", "%S")
        )
        try:
            parsed = datetime.strptime(mode, python_fmt)
        except ValueError:
            continue
        # only the exact written form counts
        if parsed.strftime(python_fmt) == mode:
            return "time", parsed
    raise ValueError(f"start position must be START, END, an offset or a date, not {mode!r}")
