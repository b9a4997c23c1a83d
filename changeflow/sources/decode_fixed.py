"""Decoder for fixed-width binary records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow import fixed_values as fv
from changeflow.model import TableSpec
from changeflow.sources.decode_common import cell, change_event, error


def _integer(start: int, width: int, big_endian: bool, signed: bool) -> Column:
    """Text of the integer in ``width`` bytes from 0-based ``start``."""
    digits = F.hex(F.substring("value", start + 1, width))
    if not big_endian:
        digits = F.concat(*[F.substring(digits, 2 * i + 1, 2) for i in reversed(range(width))])
    number = F.conv(digits, 16, 10)
    if not signed:
        return number
    wide = number.cast("decimal(20,0)")
    full = F.lit(str(256**width)).cast("decimal(20,0)") if width < 8 else F.lit("18446744073709551616").cast("decimal(20,0)")
    half = F.lit(str(256**width // 2)).cast("decimal(20,0)")
    return F.when(wide >= half, wide - full).otherwise(wide).cast("string")


def decode_fixed(df: DataFrame, spec: TableSpec, big_endian: bool = False, signed: bool = False) -> DataFrame:
    """Columns by declared width, always an insert. Integers are unsigned unless ``signed``; character
    fields end with the message. With integer columns only, the message length must match exactly."""
    none, yes, no = F.lit(None).cast("string"), F.lit(True), F.lit(False)
    length = F.length("value")
    start, entries, unsupported, needed = 0, [], None, 0
    for c in spec.columns:
        if c.type_code in fv.FIXED_INT_CODES:
            value = _integer(start, c.width, big_endian, signed)
            needed = start + c.width
        elif c.type_code in fv.FIXED_CHAR_CODES:
            value = F.substring("value", start + 1, c.width).cast("string")
        else:
            unsupported, value = c.name, none
        is_text = c.type_code in fv.FIXED_CHAR_CODES
        entries += [F.lit(c.name), cell(value, none, yes, no, quoted=is_text)]
        start += c.width
    only_integers = all(c.type_code in fv.FIXED_INT_CODES for c in spec.columns)
    if unsupported:
        code = F.lit("unsupported_type")
    elif only_integers:
        code = F.when(length != start, "bad_length")
    else:
        code = F.when(length < needed, "bad_length")
    return change_event(
        df,
        src_schema=F.lit(spec.schema),
        src_table=F.lit(spec.table),
        op=F.lit("I"),
        cols=F.create_map(*entries),
        raw=F.hex("value"),
        error=error(code, length.cast("string")),
    )
