"""Decoders by format name. A decoder takes the envelope and the job and returns change events."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from changeflow.sources.decode_fixed import decode_fixed
from changeflow.sources.decode_json import decode_json_array, decode_json_image
from changeflow.sources.decode_proto import decode_proto
from changeflow.sources.decode_text import decode_ctrl, decode_delimited

_DECODERS: dict[str, Callable] = {}


def register_decoder(name: str, decoder: Callable) -> None:
    """Make ``decoder(envelope, job, catalog) -> change events`` available as format ``name``."""
    _DECODERS[name] = decoder


def decode(envelope: DataFrame, job, catalog) -> DataFrame:
    if job.format not in _DECODERS:
        raise ValueError(f"unknown format {job.format!r}; registered: {sorted(_DECODERS)}")
    return _DECODERS[job.format](envelope, job, catalog)


def _single(job, catalog):
    """Formats without a table name in the message need the job's default table."""
    return catalog[f"{job.def_schema}.{job.def_table}"]


register_decoder("", lambda df, job, cat: decode_delimited(df, _single(job, cat), job.delimiter, job.encoding))
register_decoder("ctrl", lambda df, job, cat: decode_ctrl(df, job.def_schema, job.encoding))
register_decoder("json", lambda df, job, cat: decode_json_image(df, job.json_null, job.encoding))
register_decoder(
    "json_array", lambda df, job, cat: decode_json_array(df, job.def_schema, job.json_null, job.encoding)
)
register_decoder("fixed", lambda df, job, cat: decode_fixed(df, _single(job, cat), job.big_endian))
register_decoder(
    "protobuf", lambda df, job, cat: decode_proto(df, cat, job.def_schema, job.encoding, job.ignore)
)
