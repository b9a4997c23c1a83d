"""Secret scans with multipart credential linking; built-in functions only.

Strong patterns (assignments, access identifiers, hex keys) are reported by themselves. Weak parts - an account name, a mixed
token, an endpoint - are common in clean text, so they are reported only next to their complement: an interval join within
one document asks whether an identifier and a secret lie within a scope of each other; an endpoint needs both.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeflow.llm.common import cut_lineage

SCOPE_CHARS = 256
# fixed values of the base patterns; a match that fails its check is dropped, not retried
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+"""
ASSIGN_VALUE = r"""^(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
# weak parts
USER = r"""(?i:user(?:name)?|login|account|client_?id|access_?key_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9][A-Za-z0-9._@+-]{2,}"""
MIXED = r"[A-Za-z0-9+/_-]+"
ENDPOINT = r"""(?i:https?|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3)://[^\x20\x09-\x0D"'<>]+"""
KINDS = ("assign", "access", "hex", "user", "mixed", "endpoint")
BASE = KINDS[:3]
ROLE = {"assign": "secret", "access": "id", "hex": "secret", "user": "id", "mixed": "secret", "endpoint": "endpoint"}


def _cuts(text: Column, pattern: str, wanted: Column) -> Column:
    """Array of (length of the gap before, match) for all matches in order; empty unless ``wanted``."""
    gaps, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))
    pairs = F.zip_with(gaps, found, lambda g, m: F.struct(F.length(g).alias("gap"), m.alias("found")))
    # one gap more than matches: the rest of the text
    pairs = F.filter(pairs, lambda p: p["found"].isNotNull())
    return F.when(wanted, pairs).otherwise(F.array().cast("array<struct<gap:int,found:string>>"))


def _passes(kind: Column, found: Column) -> Column:
    n = F.length(found)
    mixed = (n >= 16) & found.rlike("[0-9]") & found.rlike("[a-z]") & found.rlike("[A-Z]")
    return (
        F.when(kind == "assign", F.length(F.regexp_extract(found, ASSIGN_VALUE, 1)) >= 6)
        .when(kind == "access", n >= 20)
        .when(kind == "hex", n >= 24)
        .when(kind == "mixed", mixed)
        .otherwise(True)
    )


def _near(weak: DataFrame, parts: DataFrame, role: str, scope: int) -> DataFrame:
    """Rows of ``weak`` with a part of that role at most ``scope`` characters away in the same document.

    An interval join: the other parts are listed under the bucket of every place they reach, the weak rows look into all buckets
    they cover. Only places are listed once for each bucket, not the matches, so a long part costs its length; a semi-join leaves
    each row once however many parts are near.
    """
    over = lambda first, last: F.explode(F.sequence(F.floor(first / scope), F.floor(last / scope))).alias("bucket")
    reach = parts.filter(F.col("role") == role).select(
        "row", F.col("start").alias("o_start"), F.col("end").alias("o_end"), over(F.col("start") - scope, F.col("end") + scope)
    )
    place = ["row", "ordinal", "start"]
    looked = weak.select(*place, "end", over(F.col("start"), F.col("end")))
    inside = (F.col("o_start") <= F.col("end") + scope) & (F.col("o_end") >= F.col("start") - scope)
    l, r = looked.alias("l"), reach.alias("r")
    near = l.join(r, (F.col("l.row") == F.col("r.row")) & (F.col("l.bucket") == F.col("r.bucket")) & inside, "left_semi")
    return weak.join(near.select(*place).distinct(), place, "left_semi")


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope_chars: int = SCOPE_CHARS) -> DataFrame:
    """One row per document: ``doc_id, spans`` - array of ``(start, kind number, end, kind, found)`` in order of start, then kind.

    Offsets are code points, ends exclusive. A null text is empty; a document without spans has an empty array. Rows may share
    an id or have none.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    lower, digit = F.lower(text), text.rlike("[0-9]")
    names = ("password", "passwd", "secret", "token", "apikey", "api_key")
    # cheap tests first: the patterns run on texts that can hold them only
    wanted = {
        "assign": (ASSIGN, reduce(lambda a, b: a | b, [F.contains(lower, F.lit(w)) for w in names])),
        "access": (ACCESS, F.contains(text, F.lit("AKIA"))),
        "hex": (HEX, text.rlike("[0-9a-f]{24}")),
        "user": (USER, text.rlike("[:=]") & text.rlike(USER)),
        "mixed": (MIXED, digit & text.rlike(r"[A-Za-z0-9+/_-]{16}")),
        "endpoint": (ENDPOINT, F.contains(text, F.lit("://"))),
    }
    tagged = lambda kind: lambda p, i: F.struct(F.lit(kind).alias("kind"), i.alias("i"), p["gap"].alias("gap"), p["found"].alias("found"))
    cuts = [F.transform(_cuts(text, pattern, test), tagged(kind)) for kind, (pattern, test) in wanted.items()]
    rows = cut_lineage(docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), F.concat(*cuts).alias("cuts")))
    upto = Window.partitionBy("row", "kind").orderBy("i")
    ordinal = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).cast("int")
    role = F.element_at(F.create_map(*[F.lit(x) for pair in ROLE.items() for x in pair]), F.col("kind"))
    parts = (
        rows.select("row", F.inline("cuts"))
        .withColumn("end", F.sum(F.col("gap") + F.length("found")).over(upto))
        .filter(_passes(F.col("kind"), F.col("found")))
        .select("row", "kind", ordinal.alias("ordinal"), role.alias("role"), (F.col("end") - F.length("found")).alias("start"), "end", "found")
    )
    parts = cut_lineage(parts)
    base, weak = parts.filter(F.col("kind").isin(*BASE)), parts.filter(~F.col("kind").isin(*BASE))
    # a mixed token inside a strong match is that match, not another secret: it starts within a strong span
    strong = Window.partitionBy("row").orderBy("start", "ordinal").rowsBetween(Window.unboundedPreceding, -1)
    covered = parts.withColumn("until", F.max(F.when(F.col("kind").isin(*BASE), F.col("end"))).over(strong))
    weak = covered.filter(~F.col("kind").isin(*BASE) & (F.col("start") >= F.coalesce("until", F.lit(0)))).drop("until")
    parts = cut_lineage(base.unionByName(weak))
    weak = parts.filter(~F.col("kind").isin(*BASE))
    linked = (
        _near(weak.filter("role = 'id'"), parts, "secret", scope_chars)
        .unionByName(_near(weak.filter("role = 'secret'"), parts, "id", scope_chars))
        .unionByName(_near(_near(weak.filter("role = 'endpoint'"), parts, "id", scope_chars), parts, "secret", scope_chars))
    )
    spans = (
        base.unionByName(linked)
        .groupBy("row")
        .agg(F.array_sort(F.collect_list(F.struct("start", "ordinal", "end", "kind", "found"))).alias("spans"))
    )
    none = F.array().cast("array<struct<start:bigint,ordinal:int,end:bigint,kind:string,found:string>>")
    return rows.select("row", "doc_id").join(spans, "row", "left").select("doc_id", F.coalesce("spans", none).alias("spans"))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
