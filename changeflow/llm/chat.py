"""Chat formatting with typed content parts.

A turn holds ordered parts: text, image, audio or document. A visitor flattens them in order: a run of texts is escaped as one string
(or two texts could make a control string between them), every other part becomes a numbered placeholder, an attachment record with its reference, and a count of the tokens that it will be
expanded to. Turns are framed by control strings; what looks like one inside a text is escaped, so that a
formatted conversation can be read back exactly. Formatting works row by row: a conversation is never gathered in memory.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
# every control string begins with these two characters, so breaking them up in texts is enough; the escape is escaped, too
OPEN, ESCAPE = "<|", "\\"
PARTS = "array<struct<type:string,text:string,ref:string,width:long,height:long,seconds:double,pages:long>>"
IMAGE_TILE, IMAGE_TILE_TOKENS, IMAGE_BASE_TOKENS = 512, 170, 85
AUDIO_TOKENS_PER_SECOND, DOCUMENT_TOKENS_PER_PAGE = 25, 600
ATTACHMENTS = "array<struct<ordinal:int,type:string,ref:string,tokens:long>>"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE * 2)), F.lit(OPEN), F.lit("<" + ESCAPE + "|"))


def unescaped(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


class PartVisitor:
    """One method for each type of part gives its expanded token count; unknown types are an error."""

    def text(self, part: Column) -> Column:
        return F.lit(0).cast("long")

    def image(self, part: Column) -> Column:
        tiles = lambda c: F.ceil(F.coalesce(c, F.lit(IMAGE_TILE)) / IMAGE_TILE)
        return (tiles(part["width"]) * tiles(part["height"]) * IMAGE_TILE_TOKENS + IMAGE_BASE_TOKENS).cast("long")

    def audio(self, part: Column) -> Column:
        return F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * AUDIO_TOKENS_PER_SECOND).cast("long")

    def document(self, part: Column) -> Column:
        return (F.coalesce(part["pages"], F.lit(1)) * DOCUMENT_TOKENS_PER_PAGE).cast("long")

    TYPES = ("text", "image", "audio", "document")

    def unknown(self, part: Column) -> Column:
        return F.raise_error(F.concat(F.lit("unknown part type: "), F.coalesce(part["type"], F.lit("null"))))

    def flattened(self, parts: Column) -> Column:
        """Escaped runs of texts and numbered placeholders in order; unknown and null types are an error here too."""
        empty = F.struct(F.lit("").alias("done"), F.lit("").alias("run"), F.lit(0).alias("n"))

        def add(state, part):
            text, other = part["type"].eqNullSafe("text"), part["type"].isin(*self.TYPES)
            mark = F.concat(F.lit(OPEN), part["type"], F.lit("_"), (state["n"] + 1).cast("string"), F.lit("|>"))
            mark = F.when(F.coalesce(other, F.lit(False)), mark).otherwise(self.unknown(part).cast("string"))
            return F.struct(
                F.when(text, state["done"]).otherwise(F.concat(state["done"], escaped(state["run"]), mark)).alias("done"),
                F.when(text, F.concat(state["run"], F.coalesce(part["text"], F.lit("")))).otherwise("").alias("run"),
                F.when(text, state["n"]).otherwise(state["n"] + 1).alias("n"),
            )

        return F.aggregate(parts, empty, add, lambda state: F.concat(state["done"], escaped(state["run"])))

    def visit(self, part: Column) -> Column:
        out = self.unknown(part).cast("long")
        for name in reversed(self.TYPES):
            out = F.when(part["type"] == name, getattr(self, name)(part)).otherwise(out)
        return out


def text_part(text: Column) -> Column:
    """A plain text as an array of one part."""
    nothing = lambda kind, name: F.lit(None).cast(kind).alias(name)
    return F.array(
        F.struct(
            F.lit("text").alias("type"), F.coalesce(text, F.lit("")).alias("text"), nothing("string", "ref"), nothing("long", "width"),
            nothing("long", "height"), nothing("double", "seconds"), nothing("long", "pages"),
        )
    )


def format_turns(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", parts: Column | None = None, trained_roles=("assistant",)) -> DataFrame:
    """One row per turn: ``conv_id, turn, segment, loss_start, loss_end, attachments, expanded_tokens``.

    ``segment`` is the framed turn, and the segments of a conversation in order of turn are its formatted text. The loss mask is the
    code points from ``loss_start`` to ``loss_end`` of the segment, empty for roles that are not trained on.
    A null role or text is empty; a turn without parts is an empty text. Turns with equal numbers are ordered by their text.
    """
    parts = parts if parts is not None else text_part(F.col("text"))
    visitor = PartVisitor()
    seen = turns.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(parts, F.array().cast(PARTS)).alias("parts"),
    )
    others = F.filter("parts", lambda p: ~p["type"].eqNullSafe("text"))
    flat = visitor.flattened(F.col("parts"))
    attachments = F.transform(
        others, lambda p, i: F.struct((i + 1).cast("int").alias("ordinal"), p["type"].alias("type"), p["ref"].alias("ref"), visitor.visit(p).alias("tokens"))
    )
    # the role ends with its line, so a line break inside it is escaped
    head = F.concat(F.lit(START), F.replace(escaped(F.col("role")), F.lit("\n"), F.lit(ESCAPE + "\n")), F.lit("\n"))
    body = seen.select("conv_id", "turn", "role", head.alias("head"), flat.alias("flat"), attachments.alias("attachments"))
    begin = F.length("head")
    trained = F.col("role").isin(*trained_roles)
    return body.select(
        "conv_id", "turn", F.concat("head", "flat", F.lit(END + "\n")).alias("segment"), begin.cast("long").alias("loss_start"),
        F.when(trained, begin + F.length("flat")).otherwise(begin).cast("long").alias("loss_end"), "attachments",
        F.aggregate("attachments", F.lit(0).cast("long"), lambda a, x: a + x["tokens"]).alias("expanded_tokens"),
    )


FRAME = re.compile(re.escape(START) + r"((?:\\.|[^\\\n])*)\n(.*)" + re.escape(END) + "\n", re.S)


# in an escaped text this cannot occur
PLACEHOLDER = re.compile(r"<\|([a-z]+)_([0-9]+)\|>")


def parse_segment(segment: str) -> tuple[str, list[tuple[str, str | int]]]:
    """Role and parts of a framed turn: ``("text", text)``, or type and ordinal of an attachment. Adjacent texts are one, empty ones are none."""
    m = FRAME.fullmatch(segment)
    if not m:
        raise ValueError("not a framed turn")
    pieces = PLACEHOLDER.split(m[2])
    parts: list[tuple[str, str | int]] = []
    for i in range(0, len(pieces), 3):
        if pieces[i]:
            parts.append(("text", unescaped(pieces[i])))
        if i + 1 < len(pieces):
            parts.append((pieces[i + 1], int(pieces[i + 2])))
    return unescaped(m[1]), parts


def _digests(batches):
    """Segments come sorted by conversation; one running state is kept, so a conversation may be of any length."""
    import pyarrow as pa

    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_attachments", "expanded_tokens"]

    def batch_of(done):
        types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], t) for i, t in enumerate(types)], names=names)

    at, state = None, None

    def closed():
        conv, n, turns, chars, loss, *sums = state
        return conv, n, turns.hexdigest(), chars, loss.hexdigest(), *sums

    for batch in batches:
        done = []
        columns = (batch.column(c).to_pylist() for c in ("conv_id", "segment", "loss_start", "loss_end", "expanded_tokens"))
        for conv, segment, begin, end, tokens in zip(*columns):
            if at != (conv,):
                if state:
                    done.append(closed())
                at, state = (conv,), [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0, 0]
            role, parts = parse_segment(segment)
            text = "".join(x if kind == "text" else f"{OPEN}{kind}_{x}|>" for kind, x in parts)
            state[1] += 1
            state[2].update(f"{role}\n{text}\n".encode())
            masked = unescaped(segment[begin:end])
            state[3] += len(masked)
            state[4].update(masked.encode())
            state[5] += len(segment)
            state[6] += sum(kind != "text" for kind, _ in parts)
            state[7] += tokens
        yield batch_of(done)
    if state:
        yield batch_of([closed()])


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of every conversation, read from the formatted turns, and its attachments.

    ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_attachments, expanded_tokens``; attachments stand in the
    digests by their placeholders.
    """
    schema = (
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
        "n_attachments long, expanded_tokens long"
    )
    return (
        formatted.select(F.col("conv_id").cast("long"), "turn", "segment", "loss_start", "loss_end", "expanded_tokens")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "segment")
        .mapInArrow(_digests, schema)
    )
