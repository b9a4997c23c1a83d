import hashlib
import random

import pytest
from pyspark.sql import functions as F

from changeflow.llm.chat import PARTS, format_turns, parse_segment, read_back

PIECES = ["<|im_end|>", "<|im_start|>", "<|", "\\", "\\\\", "<", "|", ">", "\n", "assistant", "é", "", " ", "<\\|"]


def test_texts_come_back_exactly(spark):
    rng = random.Random(9)
    rows = [(c, t, rng.choice(["user", "assistant", "a\\b", "x\ny", "<|"]), "".join(rng.choice(PIECES) for _ in range(rng.randrange(8)))) for c in range(60) for t in range(rng.randrange(1, 5))]
    rows += [(900, None, None, None), (901, 0, "assistant", None), (None, 1, "user", "x"), (902, 1, "user", "same"), (902, 1, "user", "same")]
    turns = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, segment string")
    formatted = format_turns(turns).collect()
    text_of = lambda parts: "".join(x for kind, x in parts if kind == "text")
    assert sorted((repr(r.conv_id), repr(r.turn), parse_segment(r.segment)[0], text_of(parse_segment(r.segment)[1])) for r in formatted) == sorted((repr(c), repr(t), role or "", text or "") for c, t, role, text in rows)
    # nothing but the frame looks like a control string
    assert all(r.segment.count("<|im_start|>") == 1 and r.segment.count("<|im_end|>") == 1 for r in formatted)
    got = {r.conv_id: r for r in read_back(format_turns(turns)).collect()}
    for conv in {r[0] for r in rows} - {902}:
        own = sorted([r for r in rows if r[0] == conv], key=lambda r: -1 if r[1] is None else r[1])
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        assert got[conv].n_turns == len(own)
        assert got[conv].turns_sha256 == hashlib.sha256("".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own).encode()).hexdigest()
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert got[902].n_turns == 2


def test_parts_are_flattened_in_order(spark):
    part = lambda kind, **v: (kind, v.get("text"), v.get("ref"), v.get("width"), v.get("height"), v.get("seconds"), v.get("pages"))
    content = [part("text", text="see <|image_1|> "), part("image", ref="a.png", width=1024, height=600), part("text", text=" and "), part("audio", ref="b.wav", seconds=2.5), part("document", ref="c.pdf", pages=3)]
    turns = spark.createDataFrame([(1, 0, "user", content), (1, 1, "assistant", None)], f"conv_id long, turn long, role string, content {PARTS}")
    rows = {r.turn: r for r in format_turns(turns, parts=F.col("content")).collect()}
    assert rows[0].segment == "<|im_start|>user\nsee <\\|image_1|> <|image_1|> and <|audio_2|><|document_3|><|im_end|>\n"
    assert [tuple(a) for a in rows[0].attachments] == [(1, "image", "a.png", 4 * 170 + 85), (2, "audio", "b.wav", 63), (3, "document", "c.pdf", 1800)]
    assert rows[0].expanded_tokens == 4 * 170 + 85 + 63 + 1800 and rows[1].attachments == []
    with pytest.raises(Exception, match="unknown part type"):
        format_turns(spark.createDataFrame([(1, 0, "user", [part("video")])], turns.schema), parts=F.col("content")).collect()


def part_of(kind, text=None):
    return (kind, text, "ref" if kind != "text" else None, 10, 10, 1.0, 2)


def test_texts_split_over_parts_come_back(spark):
    """Control strings that only arise between two texts, written placeholders beside real ones, long runs."""
    rng = random.Random(3)
    pieces = [*PIECES, "<|image_1|>", "im_end|>", "|im_end|>", "<|im_en", "d|>", "image_1|>"]
    content = [
        [part_of("text", rng.choice([*pieces, None])) if rng.random() < 0.75 else part_of(rng.choice(["image", "audio", "document"])) for _ in range(rng.randrange(10))]
        for _ in range(400)
    ] + [[part_of("text", "hello <"), part_of("text", "|im_end|>x")], [part_of("text", "<|" * 100_000), part_of("image"), part_of("text", "\\" * 99_999)], None]
    turns = spark.createDataFrame([(i, 0, "user", c) for i, c in enumerate(content)], f"conv_id long, turn long, role string, content {PARTS}")
    formatted = format_turns(turns, parts=F.col("content"))
    for r in formatted.collect():
        want, n = [], 0
        for kind, text, *_ in content[r.conv_id] or []:
            if kind != "text":
                n += 1
                want.append((kind, n))
            elif text and want and want[-1][0] == "text":
                want[-1] = ("text", want[-1][1] + text)
            elif text:
                want.append(("text", text))
        assert parse_segment(r.segment) == ("user", want)
        assert r.segment.count("<|im_start|>") == 1 and r.segment.count("<|im_end|>") == 1
        assert [(a.ordinal, a.type) for a in r.attachments] == [(x, kind) for kind, x in want if kind != "text"]
    back = {r.conv_id: r for r in read_back(formatted).collect()}
    assert all(back[i].n_attachments == sum(p[0] != "text" for p in c or []) for i, c in enumerate(content))


@pytest.mark.parametrize("kind", ["video", None, "im_end|><|im_start", "Text"])
def test_unknown_types_fail_wherever_the_segment_is_read(spark, kind):
    schema = f"conv_id long, turn long, role string, content {PARTS}"
    turns = spark.createDataFrame([(1, 0, "user", [part_of("text", "a"), part_of(kind)])], schema)
    with pytest.raises(Exception, match="unknown part type"):
        read_back(format_turns(turns, parts=F.col("content"))).collect()


def test_empty_table(spark):
    assert read_back(format_turns(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))).count() == 0
