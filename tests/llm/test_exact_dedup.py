import hashlib
import random
import re

import pytest
from llm_helpers import ODD, docs_of

from changeflow.llm.exact_dedup import exact_duplicates


def brute(rows):
    texts = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    out = []
    for (d, _), t in zip(rows, texts):
        ids = [r[0] for r, u in zip(rows, texts) if u == t]
        known = [i for i in ids if i is not None]
        out.append((d, min(known) if known else None, len(ids), hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=repr)


def check(spark, rows, block_chars):
    got = exact_duplicates(docs_of(spark, rows), block_chars=block_chars).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=repr) == brute(rows)
    by_text = {}
    for r in got:
        by_text.setdefault(r.text_sha256, []).append(r)
    for group in by_text.values():
        kept = [r for r in group if r.kept]
        assert len(kept) == 1 and kept[0].doc_id == kept[0].keep_id


@pytest.mark.parametrize("block_chars", [4, 4096])
def test_odd_rows(spark, block_chars):
    check(spark, [(d, t[:300] if t else t) for d, t in ODD], block_chars)


def test_blocks_of_all_lengths(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randrange(0, 40))) for _ in range(40)]
    check(spark, [(i, rng.choice(texts)) for i in range(120)], 3)


def test_empty_table(spark):
    assert exact_duplicates(docs_of(spark, [])).count() == 0
