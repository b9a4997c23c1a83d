import random
import re

from llm_helpers import LONG, ODD, docs_of

from changeflow.llm.pii import base_spans, luhn, personal_data

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(text):
    digits = lambda m: re.sub(r"\D", "", m.group(), flags=re.A)
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 12 <= len(digits(m)) <= 19 and luhn(digits(m))]
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]
    return sorted(out)


def test_base_patterns_as_written():
    rng = random.Random(5)
    alphabet = ["@", ".", "-", "+", "(", ")", " ", "a", "Z", "7", "1", "0", "25", "4111 1111 1111 1111", "a@b.co", "+1 (555) 555-0100", "é", "%", "_"]
    for _ in range(20_000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 18)))
        assert base_spans(text) == brute(text), text


def test_long_runs_take_linear_time():
    for text in ("1" * 200_000, "1." * 100_000, "a" * 200_000 + "@", "@" * 100_000, "+" * 100_000, "+1" + "(" * 100_000, "a@" * 100_000):
        base_spans(text)


def spans(row):
    return [(s.kind, s.start, s.end) for s in row.spans]


def test_bootstrapped_identifiers(spark):
    rows = [(i, f"filler é text {i} please write to user{i}@mail.example.com today") for i in range(6)]
    rows += [(10, "filler text please write to skype-handle77 today"), (11, "version build-2041x of the text")]
    got = {r.doc_id: r for r in personal_data(docs_of(spark, rows)).collect()}
    assert [k for k, *_ in spans(got[0])] == ["email"]
    text = rows[6][1]
    start = text.index("skype")
    assert spans(got[10]) == [("context", start, start + len("skype-handle77"))]
    assert spans(got[11]) == []


def test_glued_seeds_have_the_context_of_their_word(spark):
    far = "z" * 300
    for before, glued in (("write to", "({})"), ("write to", '"<{}>"'), ("write to", "mail:{}"), (f"write {far}", "{}")):
        rows = [(i, f"filler {i} please {before} {glued.format(f'user{i}@mail.example.com')} today") for i in range(6)]
        rows += [(10, f"filler text please {before} skype-handle77 today")]
        got = {r.doc_id: r for r in personal_data(docs_of(spark, rows)).collect()}
        start = rows[6][1].index("skype")
        assert spans(got[10]) == [("context", start, start + len("skype-handle77"))], (before, glued)


def test_identifiers_of_letters_only(spark):
    rows = [(i, f"filler {i} please write to user{i}@mail.example.com today") for i in range(6)]
    rows += [(10, "please write to (skypehandle) today"), (11, "skypehandle in other places"), (12, "please come to dinner"), (13, "to write today")]
    got = {r.doc_id: r for r in personal_data(docs_of(spark, rows)).collect()}
    start = rows[6][1].index("skype")
    assert spans(got[10]) == [("context", start, start + len("skypehandle"))]
    # "to" alone is not enough, and nothing is reported out of a slot
    assert all(spans(got[d]) == [] for d in (11, 12, 13))


def test_odd_rows(spark):
    rows = [*ODD, (30, LONG + " me@x.org"), (30, LONG + " me@x.org")]
    got = personal_data(docs_of(spark, rows)).collect()
    assert sorted((repr(r.doc_id), [s[1:] for s in spans(r)]) for r in got) == sorted(
        (repr(d), [(a, b) for a, _, b in brute(t or "")]) for d, t in rows
    )
    assert personal_data(docs_of(spark, [])).count() == 0
