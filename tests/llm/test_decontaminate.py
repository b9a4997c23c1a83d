import random

from llm_helpers import ODD, docs_of, shingle_set, words

from changeflow.llm.decontaminate import contamination, without_contaminated


def holds(doc, item):
    w, v = words(item), words(doc)
    if not w:
        return False
    if len(w) < 5:
        return any(v[i : i + len(w)] == w for i in range(len(v) - len(w) + 1))
    want = shingle_set(item)
    return 100 * len(want & (shingle_set(doc) if len(v) >= 5 else set())) >= 75 * len(want)


def case():
    rng = random.Random(3)
    word = lambda: f"v{rng.randrange(400)}"
    items = [(i, " ".join(word() for _ in range(rng.choice([2, 4, 5, 6, 9, 15, 30, 70, 200])))) for i in range(60)]
    items += [(None, None), (61, ""), (62, items[0][1]), (62, items[0][1])]
    docs = []
    for d in range(150):
        parts = [" ".join(word() for _ in range(rng.choice([0, 10, 100, 800])))]
        for _ in range(rng.randrange(0, 3)):
            w = words(rng.choice(items)[1])
            cut = rng.randrange(0, len(w) // 3 + 1)
            half = len(w) // 2
            # an item may be cut, spread over the document, or in capitals
            parts += [" ".join(w[cut:]).upper()] if rng.random() < 0.5 else [" ".join(w[:half]), " ".join(word() for _ in range(60)), " ".join(w[half - 4 :])]
        docs.append((d, " ".join(parts)))
    return docs + ODD, items


def test_against_brute_force(spark):
    docs, items = case()
    bench = spark.createDataFrame(items, "item_id long, text string")
    # many small blocks of items give the same as one
    got = contamination(docs_of(spark, docs), bench, per_block=7).collect()
    want = [(d, sorted({i for i, t in items if holds(text, t)})) for d, text in docs]
    assert sorted(((r.doc_id, sorted({h.item_id for h in r.hits})) for r in got), key=repr) == sorted(want, key=repr)
    left = without_contaminated(docs_of(spark, docs), bench)
    assert sorted((r.doc_id for r in left.collect()), key=repr) == sorted((d for d, i in want if not i), key=repr)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert contamination(docs_of(spark, ODD), none).filter("size(hits) > 0").count() == 0
    assert without_contaminated(docs_of(spark, ODD), none).count() == len(ODD)
    assert contamination(docs_of(spark, []), none).count() == 0
