"""Near-duplicates by five-word shingles against brute force."""

import random

import corpus_pipeline as cp
from conftest import SF_DIR
from llm.test_near_duplicates import union

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def brute_sets(texts):
    sets = []
    for t in texts:
        words = (t or "").lower().split()
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    return sets


def similar(a, b):
    return a == b or len(a & b) >= 0.8 * len(a | b)


def test_stage_joins_texts_with_jaccard_of_four_fifths(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("abcdefgh", k=5))
    texts = []
    for _ in range(40):
        base = [word() for _ in range(200)]
        texts.append(" ".join(base))
        for changes in (1, 3, 4, 6, 10):  # similarity from 0.95 to 0.6
            copy = list(base)
            for at in rng.sample(range(200), changes):
                copy[at] = word()
            texts.append(" ".join(copy))
    base = [word() for _ in range(60)]
    texts += [" ".join(base[:-1] + [word()]) for _ in range(700)] + ["", None, "two words", "Two  words"]  # one large bucket
    sets = brute_sets(texts)
    heads = set(union(len(texts), [(i, j) for i in range(len(texts)) for j in range(i) if similar(sets[i], sets[j])]))
    docs = spark.createDataFrame([(d, t, "en", "s", 1) for d, t in enumerate(texts)], SCHEMA)
    assert sorted(r["doc_id"] for r in cp.distinct_documents(spark, docs, SF_DIR).collect()) == sorted(heads)


def test_one_defined_row_of_each_group_stays_for_null_and_repeated_ids(spark):
    a, b, c = ("alone " * 9).strip(), " ".join(map(str, range(60))), " ".join(map(str, range(59)))
    rows = [(1, a), (1, b), (1, b), (2, c), (None, c), (None, "no id here"), (None, "no id here")]
    docs = spark.createDataFrame([(d, t, "en", "s", 1) for d, t in rows], SCHEMA)
    kept = cp.distinct_documents(spark, docs, SF_DIR)
    assert kept.columns == docs.columns
    want = [(1, a), (1, b), (None, "no id here")]
    for part in (docs, docs.repartition(5)):
        got = [(r["doc_id"], r["text"]) for r in cp.distinct_documents(spark, part, SF_DIR).collect()]
        assert sorted(got, key=repr) == sorted(want, key=repr)
