"""Language models beyond the size of a broadcast."""

import random

from sessionloom.llm import language_id

SCHEMA = "doc_id long, text string, lang string"
FIGURES = ("lang_pred", "score", "entropy", "n_symbols", "rejected")


def test_a_small_language_keeps_its_grams_beside_a_large_one(spark):
    rng = random.Random(11)
    word = lambda letters: "".join(rng.choices(letters, k=rng.randint(3, 7)))
    text = lambda letters: " ".join(word(letters) for _ in range(40))
    rows = [(d, text("abcdefgh"), "aa") for d in range(240)] + [(1000 + d, text("qrstuvwxyz"), "zz") for d in range(12)]
    rows += [(5000, None, "aa"), (5001, "12 34", None), (None, "", "zz"), (5002, text("abcd"), "aa"), (5002, text("abcd"), "aa")]
    docs = spark.createDataFrame(rows, SCHEMA)
    whole = language_id.learned(docs)
    spread = language_id.learned(docs, max_grams=300)
    assert whole.languages == spread.languages == ["aa", "zz"]
    key = lambda r: (repr(r["doc_id"]), repr(r["text"]))
    want = sorted(language_id.with_language(docs, whole).collect(), key=key)
    got = sorted(language_id.with_language(docs, spread).collect(), key=key)
    assert len(got) == len(want) == len(rows)
    for a, b in zip(got, want):
        assert a.asDict().keys() == b.asDict().keys() and a["text"] == b["text"]
        for name in FIGURES:
            assert a[name] == b[name] or abs(a[name] - b[name]) < 1e-4
    assert all(r["lang_pred"] == "zz" for r in got if r["doc_id"] is not None and 1000 <= r["doc_id"] < 1012)
