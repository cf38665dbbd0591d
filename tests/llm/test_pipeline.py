"""The pipeline against stage-by-stage recomputation."""

from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline as cp
from conftest import SF_DIR
from sessionloom.llm import byte_bpe, language_id
from llm.test_near_duplicates import brute_fingerprint, brute_groups
from llm.test_text_operators import brute_lines, brute_base


def written(df, path):
    df.write.mode("overwrite").parquet(str(path))
    return df.sparkSession.read.parquet(str(path))


def test_stages_follow_each_other(spark, documents, tmp_path):
    docs, kept = documents, {}
    for name, stage in cp.STAGES:
        before = docs
        docs = written(stage(spark, docs, SF_DIR), tmp_path / name)
        kept[name] = (before, docs)
        if name != "byte_bpe":
            assert docs.columns == before.columns and docs.dtypes == before.dtypes

    before, after = kept["language_id"]
    found = language_id.with_language(before, language_id.learned(before)).where("NOT rejected")
    assert Counter(map(tuple, after.select("doc_id", "lang").collect())) == Counter(map(tuple, found.select("doc_id", "lang_pred").collect()))
    assert after.count() >= 0.98 * before.count()

    before, after = kept["line_dedup"]
    want = brute_lines([(r["doc_id"], r["text"]) for r in before.collect()])
    assert {r["doc_id"]: r["text"] for r in after.collect()} == {k[0]: v for k, v in want.items()}
    assert after.where(F.col("n_chars") != F.length("text")).count() == 0

    before, after = kept["simhash_dedup"]
    groups = brute_groups([(r["doc_id"], brute_fingerprint(r["text"])) for r in before.collect()])
    assert sorted(r["doc_id"] for r in after.collect()) == sorted({c for _, _, c in groups})

    before, after = kept["source_mix"]
    taken = Counter(r["doc_id"] for r in after.collect())
    texts = {r["doc_id"]: r["text"] for r in before.collect()}
    total = sum(brute_base(t)[0] for t in texts.values())
    assert max(taken.values()) <= 2 and set(taken) <= set(texts)
    assert abs(sum(brute_base(texts[d])[0] * n for d, n in taken.items()) / total - 1.5) < 0.05

    before, after = kept["byte_bpe"]
    bpe = byte_bpe.byte_bpe(**cp.byte_vocabulary())
    want = Counter((r["doc_id"], bpe.encode(r["text"])) for r in before.collect())
    assert Counter((r["doc_id"], bytes(r["ids"])) for r in after.collect()) == want

    final = cp.run(spark, SF_DIR)
    assert Counter(r["doc_id"] for r in final.collect()) == taken


def test_pipeline_of_odd_rows(spark, odd, none, tmp_path):
    for docs in (odd, none):
        for name, stage in cp.STAGES:
            docs = written(stage(spark, docs, SF_DIR), tmp_path / f"odd-{name}-{docs is odd}")
        assert "ids" in docs.columns
