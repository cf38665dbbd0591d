"""Tokens, languages, lines, shards, mixing, quality and dialogues on ordinary and odd rows."""

import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as driver
from conftest import SF_DIR, assert_no_all_pairs_join, assert_same, duck
from sessionloom.llm import byte_bpe, chat_rotation, language_id, line_dedup, mixing, quality_rules, rendezvous, token_prefix
from sessionloom.llm.expected import llm_expected
from sessionloom.llm.queries import byte_vocabulary, llm_queries

VOCABULARY = byte_vocabulary()
WORDS = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    "", " ", "a" * 2000, " " * 60 + "x", "日本語 🎉 é é ́", "<|endoftext|> hi<|startoftext|>!", "ΣΑΣ İstanbul ǅ",
    "1234567 don't we'LL  ", "\n\n \t x y z", "\x00\x01 a\x0bb\x85c d", "<|ENDOFTEXT|>", "ﬀ ½ Ⅷ ٣",
]


@pytest.fixture(scope="module")
def bpe():
    return byte_bpe.byte_bpe(**VOCABULARY)


@pytest.fixture(scope="module")
def reference(bpe):
    return tiktoken.Encoding("own", pat_str=VOCABULARY["pattern"], mergeable_ranks=bpe.ranks, special_tokens={})


@pytest.fixture(scope="module")
def counter():
    return token_prefix.prefix_counts(WORDS)


@pytest.fixture(scope="module")
def words():
    return Tokenizer.from_file(WORDS)


def packed(reference, text):
    return np.array(reference.encode_ordinary(text), "<u4").tobytes()


@pytest.mark.parametrize("name", sorted(llm_expected()))
def test_query_matches_sql(name, spark):
    assert_same(driver.queries()[name](spark, SF_DIR), driver.oracle_sql()[name], duck())


@pytest.mark.parametrize("name", ["op3_rendezvous_shards", "op4_line_dedup", "op8_systematic_mix"])
def test_plans_hold_no_python_and_no_all_pairs(name, spark):
    df = llm_queries()[name](spark, SF_DIR)
    assert_no_all_pairs_join(df)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_ids_and_round_trip_of_all_documents(spark, reference):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    coded = byte_bpe.decode(byte_bpe.encode(docs, **VOCABULARY), **VOCABULARY)
    for r in coded.collect():
        assert bytes(r["ids"]) == packed(reference, r["text"]) and bytes(r["decoded"]).decode() == r["text"]
        assert r["n_tokens"] == len(r["ids"]) // 4


@settings(max_examples=150, deadline=None)
@given(st.one_of(st.text(max_size=40), st.text("ab 'ts\n", max_size=40)))
def test_ids_of_any_text(text):
    bpe = byte_bpe.byte_bpe(**VOCABULARY)
    own = tiktoken.Encoding("own", pat_str=VOCABULARY["pattern"], mergeable_ranks=bpe.ranks, special_tokens={})
    assert bpe.encode(text) == packed(own, text)


@settings(max_examples=100, deadline=None)
@given(st.text("ab' \nst1é", max_size=30), st.integers(0, 30), st.integers(0, 8), st.text("ab' \nst1é", max_size=8))
def test_appends_and_edits_equal_a_new_encoding(text, begin, length, new):
    bpe = byte_bpe.byte_bpe(**VOCABULARY)
    begin = min(begin, len(text))
    end = min(begin + length, len(text))
    assert byte_bpe.Encoding(bpe, text).append(new).ids() == bpe.encode(text + new)
    edited = byte_bpe.Encoding(bpe, text).replace(begin, end, new)
    assert edited.ids() == bpe.encode(text[:begin] + new + text[end:])


def test_every_prefix_of_a_piece_has_its_own_encoding(bpe):
    piece = b" unbelievablyuncharacteristically"
    table = bpe.core.table(piece)
    for end in range(1, len(piece) + 1):
        assert bpe.core.backwards(table, end) == bpe.core.merged(bpe.core.symbols(piece[:end]))[0]


def test_odd_rows_are_encoded(odd, none, reference):
    for r in byte_bpe.decode(byte_bpe.encode(odd, **VOCABULARY), **VOCABULARY).collect():
        assert bytes(r["ids"]) == packed(reference, r["text"] or "") and bytes(r["decoded"]) == (r["text"] or "").encode()
    both = byte_bpe.round_trip(odd, **VOCABULARY).select("ids", "decoded", "n_tokens").collect()
    assert sorted(bytes(r["ids"]) for r in both) == sorted(packed(reference, r["text"] or "") for r in odd.collect())
    assert all(bytes(r["decoded"]).decode() == reference.decode(np.frombuffer(r["ids"], "<u4").tolist()) for r in both)
    assert byte_bpe.encode(none, **VOCABULARY).count() == byte_bpe.round_trip(none, **VOCABULARY).count() == 0


@pytest.mark.parametrize("text", TEXTS)
def test_token_counts_equal_the_library(text, counter, words):
    counts = counter.counts(text)
    assert (int(counts[-1]) if len(counts) else 0) == len(words.encode(text, add_special_tokens=False).ids)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=40))
def test_token_counts_of_any_text(text):
    counts = token_prefix.prefix_counts(WORDS).counts(text)
    want = Tokenizer.from_file(WORDS) if not hasattr(test_token_counts_of_any_text, "t") else test_token_counts_of_any_text.t
    test_token_counts_of_any_text.t = want
    assert (int(counts[-1]) if len(counts) else 0) == len(want.encode(text, add_special_tokens=False).ids)


def test_prefix_counts_equal_encoding_the_prefix(counter, words):
    text = "unbelievable transformations of internationalisation"
    table = token_prefix.PrefixTable(counter, text)
    encode = lambda t: len(words.encode(t, add_special_tokens=False).ids)
    assert table.total == encode(text)
    done = 0
    for number, piece in enumerate(table.pieces):
        start = text.index(piece, done)
        for chars in range(1, len(piece) + 1):
            assert table.count(number, chars) == encode(text[: start + chars])
        done = start + len(piece)
    for budget in range(table.total + 2):
        most = table.within(budget)
        assert sum(table.inside[k][-1] for k in range(most)) <= budget
        assert most == len(table.pieces) or sum(table.inside[k][-1] for k in range(most + 1)) > budget


def test_odd_rows_are_counted(odd, none, words):
    counted = token_prefix.with_prefix_counts(odd, WORDS).withColumn("total", token_prefix.total_tokens("prefix_counts"))
    fits = counted.withColumn("fits", token_prefix.pieces_within(F.col("prefix_counts"), 10))
    for r in fits.collect():
        assert r["total"] == len(words.encode(r["text"] or "", add_special_tokens=False).ids)
        assert r["fits"] == sum(n <= 10 for n in r["prefix_counts"])
    assert token_prefix.with_prefix_counts(none, WORDS).count() == 0


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language_id.with_language(docs, language_id.learned(docs)).where(language_id.is_held_out(F.col("doc_id")))
    rows = found.select("lang", "lang_pred", "rejected", "score").collect()
    assert len(rows) > 200
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) >= 0.97
    assert not any(r["rejected"] for r in rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_predictions_use_text_only_and_foreign_text_is_rejected(spark):
    models = language_id.learned(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    strange = [(1, "щука плывёт против течения реки и никого не боится " * 5, "en"), (2, None, "en"), (3, "12 34", "fr"), (4, "", None)]
    out = language_id.with_language(spark.createDataFrame(strange, "doc_id long, text string, lang string"), models)
    rows = {r["doc_id"]: r for r in out.collect()}
    assert all(rows[i]["rejected"] for i in rows)
    assert [rows[i]["lang_pred"] for i in (2, 3, 4)] == ["und"] * 3 and rows[2]["score"] == 0


def test_models_are_distributions(documents):
    models = language_id.learned(documents)
    for context in ("the", "xqz", "  a"):
        start = sum(ord(c) << (48 - 16 * i) for i, c in enumerate(context))
        keys = np.uint64(start) + np.arange(1 << 16, dtype=np.uint64)
        assert np.allclose(np.exp(models._values(4, keys).astype(float)).sum(0), 1, atol=1e-3)


def test_counts_equal_brute_force_and_cut_off_bounds_the_model(spark, documents):
    rows = documents.where("doc_id < 40").select("lang", "text")
    want = Counter()
    for r in rows.collect():
        letters = "".join(c if c.isalpha() else " " for c in r["text"]).lower().split()
        if letters:
            stream = "   " + " ".join(letters) + " "
            want.update((r["lang"], stream[i : i + 4]) for i in range(len(stream) - 3))
    counts = language_id.gram_counts(rows).cache()
    unpack = lambda g: "".join(chr((g & (2**64 - 1)) >> s & 0xFFFF) for s in (48, 32, 16, 0))
    assert {(r["lang"], unpack(r["gram"])): r["n"] for r in counts.collect()} == dict(want)
    kept = language_id.fitting_counts(counts, 300)
    assert 0 < len(kept) <= 300 and kept["n"].min() >= max(sorted(want.values(), reverse=True)[300], 1) / 2


def test_language_of_odd_rows(odd, none):
    rows = language_id.with_language(odd, language_id.learned(odd)).collect()
    assert len(rows) == odd.count()
    assert all((r["lang_pred"] == "und") == (not any(c.isalpha() for c in r["text"] or "")) for r in rows)
    assert language_id.learned(none) is None
    assert language_id.with_language(none, None).count() == 0
    assert {r["lang_pred"] for r in language_id.with_language(odd, None).collect()} == {"und"}


def brute_lines(rows):
    """Kept lines of each row: rows are (doc_id, text), equal rows are one document."""
    docs = sorted({r for r in rows if r[1] is not None}, key=lambda r: (r[0] is not None, r[0] or 0))
    seen, gone = set(), {r: set() for r in docs}
    for row in docs:
        lines = row[1].split("\n")
        worded = [i for i, x in enumerate(lines) if x.strip("\x20\x09\x0a\x0b\x0c\x0d")]
        for a, b, c in zip(worded, worded[1:], worded[2:]):
            key = (lines[a], lines[b], lines[c])
            if key in seen:
                gone[row] |= {a, b, c}
            seen.add(key)
    return {r: "\n".join(x for i, x in enumerate(r[1].split("\n")) if i not in gone[r]) for r in docs}


def test_lines_of_odd_rows(odd, none):
    cut = line_dedup.dedup_lines(odd.withColumn("before", F.col("text")))
    assert cut.count() == odd.count()
    want = brute_lines([(r["doc_id"], r["text"]) for r in odd.collect()])
    for r in cut.collect():
        assert r["text"] == (want[r["doc_id"], r["before"]] if r["before"] is not None else None)
    assert line_dedup.dedup_lines(none).count() == 0


def test_every_distinct_line_stays_somewhere(spark):
    rng = random.Random(8)
    rows = [(d, "\n".join(rng.choice("abcde") for _ in range(rng.randint(0, 25)))) for d in range(60)]
    cut = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["text"] for r in cut} == {k[0]: v for k, v in brute_lines(rows).items()}
    assert {x for _, t in rows for x in t.split("\n")} == {x for r in cut for x in r["text"].split("\n")} | {""}


def test_shards_follow_weights_and_move_little(spark):
    weights = [1.0, 3.0, 2.0, 2.0]
    keys = spark.range(20_000).select(F.col("id").cast("string").alias("k"))
    placed = keys.select("k", rendezvous.rendezvous_shard(F.col("k"), weights).alias("a"), rendezvous.rendezvous_shard(F.col("k"), [*weights, 2.0]).alias("b"))
    rows = placed.collect()
    share = Counter(r["a"] for r in rows)
    assert all(abs(share[s] / 20_000 - w / 8) < 0.015 for s, w in enumerate(weights))
    moved = [r for r in rows if r["a"] != r["b"]]
    assert {r["b"] for r in moved} == {4} and abs(len(moved) / 20_000 - 0.2) < 0.015


def test_shards_of_odd_rows(odd, none):
    rows = rendezvous.shard_records(odd, [1.0] * 5, 1.0).collect()
    assert len(rows) == odd.count()
    for s in {r["shard"] for r in rows}:
        own = sorted(r["slot"] for r in rows if r["shard"] == s)
        assert own == list(range(len(own)))
    assert len({r["shard"] for r in rows if r["doc_id"] is None}) == 1
    assert all(r["grown_shard"] in (r["shard"], 5) for r in rows)
    assert rendezvous.shard_records(none, [1.0] * 5, 1.0).count() == 0


def test_mix_meets_targets_and_repeats_documents(odd, none, documents):
    drawn = mixing.expected_copies(documents).toPandas()
    taken = (drawn["size"] * drawn["copies"]).groupby(drawn["source"]).sum()
    want = drawn.groupby("source")["target"].first()
    assert drawn["copies"].between(0, 2).all()
    assert abs(want.sum() - 1.5 * drawn["size"].sum()) < 1e-6 * want.sum()
    assert abs(taken.sum() / want.sum() - 1) < 0.02
    mixed = mixing.mix(documents)
    assert mixed.columns == documents.columns
    counts = Counter(r["doc_id"] for r in mixed.select("doc_id").collect())
    assert counts == Counter({d: c for d, c in zip(drawn["doc_id"], drawn["copies"]) if c})
    odd_drawn = mixing.expected_copies(odd).collect()
    assert len(odd_drawn) == odd.count() and mixing.mix(odd).count() == sum(r["copies"] for r in odd_drawn)
    assert mixing.mix(none).count() == 0 and mixing.expected_copies(none).count() == 0


def test_reruns_of_the_mix_agree(documents):
    take = lambda df: sorted(map(tuple, mixing.expected_copies(df).select("doc_id", "copies").collect()))
    assert take(documents) == take(documents.repartition(7))


def brute_base(text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text) if w]
    triples = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(triples)
    hit = {i + k for i, t in enumerate(triples) if often[t] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if x.strip("\x20\x09\x0a\x0b\x0c\x0d")]
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines), len(lines) - len(set(lines)), len(hit)


@pytest.mark.parametrize("text", [*TEXTS, "a b c a b c d", "x\n\nx\n \nx", "a a a a", "a b c # é|"])
def test_base_figures(text):
    assert quality_rules.text_base(text) == brute_base(text)


def test_quality_of_odd_rows(odd, none):
    rows = quality_rules.judged(odd).collect()
    assert len(rows) == odd.count() and not any(r["kept"] and r["base_failed"] for r in rows)
    assert quality_rules.judged(none).count() == 0


def test_sketch_of_parts_adds_up_and_quantiles_are_close(spark, documents):
    figures = spark.range(0, 20_000).select(
        F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(60).alias("n_words"),
        *[(F.col("id") * 7 % 20_011).alias(r) for r in quality_rules.RULES],
    )
    whole = quality_rules.sketches(figures)
    parts = quality_rules.sketches(figures.where("symbols < 9000")).unionByName(quality_rules.sketches(figures.where("symbols >= 9000")))
    key = ["lang", "source", "rule", "band"]
    merged = parts.groupBy(*key).agg(F.sum("n").alias("n"))
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, whole.collect()))
    fence = quality_rules.thresholds(whole).first()
    exact = 15_000 + quality_rules.FENCE * 5_000 + quality_rules.RULES["symbols"][0]
    assert abs(fence["symbols_high"] / exact - 1) < 0.03


def test_thresholds_follow_the_group(spark):
    rows = [("en", "a", 0)] * 3000 + [("en", "b", s) for s in range(0, 3000)] + [(None, None, 5)] * 10
    figures = spark.createDataFrame(rows, "lang string, source string, symbols long").select(
        "*", F.lit(60).alias("n_words"), *[F.lit(0).alias(r) for r in quality_rules.RULES if r != "symbols"]
    )
    high = {(r["lang"], r["source"]): r["symbols_high"] for r in quality_rules.thresholds(quality_rules.sketches(figures)).collect()}
    assert high["en", "a"] == quality_rules.RULES["symbols"][0] and high["en", "b"] > 5_000 and (None, None) in high


def test_dialogues(spark):
    turns = [
        (1, 0, "system", "be kind"), (1, 1, "ann", "hi"), (1, 2, "bob", "hello"), (1, 3, "ann", "bye"), (1, 3, "ann", "bye"),
        (None, 0, "ann", "alone"), (None, 0, "ann", "alone too"), (2, None, None, None), (3, 0, "system", "only"), (4, 70, "ann", ""),
    ]
    table = spark.createDataFrame([(*t, 1) for t in turns], "conv_id long, turn int, role string, text string, part int")
    rows = {(r["conv_id"], r["speaker"], r["part"], r["rendered"]): r for r in chat_rotation.perspectives(table).collect()}
    ann = next(r for k, r in rows.items() if k[:2] == (1, "ann"))
    assert ann["rendered"] == (
        "<|system|>\nbe kind\n<|end|>\n<|assistant|>\nhi\n<|end|>\n<|user name=bob|>\nhello\n<|end|>\n<|assistant|>\nbye\n<|end|>\n"
    )
    spans = [tuple(map(int, s.split("-"))) for s in ann["mask"].split(",")]
    assert [ann["rendered"][a:b] for a, b in spans] == ["hi", "bye"] and ann["n_masked"] == 5
    assert len([k for k in rows if k[0] is None]) == 2
    assert {(k[1], k[2]) for k in rows if k[0] == 2} == {("unknown", None)}
    assert not [k for k in rows if k[0] == 3] and {k[2] for k in rows if k[0] == 4} == {1}
    assert chat_rotation.perspectives(table.limit(0)).count() == 0
