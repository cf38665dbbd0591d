"""op12: the recursions against enumeration and unscaled sums, the scores against plain Python."""

import itertools
import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from sessionloom.llm import hmm_lm


def params(k, c, seed):
    rng = np.random.default_rng(seed)
    pi, A, B = rng.uniform(0.1, 1, k), rng.uniform(0.1, 1, (k, k)), rng.uniform(0.1, 1, (k, c))
    return pi / pi.sum(), A / A.sum(1, keepdims=True), B / B.sum(1, keepdims=True)


def enumerated(seq, pi, A, B):
    total = 0.0
    for path in itertools.product(range(len(pi)), repeat=len(seq)):
        p = pi[path[0]] * B[path[0], seq[0]]
        for a, b, o in zip(path, path[1:], seq[1:]):
            p *= A[a, b] * B[b, o]
        total += p
    return math.log(total)


def plain_counts(seqs, pi, A, B):
    """Unscaled forward-backward, one sequence at a time."""
    K, C = B.shape
    s, m, e, total = np.zeros(K), np.zeros((K, K)), np.zeros((K, C)), 0.0
    for seq in seqs:
        T = len(seq)
        al, be = np.zeros((T, K)), np.ones((T, K))
        al[0] = pi * B[:, seq[0]]
        for t in range(1, T):
            al[t] = (al[t - 1] @ A) * B[:, seq[t]]
        for t in range(T - 2, -1, -1):
            be[t] = A @ (B[:, seq[t + 1]] * be[t + 1])
        z = al[-1].sum()
        total += math.log(z)
        g = al * be / z
        s += g[0]
        for t in range(T):
            e[:, seq[t]] += g[t]
        for t in range(1, T):
            m += np.outer(al[t - 1], B[:, seq[t]] * be[t]) * A / z
    return s, m, e, total


def test_forward_equals_enumeration():
    pi, A, B = params(3, 5, 1)
    seqs = [np.array(s) for s in ([0], [1, 2], [4, 4, 0, 1], [2, 3, 1, 0, 4, 2], [3] * 7)]
    got = hmm_lm.log_likelihoods(seqs, pi, A, B)
    assert np.allclose(got, [enumerated(s, pi, A, B) for s in seqs], rtol=0, atol=1e-9)


def test_packed_counts_equal_one_by_one(monkeypatch):
    pi, A, B = params(4, 6, 2)
    rng = np.random.default_rng(0)
    seqs = [rng.integers(0, 6, rng.integers(1, 40)) for _ in range(57)]
    want = plain_counts(seqs, pi, A, B)
    for lanes, chunk in ((256, 1 << 20), (5, 60), (1, 10)):
        monkeypatch.setattr(hmm_lm, "LANES", lanes)
        monkeypatch.setattr(hmm_lm, "CHUNK", chunk)
        s, m, e, total = hmm_lm.expected_counts(seqs, pi, A, B)
        assert np.allclose(s, want[0]) and np.allclose(m, want[1]) and np.allclose(e, want[2])
        assert total == pytest.approx(want[3], rel=1e-12)


def brute(rows, pi, A, B):
    held = lambda d: None if d is None else zlib.crc32(str(d).encode()) % 7 == 2
    train = Counter()
    for r in rows:
        if held(r["doc_id"]) is False:
            train.update(hmm_lm.tokens(r["text"]))
    N, V = sum(train.values()), len(train)
    per_shape = Counter()
    for w, c in train.items():
        per_shape[hmm_lm.shape(w)] += c + 1
    out = []
    for r in rows:
        ws = hmm_lm.tokens(r["text"])
        base = sum(math.log10((train[w] + 1) / (N + V + 1)) for w in ws)
        word = sum(math.log10((train[w] + 1) / (per_shape[hmm_lm.shape(w)] + 1)) for w in ws)
        shapes = np.array([hmm_lm.shape(w) for w in ws])
        hmm = hmm_lm.log_likelihoods([shapes], pi, A, B)[0] / math.log(10)
        out.append((r["doc_id"], held(r["doc_id"]), len(ws), sum(train[w] > 0 for w in ws), N, base, hmm + word))
    return out


def close(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:5] == w[:5]
        assert g[5] == pytest.approx(w[5], rel=1e-9, abs=1e-9) and g[6] == pytest.approx(w[6], rel=1e-9, abs=1e-9)


def test_scores_equal_plain_python(spark, documents):
    per_document, _ = hmm_lm.prepared(documents)
    pi, A, B = hmm_lm.fit(per_document)
    got = [tuple(r) for r in hmm_lm.scored(documents).collect()]
    close(got, brute(documents.collect(), pi, A, B))
    # training raises the likelihood of held-out shapes above the seeded start
    start = hmm_lm.start_parameters()
    held = [np.array([hmm_lm.shape(w) for w in hmm_lm.tokens(r["text"])]) for r in documents.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2]
    assert hmm_lm.log_likelihoods(held, pi, A, B).sum() > hmm_lm.log_likelihoods(held, *start).sum()


def test_odd_rows(spark, odd, none):
    per_document, _ = hmm_lm.prepared(odd)
    pi, A, B = hmm_lm.fit(per_document)
    close([tuple(r) for r in hmm_lm.scored(odd).collect()], brute(odd.collect(), pi, A, B))
    assert hmm_lm.scored(none).count() == 0


def test_words_numbered_on_bytes_are_those_of_the_token_functions():
    texts = ["", None, "Ab ab", "x", "\u00c9t\u00e9 \u00e9 e\u00a0e", " \t\x0b\x0c\r\n", "12 a1 -- .a 123456789 1234567890", "end\n", "a" * 40 + "\x1cb", "ab"]
    for part in (pa.array(texts, pa.string()), pa.array(["skipped", *texts], pa.string()).slice(1), pa.array([None, ""], pa.string())):
        n, shapes, ids, words, shape_of = hmm_lm.numbered_words(part)
        want = [hmm_lm.tokens(t) for t in part.to_pylist()]
        assert n.tolist() == [len(w) for w in want]
        assert [words[i].as_py().encode() for i in ids.tolist()] == sum(want, [])
        assert shapes.tolist() == [hmm_lm.shape(w) for ws in want for w in ws] == shape_of[ids].tolist()
        assert len(set(words.to_pylist())) == len(words)


def test_scores_do_not_depend_on_the_blocks_of_the_plan(spark, documents):
    # a block's distinct tokens are joined once, not once a document
    _, words = hmm_lm.prepared(documents.coalesce(1))
    assert words.count() == words.select("token").distinct().count()
    key = lambda r: (r["doc_id"], r["n_tokens"], r["base_score"])
    one, many = (sorted(hmm_lm.scored(d, iterations=1).collect(), key=key) for d in (documents.coalesce(1), documents.repartition(7)))
    assert [r[:5] for r in one] == [r[:5] for r in many]
    assert np.allclose([r["score"] for r in one], [r["score"] for r in many], rtol=1e-9)
