"""Hidden Markov language model over whole texts: Baum-Welch on Spark partitions, exact scaled forward scores.

Tokens. A-Z are lower-cased; tokens are the words ``[^\\x20\\x09-\\x0D]+`` (``bytes.split`` of the UTF-8 text)
and one end token (a newline, which no word can hold). Null text is empty and has the end token only.

Model. Hidden states s emit tokens in two steps: a shape (byte length band x kind: letters, digits,
punctuation, non-ASCII, mixed; the end token has its own shape), then a word of that shape:
``P(w | s) = P(shape(w) | s) * P(w | shape(w))``. Baum-Welch learns the initial, transition and shape
emission probabilities (``STATES`` states, ``ITERATIONS`` rounds from a seeded start); the word given its
shape is the add-one estimate over all training counts, with one unknown word per shape:
``(c + 1) / (N_shape + V_shape + 1)``. The score is the exact log10 probability of the token sequence:
``log10 P_hmm(shapes) + sum log10 P(w | shape)``.

Distribution. A task splits its texts into words on their bytes with numpy and numbers the words of a block
(at most ``BLOCK`` bytes of text, at least one document); per block one row lists its distinct tokens, per document
there are its shapes and token numbers. Vocabulary counts are a Spark table (every training token, no cut-off),
joined with the distinct tokens of each block; only per-shape totals (at most 36 rows) and the states' parameters
(STATES x 36 + STATES^2 numbers) reach the driver and the tasks. Each E-step task packs documents of its
partition into lanes (longest first into the least loaded lane, documents of at most ``CHUNK`` tokens at a
time, shortest first, lanes so that steps x lanes stays near CHUNK; memory is bounded whatever the partition) and runs the scaled forward-backward recursion on all
lanes at once with numpy, a step's active lanes being the first ones; expected counts are summed by Spark over
partitions. Scores are made block by block from the block's documents and the counts of its tokens.

Defined results: null doc_id is neither learned from nor held out (held_out null); repeated rows are scored
alike and learned from as often as they stand; an empty table or one with no training rows gives the seeded
start parameters and counts of zero; extra columns are not read.
"""

from __future__ import annotations

import heapq
import math
from functools import lru_cache
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialised

STATES = 8
ITERATIONS = 8
SEED = 3
HOLD_OUT = (7, 2)  # crc32 of the decimal doc_id modulo 7 equal to 2 is held out
CHUNK = 1 << 21  # tokens packed into lanes at once: time steps x lanes stays near this
BLOCK = 16 << 20  # bytes of text whose words are numbered together
LANES = 2048
END = b"\n"
BANDS = (1, 2, 3, 4, 6, 9)  # byte lengths up to these, then longer: seven bands
KINDS = 5
SHAPES = KINDS * (len(BANDS) + 1) + 1
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_ALNUM = b"abcdefghijklmnopqrstuvwxyz0123456789"


def tokens(text: str | None) -> list[bytes]:
    """Lower-cased words of the text and the end token."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split() + [END]


@lru_cache(maxsize=1 << 16)
def shape(word: bytes) -> int:
    """Shape class of a token (memoised: frequent tokens repeat)."""
    if word == END:
        return SHAPES - 1
    band = next((k for k, most in enumerate(BANDS) if len(word) <= most), len(BANDS))
    if word.isalpha():
        kind = 0
    elif word.isdigit():
        kind = 1
    elif not word.isascii():
        kind = 3
    elif word.translate(None, _ALNUM) == word:
        kind = 2
    else:
        kind = 4
    return kind * (len(BANDS) + 1) + band


def is_held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(HOLD_OUT[0])) == HOLD_OUT[1]


# --- words of a block of texts ------------------------------------------------------------------------------

_BYTES = np.arange(256)
_LOWERED = np.frombuffer(_LOWER, np.uint8)
# one bit per class of byte; separators have none
_CLASS = np.select(
    [
        (_BYTES == 0x20) | ((_BYTES >= 0x09) & (_BYTES <= 0x0D)),
        (_LOWERED >= ord("a")) & (_LOWERED <= ord("z")),
        (_BYTES >= ord("0")) & (_BYTES <= ord("9")),
        _BYTES >= 0x80,
    ],
    [0, 1, 2, 4],
    8,
).astype(np.uint8)
# the kind of a word from the classes of its bytes, and the band from its length: as in shape()
_KIND = np.array([0, 0, 1, 4] + [3] * 4 + [2] + [4] * 3 + [3] * 4, np.uint8)
_BAND = np.array([sum(n > most for most in BANDS) for n in range(BANDS[-1] + 2)], np.uint8)


def numbered_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array, np.ndarray]:
    """(tokens of each text, shape and number of every token in order, the numbered tokens, their shapes).

    The same tokens and shapes as ``tokens`` and ``shape`` give, the end token being the last number.
    """
    texts = texts.fill_null("")
    at = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[at[0] : at[-1]]
    at -= at[0]
    cls = _CLASS[data]
    inside = cls != 0
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    full = at[1:] > at[:-1]  # neighbouring texts have no separator between them
    first[at[:-1][full]] = inside[at[:-1][full]]
    last[at[1:][full] - 1] = inside[at[1:][full] - 1]
    begin = np.flatnonzero(first)
    length = np.flatnonzero(last) + 1 - begin
    kind = _KIND[np.bitwise_or.reduceat(cls, begin)] if len(begin) else np.zeros(0, np.uint8)
    kinds = kind * (len(BANDS) + 1) + _BAND[np.minimum(length, len(_BAND) - 1)]
    offsets = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
    words = pa.Array.from_buffers(
        pa.binary(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(_LOWERED[data[inside]])]
    ).dictionary_encode()
    number, distinct = words.indices.to_numpy(), words.dictionary
    n = np.diff(np.searchsorted(begin, at)) + 1  # with the end token
    ends = np.cumsum(n) - 1
    word = np.ones(int(n.sum()), bool)
    word[ends] = False
    shapes, ids = np.full(len(word), SHAPES - 1, np.uint8), np.full(len(word), len(distinct), np.int32)
    shapes[word], ids[word] = kinds, number
    shape_of = np.full(len(distinct) + 1, SHAPES - 1, np.int32)
    shape_of[number] = kinds
    named = pa.concat_arrays([distinct, pa.array([END], pa.binary())])
    return n, shapes, ids, pa.Array.from_buffers(pa.string(), len(named), named.buffers()), shape_of


def _pieces(flat: np.ndarray, n: np.ndarray) -> pa.Array:
    """One binary value per document: its ``n`` values of ``flat``."""
    offsets = (np.concatenate([[0], np.cumsum(n)]) * flat.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(offsets), pa.py_buffer(flat)])


def _flat(values: pa.Array, dtype) -> tuple[np.ndarray, np.ndarray]:
    """The values of a binary column one after another, and how many each row has."""
    at = np.frombuffer(values.buffers()[1], np.int32)[values.offset : values.offset + len(values) + 1]
    flat = np.frombuffer(values.buffers()[2] or b"", np.uint8)[at[0] : at[-1]]
    return np.frombuffer(flat.tobytes(), dtype), np.diff(at) // np.dtype(dtype).itemsize


def _sequences(values: pa.Array) -> list[np.ndarray]:
    flat, n = _flat(values, np.uint8)
    return np.split(flat, np.cumsum(n)[:-1]) if len(n) else []


# --- forward-backward on packed lanes ---------------------------------------------------------------------


class Lanes:
    """Documents one after another in lanes, the fullest lane first, so that a step's lanes in use are the first."""

    def __init__(self, seqs: list[np.ndarray], lanes: int):
        lanes = max(1, min(lanes, len(seqs)))
        heap = [(0, lane) for lane in range(lanes)]
        place = np.empty((len(seqs), 2), np.int64)
        for j in sorted(range(len(seqs)), key=lambda j: -len(seqs[j])):
            load, lane = heapq.heappop(heap)
            place[j] = lane, load
            heapq.heappush(heap, (load + len(seqs[j]), lane))
        loads = np.empty(lanes, np.int64)
        for load, lane in heap:
            loads[lane] = load
        order = np.argsort(-loads, kind="stable")
        rank = np.empty(lanes, np.int64)
        rank[order] = np.arange(lanes)
        self.depth, self.lanes = int(loads.max()), lanes
        self.lane, self.step = rank[place[:, 0]], place[:, 1]  # of each document's first token
        by_lane = np.zeros((lanes, self.depth), np.uint8)
        for s, lane, t in zip(seqs, self.lane.tolist(), self.step.tolist(), strict=True):
            by_lane[lane, t : t + len(s)] = s
        self.obs = np.ascontiguousarray(by_lane.T)
        self.used = np.searchsorted(-loads[order], -np.arange(self.depth), side="left")  # lanes longer than t
        by_step = np.argsort(self.step, kind="stable")
        cuts = np.searchsorted(self.step[by_step], np.arange(self.depth + 1))
        self.starting = [self.lane[by_step[a:b]] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def per_document(self, values: np.ndarray) -> np.ndarray:
        """Sums of (depth, lanes) values, 0 past a lane's end, over each document."""
        flat, first = np.ascontiguousarray(values.T).ravel(), self.lane * self.depth + self.step
        order = np.argsort(first)
        out = np.empty(len(first))
        out[order] = np.add.reduceat(flat, first[order])
        return out


def forward(packed: Lanes, pi, A, B, keep: bool):
    """Scaled forward pass: per step the normalised alphas (if kept), states first, and what they were scaled by."""
    K, depth, lanes = len(pi), packed.depth, packed.lanes
    alpha = np.zeros((depth, K, lanes)) if keep else None
    scale = np.ones((depth, lanes))
    At, start = np.ascontiguousarray(A.T), pi[:, None]
    prior, seen = np.empty((K, lanes)), np.empty(K * lanes)
    a = np.zeros((K, lanes))
    for t in range(depth):
        n = int(packed.used[t])
        p, e = prior[:, :n], seen[: K * n].reshape(K, n)
        np.matmul(At, a[:, :n], out=p)
        if len(packed.starting[t]):
            p[:, packed.starting[t]] = start
        np.take(B, packed.obs[t, :n], axis=1, out=e, mode="clip")
        e *= p
        r = np.add.reduce(e, axis=0, out=scale[t, :n])
        np.reciprocal(r, out=r)
        if keep:
            a = alpha[t]
        np.multiply(e, r, out=a[:, :n])
    return alpha, scale


def log_likelihoods(seqs: list[np.ndarray], pi, A, B) -> np.ndarray:
    """Natural log probability of each shape sequence."""
    out = np.zeros(len(seqs))
    for members, lanes in chunks(seqs):
        packed = Lanes([seqs[j] for j in members], lanes)
        _, scale = forward(packed, pi, A, B, keep=False)
        out[members] = -packed.per_document(np.log(scale))
    return out


def expected_counts(seqs: list[np.ndarray], pi, A, B) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Baum-Welch counts: initial (K), transitions (K x K), emissions (K x shapes), log likelihood."""
    K, C = B.shape
    starts, moves, emits, total = np.zeros(K), np.zeros((K, K)), np.zeros((K, C)), 0.0
    for members, lanes in chunks(seqs):
        packed = Lanes([seqs[j] for j in members], lanes)
        alpha, scale = forward(packed, pi, A, B, keep=True)
        total -= float(np.log(scale).sum())
        beta, seen = np.ones((K, packed.lanes)), np.empty(K * packed.lanes)
        for t in range(packed.depth - 1, -1, -1):
            n, new = int(packed.used[t]), packed.starting[t]
            g, b = alpha[t, :, :n], beta[:, :n]
            g *= b  # alpha[t] is not needed again after step t + 1: the posteriors take its place
            if len(new):
                starts += g[:, new].sum(1)
            if t > 0:
                w = seen[: K * n].reshape(K, n)
                np.take(B, packed.obs[t, :n], axis=1, out=w, mode="clip")
                w *= b
                w *= scale[t, :n]
                if len(new):
                    w[:, new] = 0.0
                moves += alpha[t - 1, :, :n] @ w.T
                np.matmul(A, w, out=b)
                if len(new):
                    b[:, new] = 1.0
        seen_shapes = packed.obs.ravel().astype(np.intp)
        for k in range(K):
            emits[k] += np.bincount(seen_shapes, weights=alpha[:, k].ravel(), minlength=C)
    return starts, A * moves, emits, total


def chunks(seqs: list[np.ndarray]) -> Iterator[tuple[np.ndarray, int]]:
    """Documents taken together, by length: indices and lanes, so that time steps x lanes stays near CHUNK
    (a longer document alone in one lane)."""
    order = sorted(range(len(seqs)), key=lambda j: len(seqs[j]))
    members, size = [], 0
    for j in order:
        if members and size + len(seqs[j]) > CHUNK:
            yield np.array(members), max(1, min(LANES, size // max(len(seqs[members[-1]]), 1)))
            members, size = [], 0
        members.append(j)
        size += len(seqs[j])
    if members:
        yield np.array(members), max(1, min(LANES, size // max(len(seqs[members[-1]]), 1)))


def start_parameters(states: int = STATES, seed: int = SEED):
    rng = np.random.default_rng(seed)
    pi = np.full(states, 1.0 / states)
    A = rng.uniform(0.5, 1.5, (states, states))
    B = rng.uniform(0.5, 1.5, (states, SHAPES))
    return pi, A / A.sum(1, keepdims=True), B / B.sum(1, keepdims=True)


def updated(starts, moves, emits):
    """M-step with add-one counts, so that no probability is zero."""
    pi = (starts + 1) / (starts.sum() + len(starts))
    A = (moves + 1) / (moves.sum(1, keepdims=True) + moves.shape[1])
    B = (emits + 1) / (emits.sum(1, keepdims=True) + emits.shape[1])
    return pi, A, B


# --- Spark side ---------------------------------------------------------------------------------------------


def prepared(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(per document: block, doc_id, held_out, n_tokens, shapes, ids) and (per block and distinct token: of_block, pos,
    token, shape, m in training), both from one table written once. ``ids`` are the ``pos`` of the tokens in order."""
    keyed = docs.select(
        F.monotonically_increasing_id().alias("_rid"),
        F.col(doc_id).cast("long").alias("doc_id"),
        is_held_out(F.col(doc_id)).alias("held_out"),
        F.col(text).cast("string").alias("_text"),
    )
    schema = "block long, doc_id long, held_out boolean, n_tokens long, shapes binary, ids binary, words array<struct<token:string,shape:int,m:long>>"
    word_type = pa.struct([("token", pa.string()), ("shape", pa.int32()), ("m", pa.int64())])

    def block(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        n, shapes, ids, words, shape_of = numbered_words(part.column("_text"))
        learned = part.column("held_out").fill_null(True).to_numpy(zero_copy_only=False) == False  # noqa: E712
        m = np.bincount(ids[np.repeat(learned, n)], minlength=len(words))
        listed = pa.StructArray.from_arrays([words, pa.array(shape_of), pa.array(m, pa.int64())], fields=list(word_type))
        first = part.column("_rid")[0].as_py()
        names = ["block", "doc_id", "held_out", "n_tokens", "shapes", "ids", "words"]
        rows = len(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(rows, first)), part.column("doc_id"), part.column("held_out"), pa.array(n, pa.int64()),
             _pieces(shapes, n), _pieces(ids, n), pa.nulls(rows, pa.list_(word_type))],
            names,
        )
        types = (pa.int64(), pa.bool_(), pa.int64(), pa.binary(), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array([first], pa.int64()), *(pa.nulls(1, kind) for kind in types),
             pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), listed)],
            names,
        )

    def joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        return pa.Table.from_batches(parts).combine_chunks().to_batches()[0] if len(parts) > 1 else parts[0]

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, filled = [], 0
        for batch in batches:
            ends = np.cumsum(pc.binary_length(batch.column("_text").fill_null("")).to_numpy().astype(np.int64))
            at, before = 0, 0
            while at < batch.num_rows:
                to = int(np.searchsorted(ends, before + BLOCK - filled, side="right"))
                to = to if held or to > at else at + 1  # a longer document is a block of its own
                if to > at:
                    held.append(batch.slice(at, to - at))
                    filled, at, before = filled + int(ends[to - 1]) - before, to, int(ends[to - 1])
                if at < batch.num_rows:
                    yield from block(joined(held))
                    held, filled = [], 0
        if held:
            yield from block(joined(held))

    table = materialised(keyed.mapInArrow(blocks, schema), "hmm-documents")
    words = table.where("words IS NOT NULL").select(F.col("block").alias("of_block"), F.posexplode("words").alias("pos", "w")).select("of_block", "pos", "w.*")
    return table.where("shapes IS NOT NULL").drop("words"), words


def fit(per_document: DataFrame, states: int = STATES, iterations: int = ITERATIONS, seed: int = SEED):
    """Baum-Welch over the training documents; returns (pi, A, B)."""
    training = per_document.where(F.col("held_out") == F.lit(False)).select("shapes")
    params = start_parameters(states, seed)
    for _ in range(iterations):
        pi, A, B = params

        def step(batches: Iterator[pa.RecordBatch], pi=pi, A=A, B=B) -> Iterator[pa.RecordBatch]:
            seqs = [s for batch in batches for s in _sequences(batch.column("shapes"))]
            if not seqs:
                return
            starts, moves, emits, total = expected_counts(seqs, pi, A, B)
            rows = [("s", 0, j, v) for j, v in enumerate(starts)]
            rows += [("a", i, j, moves[i, j]) for i in range(len(pi)) for j in range(len(pi))]
            rows += [("b", i, j, emits[i, j]) for i in range(len(pi)) for j in range(emits.shape[1])]
            named = pd.DataFrame(rows + [("l", 0, 0, total)], columns=["part", "i", "j", "v"]).astype({"i": "int32", "j": "int32"})
            yield pa.RecordBatch.from_pandas(named, preserve_index=False)

        sums = training.mapInArrow(step, "part string, i int, j int, v double").groupBy("part", "i", "j").agg(F.sum("v").alias("v"))
        got = {(r["part"], r["i"], r["j"]): r["v"] for r in sums.collect()}  # at most states x (states + 37) + 1 rows
        if not got:
            break
        starts = np.array([got.get(("s", 0, j), 0.0) for j in range(states)])
        moves = np.array([[got.get(("a", i, j), 0.0) for j in range(states)] for i in range(states)])
        emits = np.array([[got.get(("b", i, j), 0.0) for j in range(SHAPES)] for i in range(states)])
        params = updated(starts, moves, emits)
    return params


def scored(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", states: int = STATES, iterations: int = ITERATIONS) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10)."""
    per_document, words = prepared(docs, doc_id, text)
    vocabulary = materialised(words.where("m > 0").groupBy("token", "shape").agg(F.sum("m").alias("c")), "hmm-vocabulary")
    by_shape = vocabulary.groupBy("shape").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).collect()  # at most 36 rows
    N, V = sum(r["n"] for r in by_shape), sum(r["v"] for r in by_shape)
    den = np.ones(SHAPES)
    for r in by_shape:
        den[r["shape"]] = r["n"] + r["v"] + 1
    pi, A, B = fit(per_document, states, iterations)
    counts = words.join(vocabulary.select("token", "c"), "token", "left").select("of_block", "pos", "shape", F.coalesce("c", F.lit(0)).alias("c"))

    def score(documents: pa.Table, counted: pa.Table) -> pa.Table:
        documents, counted = documents.combine_chunks(), counted.combine_chunks()
        ids, n = _flat(documents["ids"].combine_chunks(), np.int32)
        c, shape_of = np.zeros(counted.num_rows, np.int64), np.zeros(counted.num_rows, np.uint8)
        c[counted["pos"].to_numpy()] = counted["c"].to_numpy()
        shape_of[counted["pos"].to_numpy()] = counted["shape"].to_numpy()
        shapes = shape_of[ids]
        first = np.cumsum(n) - n
        base = np.log10((c + 1) / float(N + V + 1))[ids]
        word = np.log10((c + 1) / den[shape_of])[ids]
        hmm = log_likelihoods(np.split(shapes, first[1:]), pi, A, B) / math.log(10)
        return pa.table(
            {
                "doc_id": documents["doc_id"],
                "held_out": documents["held_out"],
                "n_tokens": documents["n_tokens"],
                "n_known": np.add.reduceat((c > 0).astype(np.int64)[ids], first),
                "train_tokens": np.full(len(n), N, np.int64),
                "base_score": np.add.reduceat(base, first),
                "score": hmm + np.add.reduceat(word, first),
            }
        )

    return (
        per_document.drop("shapes").groupBy("block")
        .cogroup(counts.groupBy("of_block"))
        .applyInArrow(score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    )
