"""SimHash near-duplicates found with keys from the (23, 12) Golay code.

A fingerprint has 64 bits: a bit is 1 if it is set in over half the 64-bit hashes of the text's
shingles. Fingerprints link when at most ``MOST_BITS`` = 3 bits differ.

Candidate search. The 64 bits are cut into four segments of 16. With 3 errors or fewer, either one
segment has none and the others one each at most, or one segment has two or more and at most one
other has one. So if one segment is left out and one of two others is taken as it is, for each of the
four left out (8 tables), in some table the exact segment has no error and the remaining two have at
most one each. Those two go through the Golay code (padded to 23 bits). The code is perfect: every
word has exactly one codeword within 3 bits, and a word one bit away has that codeword within 4. A
fingerprint is indexed under (exact segment, nearest codeword of p, each codeword within 4 of q) and
looks under (exact segment, each codeword within 4 of p, nearest codeword of q): about 5.3 keys of 40
bits each way and table, and no linked pair is missed. Rows of a key are compared bit by bit
(``buckets``).

Defined results: null text is the empty text, whose fingerprint is 0 and which links like any other.
Equal fingerprints are one node, whatever their number. A component's id is its smallest non-null
doc_id (null if it has none). Repeated rows give repeated results. Extra columns are not touched;
``fingerprint`` and ``component_id`` replace columns of those names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialised
from .buckets import components, links_in_groups, shared_buckets

SHINGLE = 3
SEED = 42
MOST_BITS = 3
SEGMENT_BITS = 16
# (exact segment, p, q) of each table: for every segment left out, each of the next two as the exact one
TABLES = tuple(
    (exact, *(s for s in range(4) if s not in (out, exact))) for out in range(4) for exact in ((out + 1) % 4, (out + 2) % 4)
)
GENERATOR = 0b101011100011  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1 (fixed value)
HASHES_AT_ONCE = 65_536


def text_fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """Signed 64-bit fingerprint of the whole text: A-Z lower-cased, words joined by one space."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    n = max(1, len(words) - shingle + 1)
    begins, stops = np.r_[0, ends[: n - 1]].tolist(), (ends[-n:] - 1).tolist()
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for low in range(0, n, HASHES_AT_ONCE):
        cut = zip(begins[low : low + HASHES_AT_ONCE], stops[low : low + HASHES_AT_ONCE], strict=True)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in cut], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<i8")[0])


def with_fingerprint(df: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """Add the fingerprint as a signed long."""

    def each(texts: pd.Series) -> pd.Series:
        return pd.Series([text_fingerprint(t) for t in texts], dtype="int64")

    return df.withColumn(out, F.pandas_udf(each, "long")(F.coalesce(F.col(text).cast("string"), F.lit(""))))


def syndrome(word: int) -> int:
    """Remainder of the 23-bit word by the generator polynomial."""
    for shift in range(22, 10, -1):
        if word >> shift & 1:
            word ^= GENERATOR << (shift - 11)
    return word


@lru_cache(maxsize=1)
def golay_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per byte position the syndromes of its values; per syndrome the error patterns of weight up to 4
    (lightest first, padded with the first) and their number."""
    unit = [syndrome(1 << b) for b in range(23)]
    parts = np.zeros((3, 256), np.int64)
    for byte in range(3):
        for value in range(256):
            for bit in range(8):
                if value >> bit & 1 and byte * 8 + bit < 23:
                    parts[byte, value] ^= unit[byte * 8 + bit]
    found: list[list[int]] = [[] for _ in range(2048)]
    for weight in range(5):
        for bits in combinations(range(23), weight):
            s = 0
            for b in bits:
                s ^= unit[b]
            found[s].append(sum(1 << b for b in bits))
    most = max(map(len, found))
    near = np.array([f + f[:1] * (most - len(f)) for f in found], np.int64)
    return parts, near, np.array([len(f) for f in found])


def codewords(word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices (12 bits) of the codewords within 4 bits of each word, nearest first; which are real."""
    parts, near, number = golay_tables()
    s = parts[0][word & 255] ^ parts[1][word >> 8 & 255] ^ parts[2][word >> 16 & 255]
    return (word[:, None] ^ near[s]) >> 11, np.arange(near.shape[1]) < number[s][:, None]


def golay_keys(fingerprints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position, key, indexed) of all keys of the fingerprints."""
    bits = fingerprints.astype(np.int64).view(np.uint64)
    parts = [(bits >> np.uint64(SEGMENT_BITS * k) & np.uint64(0xFFFF)).astype(np.int64) for k in range(4)]
    decoded = [codewords(part) for part in parts]
    out = []
    for table, (exact, p, q) in enumerate(TABLES):
        start = (table << 40) | (parts[exact] << 24)
        for indexed in (True, False):
            one, many = (p, q) if indexed else (q, p)
            at, which = np.nonzero(decoded[many][1])
            single, several = decoded[one][0][at, 0], decoded[many][0][at, which]
            first, second = (single, several) if indexed else (several, single)
            out.append((at, start[at] | (first << 12) | second, np.full(len(at), indexed)))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def keyed(nodes: DataFrame) -> DataFrame:
    """``nodes(node long)`` -> rows (bucket, indexed, node) for ``buckets.shared_buckets``."""

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            node = batch["node"].to_numpy()
            at, key, indexed = golay_keys(node)
            yield pd.DataFrame({"bucket": key, "indexed": indexed, "node": node[at]})

    return nodes.mapInPandas(task, "bucket long, indexed boolean, node long")


def close(rows: pd.DataFrame, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Exact check of candidate pairs."""
    node = rows["node"].to_numpy().view(np.uint64)
    return np.bitwise_count(node[i] ^ node[j]) <= MOST_BITS


def fingerprint_groups(prints: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """``prints(doc_id, fingerprint long)`` -> one row per fingerprint: fingerprint, component_id."""
    nodes = materialised(prints.groupBy(F.col("fingerprint").alias("node")).agg(F.min(doc_id).alias("least")), "prints")
    # eight bytes make about 85 key rows: spread the nodes before their keys are made
    pieces = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    edges = links_in_groups(shared_buckets(keyed(nodes.select("node").repartition(pieces, "node"))), close, "long")
    roots = materialised(components(edges), "roots")
    placed = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    return placed.join(smallest, "root").select(F.col("node").alias("fingerprint"), "component_id")


def simhash_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id."""
    prints = with_fingerprint(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text")), "_text")
    prints = materialised(prints.drop("_text"), "fingerprints")
    placed = prints.join(fingerprint_groups(prints), "fingerprint")
    return placed.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def one_per_group(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Keep the document with the smallest id of each group, all columns as they are.

    Rows repeating that id are one document: the one whose text digest is least stays (a null text
    counts as empty), so reruns agree. Documents without an id all stay.
    """
    found = simhash_components(docs, doc_id, text)
    heads = found.where("doc_id = component_id").select(F.col("doc_id").alias("_head")).distinct()
    named = docs.join(heads, F.col(doc_id) == F.col("_head"), "left_semi")
    digest = F.sha2(F.coalesce(F.col(text).cast("string"), F.lit("")), 256)
    order = Window.partitionBy(doc_id).orderBy(digest)
    first = named.withColumn("_pick", F.row_number().over(order)).where("_pick = 1").drop("_pick")
    return first.unionByName(docs.where(F.col(doc_id).isNull()))
