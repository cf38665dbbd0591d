"""Near-duplicate documents by exact Jaccard similarity of their five-word shingles.

Two texts link when their shingle sets (64-bit hashes; A-Z lower-cased, words joined by one space; a
shorter text is one shingle) have a Jaccard similarity of ``LEAST`` = 0.8 or more. Candidates come from
``BANDS`` x ``ROWS`` minimum hashes: texts meet if all hashes of some band agree, so a pair at exactly
0.8 is missed with probability (1 - 0.8^4)^16 = 0.02 %, at 0.9 with 10^-7. (A 64-bit SimHash differs in
about 10 bits at 0.8, far beyond the 3 bits of ``golay_simhash``.) Every candidate pair is checked on the
sets themselves, unless its two texts are already joined.

Defined results: null text is the empty text; texts without a word have equal, empty sets and are one
group. Of each group the row that comes first by (doc_id, text digest), null ids last, stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialised
from .buckets import BLOCK, components, whole_groups

SHINGLE = 5
LEAST = 0.8
BANDS, ROWS = 16, 4
SEED = 42
HASHES_AT_ONCE = 65_536
# odd factors and offsets of the minimum hashes (fixed values)
FACTORS, OFFSETS = np.random.default_rng(SEED).integers(0, 2**64, (2, BANDS * ROWS), np.uint64)
FACTORS |= np.uint64(1)


def shingles(text: str, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles; empty without a word."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    n = max(1, len(words) - size + 1)
    begins, stops = np.r_[0, ends[: n - 1]].tolist(), (ends[-n:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(joined[a:b], SEED) for a, b in zip(begins, stops, strict=True)), np.uint64, n))


def bands(own: np.ndarray) -> list[int]:
    """Bucket of each band of a non-empty set."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for low in range(0, len(own), HASHES_AT_ONCE):
        part = own[low : low + HASHES_AT_ONCE]
        for k in range(BANDS * ROWS):
            mixed = (part ^ OFFSETS[k]) * FACTORS[k]
            mixed = (mixed ^ (mixed >> np.uint64(32))) * FACTORS[-1 - k]
            least[k] = min(least[k], mixed.min())
    rows = least.reshape(BANDS, ROWS)
    return [int(np.uint64(xxhash.xxh64_intdigest(rows[b].tobytes(), b)).astype(np.int64)) for b in range(BANDS)]


def sketched(texts: pd.Series) -> pd.DataFrame:
    """Digest of the set (the node) and buckets of each text."""
    out = []
    for text in texts:
        own = shingles(text)
        out.append((xxhash.xxh3_128_hexdigest(own.tobytes()), bands(own) if len(own) else []))
    return pd.DataFrame(out, columns=["node", "buckets"])


def met_buckets(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """``rows(bucket, node)`` of buckets with two nodes or more, in blocks: every two blocks of a bucket
    meet in one group (bucket, bi, bj); ``own`` is the row's block."""
    sizes = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    blocks = sizes.select("bucket", F.ceil(F.col("_n") / block).cast("int").alias("_n"))
    met = rows.join(blocks, "bucket").withColumn("own", F.pmod(F.xxhash64("node"), F.col("_n")).cast("int"))
    other = met.withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    return other.select("bucket", F.least("own", "_o").alias("bi"), F.greatest("own", "_o").alias("bj"), "own", "node")


def links(group: pd.DataFrame) -> Iterator[tuple[int, int]]:
    """Positions (a, b) of a spanning forest over the rows of one group whose sets are similar enough."""
    sets = [np.asarray(s, np.int64).view(np.uint64) for s in group["hashes"]]
    size = np.array([len(s) for s in sets])
    every, label = np.concatenate(sets), np.arange(len(sets))
    owner = np.repeat(label, size)
    own, same = group["own"].to_numpy(), group["bi"].iloc[0] == group["bj"].iloc[0]
    first = own == group["bi"].iloc[0]
    for i in np.flatnonzero(first):
        others = label != label[i]
        others &= np.arange(len(sets)) > i if same else ~first
        # sets of too different sizes cannot be similar
        others &= np.minimum(size, size[i]) >= LEAST * np.maximum(size, size[i])
        if not others.any():
            continue
        look = np.flatnonzero(others[owner])
        place = np.minimum(np.searchsorted(sets[i], every[look]), size[i] - 1)
        common = np.bincount(owner[look[sets[i][place] == every[look]]], minlength=len(sets))
        for j in np.flatnonzero(others & (common >= LEAST * (size + size[i] - common) - 1e-9)):
            if label[j] != label[i]:
                label[label == label[j]] = label[i]
                yield i, j


def linked(blocked: DataFrame) -> DataFrame:
    """``blocked(bucket, bi, bj, own, node, hashes)`` -> (a, b) edges."""

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in whole_groups(batches):
            for _, group in rows.groupby(["bucket", "bi", "bj"], sort=False):
                node = group["node"].to_numpy()
                found = list(links(group))
                yield pd.DataFrame({"a": [node[i] for i, _ in found], "b": [node[j] for _, j in found]}, dtype=object)

    keys = ["bucket", "bi", "bj"]
    return blocked.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(task, "a string, b string")


def set_groups(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """(node, root) of linked nodes. ``nodes(node, key, buckets)``, ``texts(key, text)``: key is a text's digest."""
    blocked = materialised(met_buckets(nodes.select("node", F.explode("buckets").alias("bucket"))), "buckets")
    wanted = nodes.select("node", "key").join(blocked.select("node").distinct(), "node")
    hashed = F.pandas_udf(lambda s: pd.Series([shingles(t).view(np.int64) for t in s]), "array<long>")
    sets = texts.join(wanted, "key").dropDuplicates(["node"]).select("node", hashed("text").alias("hashes"))
    return materialised(components(linked(blocked.join(materialised(sets, "sets"), "node"))), "roots")


def one_per_group(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Keep one row of each group of near-duplicates, all columns as they are."""
    keyed = docs.withColumn("_key", F.md5(F.coalesce(F.col(text).cast("string"), F.lit("")))).withColumn(
        "_tie", F.xxhash64(*docs.columns)
    )
    sketch = F.pandas_udf(sketched, "node string, buckets array<long>")(F.coalesce(F.col(text).cast("string"), F.lit("")))
    order = F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("id"), "_key", "_tie")
    rows = keyed.select(order.alias("least"), F.col("_key").alias("key"), sketch.alias("_s")).select("least", "key", "_s.*")
    nodes = rows.groupBy("node").agg(F.min("least").alias("least"), F.min("key").alias("key"), F.min("buckets").alias("buckets"))
    nodes = materialised(nodes, "nodes")
    texts = keyed.select(F.col("_key").alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    placed = nodes.join(set_groups(nodes, texts), "node", "left").withColumn("root", F.coalesce("root", "node"))
    heads = placed.groupBy("root").agg(F.min("least").alias("h")).select("h.*")
    heads = heads.select(F.col("id").alias("_id"), F.col("_key").alias("_k"), F.col("_tie").alias("_t"))
    same = F.col(doc_id).eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_k")) & (F.col("_tie") == F.col("_t"))
    kept = keyed.join(heads, same, "left_semi").dropDuplicates([doc_id, "_key", "_tie"])
    return kept.drop("_key", "_tie")
