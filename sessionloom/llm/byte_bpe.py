"""Byte-level BPE encoding and decoding by prefix dynamic programming.

Each match of the split pattern is encoded on its own (``prefix_bpe``). Null counts as the empty
text, which has no token. Rows are independent: repeated rows give repeated results, an empty table
an empty result, and result columns replace input columns of the same name. Texts are encoded whole,
whatever their length; the memories of finished pieces are bounded and do not change results.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .prefix_bpe import Memo, PrefixBpe


class ByteBpe:
    """One vocabulary of ranks with its split pattern."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in lines if line.strip())}
        self.bytes_of = {r: t for t, r in self.ranks.items()}
        self.pattern = regex.compile(pattern)
        ranks = self.ranks
        self.core = PrefixBpe(ranks, lambda a, b: ranks.get(a + b))
        self.packed = Memo(self._packed)

    def _ids(self, tokens: list[bytes]) -> bytes:
        return array("I", map(self.ranks.__getitem__, tokens)).tobytes()

    def _packed(self, piece: str) -> bytes:
        data = piece.encode()
        whole = data in self.ranks
        return self._ids([data] if whole else self.core.backwards(self.core.table(data), len(data)))

    def learn(self, pieces: Iterable[str]) -> None:
        """Encode pieces that are not remembered, neighbours in order sharing their prefix entries."""
        fresh = sorted(p.encode() for p in self.packed.unknown(pieces))
        for data, last in self.core.tables(p for p in fresh if p not in self.ranks):
            self.packed.put(data.decode(), self._ids(self.core.backwards(last, len(data))))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.packed.__getitem__, self.pattern.findall(text)))

    def encode_all(self, texts: Iterable[str]) -> list[bytes]:
        """``encode`` of every text."""
        split = [self.pattern.findall(text) for text in texts]
        self.learn(set().union(*split))
        return [b"".join(map(self.packed.__getitem__, pieces)) for pieces in split]

    def forget(self) -> None:
        """Free the memories: a worker process outlives the tasks that filled them."""
        self.packed.forget()
        self.core.forget()

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=4)
def byte_bpe(path: str, pattern: str) -> ByteBpe:
    """One vocabulary per worker process, loaded at first use."""
    return ByteBpe(path, pattern)


class Encoding:
    """An encoded text that can be appended to and edited without encoding the rest again.

    Keeps the pieces and their ids. Matching never looks back beyond the start of a piece, so work
    restarts at the last piece touched and ends where a new piece starts at an old piece's place.
    """

    def __init__(self, bpe: ByteBpe, text: str = ""):
        self.bpe, self.text = bpe, text
        self.starts = [m.start() for m in bpe.pattern.finditer(text)]

    def ids(self) -> bytes:
        borders = [*self.starts, len(self.text)]
        return b"".join(self.bpe.packed[self.text[a:b]] for a, b in zip(borders, borders[1:], strict=False))

    def append(self, more: str) -> Encoding:
        return self.replace(len(self.text), len(self.text), more)

    def replace(self, begin: int, end: int, new: str) -> Encoding:
        """Put ``new`` in place of ``text[begin:end]``; returns self."""
        moved = len(new) - (end - begin)
        # a white-space run looks one character ahead, so the piece before the edit is redone as well
        keep = max(0, int(np.searchsorted(self.starts, begin, "left")) - 1)
        at = self.starts[keep] if self.starts else 0
        old = {s + moved: i for i, s in enumerate(self.starts) if s >= end}
        text = self.text[:begin] + new + self.text[end:]
        fresh, tail = [], []
        for match in self.bpe.pattern.finditer(text, at):
            if match.start() >= begin + len(new) and match.start() in old:
                tail = [s + moved for s in self.starts[old[match.start()] :]]
                break
            fresh.append(match.start())
        self.starts, self.text = self.starts[:keep] + fresh + tail, text
        return self


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", out: str = "ids") -> DataFrame:
    """Add ``out`` (binary: ids as little-endian unsigned 32-bit integers) and ``n_tokens``."""

    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = byte_bpe(path, pattern)
        for texts in batches:
            yield pd.Series(bpe.encode_all(texts), dtype=object)
        bpe.forget()

    column = F.pandas_udf(ids, "binary")(F.coalesce(F.col(text).cast("string"), F.lit("")))
    return df.withColumn(out, column).withColumn("n_tokens", (F.octet_length(out) / 4).cast("bigint"))


def decode(df: DataFrame, path: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add ``out`` (binary), the bytes the ids stand for; null ids give no bytes."""

    def back(packed: pd.Series) -> pd.Series:
        bpe = byte_bpe(path, pattern)
        return packed.map(lambda b: bpe.decode(bytes(b)))

    column = F.pandas_udf(back, "binary")(F.coalesce(F.col(ids), F.lit(b"")))
    return df.withColumn(out, column)


def round_trip(df: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``encode`` and ``decode`` in one pass over the texts: adds ids, n_tokens and decoded."""

    def both(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bpe = byte_bpe(path, pattern)
        for texts in batches:
            ids = bpe.encode_all(texts)
            yield pd.DataFrame({"ids": ids, "decoded": [bpe.decode(i) for i in ids]}, dtype=object)
        bpe.forget()

    coded = F.pandas_udf(both, "ids binary, decoded binary")(F.coalesce(F.col(text).cast("string"), F.lit("")))
    kept = [c for c in df.columns if c not in ("ids", "decoded", "n_tokens")]
    found = df.withColumn("_coded", coded).select(*kept, "_coded.ids", "_coded.decoded")
    return found.withColumn("n_tokens", (F.octet_length("ids") / 4).cast("bigint"))
