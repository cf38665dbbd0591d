"""Exact token counts at every prefix of a text, for a BPE vocabulary with word ends.

A text is normalised and split as the vocabulary file says; every piece ends with a word-end mark.
Open prefixes of a piece have a unique last token (``prefix_bpe``); closing a prefix puts one token
with the mark behind an open prefix. So one table per piece holds the count of every prefix cut
inside it, and running sums over pieces hold the counts at piece ends: truncation and budget
questions are look-ups.

Null counts as the empty text (0 tokens). Rows are independent: repeated rows give repeated results,
an empty table an empty result, and result columns replace input columns of the same name.
"""

from __future__ import annotations

import json
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .prefix_bpe import Memo, PrefixBpe


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte: itself where printable, else the next free code point from 256."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class WordEndBpe(PrefixBpe):
    """Merges whose last symbol carries a mark; the mark is one private character here."""

    MARK = "\ue000"

    def __init__(self, merges: list[tuple[str, str]], vocabulary, suffix: str):
        def own(token: str) -> str:
            return token[: -len(suffix)] + self.MARK if token.endswith(suffix) and token != suffix else token

        self.merge_rank = {(own(a), own(b)): i for i, (a, b) in enumerate(merges)}
        super().__init__({own(t) for t in vocabulary}, lambda a, b: self.merge_rank.get((a, b)))

    def symbols(self, token: str) -> list[str]:
        if token.endswith(self.MARK):
            return [*token[:-2], token[-2:]]
        return list(token)

    def closing(self, piece: str, last: list, end: int) -> tuple[int, str]:
        """(start, token) of the one token with the mark that closes the first ``end`` symbols."""
        for start in range(max(0, end - self.longest), end):
            token = piece[start:end] + self.MARK
            if token in self.tokens and self.stable(None, token) and (not start or self.stable(last[start], token)):
                return start, token
        raise ValueError("a symbol is missing from the vocabulary")


class PrefixCounts:
    """Token counts of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.core = WordEndBpe(merges, model["vocab"], model["end_of_word_suffix"])
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = regex.compile(split["pattern"]["Regex"])
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.cut = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.normalise = Tokenizer.from_file(path).normalizer.normalize_str
        self.symbol = byte_symbols()
        self.full = Memo(lambda piece: self.piece_prefixes(piece)[-1])

    def shown(self, piece: str) -> str:
        """The piece's bytes as symbols."""
        return piece if piece.isascii() and piece.isprintable() else "".join(map(self.symbol.__getitem__, piece.encode()))

    def closed(self, shown: str, last: list, end: int) -> int:
        """Tokens of the first ``end`` symbols with the mark behind them."""
        start, count = self.core.closing(shown, last, end)[0], 1
        while start:
            start -= len(last[start])
            count += 1
        return count

    def piece_prefixes(self, piece: str) -> list[int]:
        """Tokens of the piece cut after its 1st, 2nd, ... character."""
        shown = self.shown(piece)
        last = self.core.table(shown)
        ends = np.cumsum([len(char.encode()) for char in piece]).tolist()
        return [self.closed(shown, last, end) for end in ends]

    def learn(self, pieces: Iterable[str]) -> None:
        """Count pieces that are not remembered, neighbours in order sharing their prefix entries."""
        fresh = sorted((self.shown(p), p) for p in self.full.unknown(pieces))
        for (shown, piece), (_, last) in zip(fresh, self.core.tables(s for s, _ in fresh), strict=True):
            self.full.put(piece, self.closed(shown, last, len(shown)))

    def normal(self, text: str) -> str:
        """Normalised text; runs of white space may stay longer, which no piece shows."""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.normalise(text)
        return text.lower()  # these characters are composed already, and each has one lower-case form

    def pieces(self, text: str) -> list[str]:
        """Pieces in order; a special string is a piece of its own and always one token."""
        if self.cut is None or not any(s in text for s in self.special):
            return self.pattern.findall(self.normal(text))
        out, at = [], 0
        for match in self.cut.finditer(text):
            out += self.pattern.findall(self.normal(text[at : match.start()]))
            out.append(match.group())
            at = match.end()
        return out + self.pattern.findall(self.normal(text[at:]))

    def counts(self, text: str) -> np.ndarray:
        """Exact token count after each piece."""
        return self.counts_all([text])[0]

    def counts_all(self, texts: Iterable[str]) -> list[np.ndarray]:
        """``counts`` of every text."""
        texts, known = list(texts), dict.fromkeys(self.special, 1)
        split = [self.pieces(text) for text in texts]
        self.learn(set().union(*split) - known.keys())
        out = []
        for text, pieces in zip(texts, split, strict=True):
            special = any(s in text for s in known)
            each = (known.get(p) or self.full[p] for p in pieces) if special else map(self.full.__getitem__, pieces)
            out.append(np.cumsum(np.fromiter(each, np.int32, len(pieces)), dtype=np.int32))
        return out


@lru_cache(maxsize=4)
def prefix_counts(path: str) -> PrefixCounts:
    """One vocabulary per worker process, loaded at first use."""
    return PrefixCounts(path)


class PrefixTable:
    """Counts of one text at every character of its normalised pieces: answers without encoding."""

    def __init__(self, counter: PrefixCounts, text: str):
        self.pieces = counter.pieces(text)
        self.before, self.inside, total = [], [], 0
        for piece in self.pieces:
            self.before.append(total)
            self.inside.append([1] if piece in counter.special else counter.piece_prefixes(piece))
            total += self.inside[-1][-1]
        self.total = total

    def count(self, piece: int, chars: int) -> int:
        """Tokens of the text cut ``chars`` characters into its piece number ``piece``."""
        return self.before[piece] + (self.inside[piece][chars - 1] if chars else 0)

    def within(self, budget: int) -> int:
        """Most whole pieces whose tokens fit into ``budget``."""
        return bisect_right([*self.before[1:], self.total], budget)


def with_prefix_counts(df: DataFrame, path: str, text: str = "text", out: str = "prefix_counts") -> DataFrame:
    """Add ``out``: array<int>, the exact token count after each piece of the whole text."""

    def table(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = prefix_counts(path)
        for texts in batches:
            yield pd.Series(counter.counts_all(texts), dtype=object)
        counter.full.forget()  # a worker process outlives the tasks that filled its memories
        counter.core.forget()

    return df.withColumn(out, F.pandas_udf(table, "array<int>")(F.coalesce(F.col(text).cast("string"), F.lit(""))))


def total_tokens(prefixes: Column | str) -> Column:
    """Tokens of the whole text."""
    return F.coalesce(F.try_element_at(prefixes, F.lit(-1)), F.lit(0)).cast("bigint")


def pieces_within(prefixes: Column | str, budget: int) -> Column:
    """Most whole pieces whose tokens fit into ``budget``."""
    return F.size(F.filter(prefixes, lambda n: n <= budget)).cast("bigint")
