"""Prefix dynamic programming over byte-pair encodings.

For every prefix of a piece exactly one last token is possible: the token t that ends there,
that the merges can build, and that may stand behind the last token of the prefix before it.
Two tokens may stand side by side when the merges, run over both, give the two back. Following
last tokens backwards gives the encoding of any prefix; a longer piece only adds entries.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

# Entries of one lot of a per-process memory; results do not depend on it.
MEMO_ENTRIES = 300_000


class Memo(dict):
    """A dictionary that computes missing entries and keeps between one and two lots of the newest."""

    def __init__(self, compute, entries: int = MEMO_ENTRIES):
        super().__init__()
        self.compute, self.entries, self.older = compute, entries, {}

    def __missing__(self, key):
        value = self.older.get(key)
        return self.put(key, self.compute(key) if value is None else value)

    def put(self, key, value):
        if len(self) >= self.entries:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value

    def forget(self) -> None:
        self.clear()
        self.older = {}

    def unknown(self, keys: Iterable) -> list:
        """Those of the keys that would have to be computed."""
        return [k for k in keys if k not in self and k not in self.older]


class PrefixBpe:
    """Encodings of pieces (sequences of one-symbol strings) for one merge table.

    ``rank(a, b)`` gives the priority of joining a and b, or None. ``tokens`` holds every token.
    """

    def __init__(self, tokens, rank):
        self.tokens = tokens
        self.rank = rank
        self.longest = max(map(len, tokens), default=1)
        self._origin: dict = {}
        #: Length of the longest token by the two symbols at its end.
        self._reach: dict = {}
        for token in sorted(tokens, key=len):
            self._reach[token[-2:]] = len(token)
        self._stable = Memo(self._beside)
        #: Tokens that the merges make.
        self.usable = {token for token in tokens if self.origin(token) is not None}

    def merged(self, parts: list) -> tuple[list, tuple | None]:
        """The plain merge loop: join the best-ranked, leftmost pair until none is left.

        Also returns the last join as (rank, left, right).
        """
        rank, parts, latest = self.rank, list(parts), None
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = rank(parts[i], parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            latest = (best, parts[at], parts[at + 1])
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts, latest

    def symbols(self, token) -> list:
        return [token[i : i + 1] for i in range(len(token))]

    def origin(self, token) -> tuple | None:
        """(rank, left, right) of the join that makes the token, rank -1 for one symbol; None if merges never make it."""
        if token not in self._origin:
            symbols = self.symbols(token)
            parts, latest = self.merged(symbols)
            self._origin[token] = (-1, None, None) if len(symbols) == 1 else latest if parts == [token] else None
        return self._origin[token]

    def _beside(self, pair: tuple) -> bool:
        """Do the merges leave the two tokens as they are, side by side?

        Undo the joins of both tokens from the latest on. If the symbols that then touch could have
        been joined before the join undone, the merges would have crossed the border.
        """
        left, right = pair
        if self.rank(left, right) is not None:
            return False
        while True:
            (made, _, inner), (made_right, outer, _) = self._origin[left], self._origin[right]
            if made < 0 and made_right < 0:
                return True
            if made > made_right:
                left, limit = inner, made
            else:  # equal ranks are joined from the left, so the right one is the later
                right, limit = outer, made_right + 1
            crossing = self.rank(left, right)
            if crossing is not None and crossing < limit:
                return False

    def stable(self, left, right) -> bool:
        """May ``right`` follow ``left`` (or start a piece: left None)?"""
        return right in self.usable and (left is None or self._stable[left, right])

    def extend(self, piece, last: list) -> list:
        """Entries of ``last`` for the prefixes of ``piece`` it does not cover yet.

        ``last[k]`` is the last token of the first k symbols (``last[0]`` is None).
        """
        reach, usable, beside = self._reach, self.usable, self._stable
        for end in range(len(last), len(piece) + 1):
            start = end - 1 - len(last[-1] or "")  # the last token grown by one symbol is the likeliest
            token = piece[start:end]
            if not (start < end - 1 and token in usable and (not start or beside[last[start], token])):
                for start in range(max(0, end - reach.get(piece[end - 2 : end], 1)), end):
                    token = piece[start:end]
                    if token in usable and (not start or beside[last[start], token]):
                        break
                else:
                    raise ValueError("a symbol is missing from the vocabulary")
            last.append(token)
        return last

    def forget(self) -> None:
        self._stable.forget()

    def table(self, piece) -> list:
        return self.extend(piece, [None])

    def tables(self, pieces: Iterable) -> Iterator[tuple]:
        """(piece, its table) of pieces in ascending order; what neighbours share at the start is kept.

        The list is the same one each time: use it before the next is asked for.
        """
        last, before = [None], None
        for piece in pieces:
            if before is not None:
                shared = 0
                for a, b in zip(before, piece, strict=False):
                    if a != b:
                        break
                    shared += 1
                del last[shared + 1 :]
            before = piece
            yield piece, self.extend(piece, last)

    @staticmethod
    def backwards(last: Sequence, end: int) -> list:
        """Tokens of the prefix of length ``end``."""
        out = []
        while end:
            out.append(last[end])
            end -= len(last[end])
        return out[::-1]
