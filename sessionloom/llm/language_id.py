"""Language identification with interpolated Kneser-Ney character models.

Text is reduced to its letters, lower-cased, with one space for whatever stands between them; a
symbol has 16 bits, so a four-gram is one 64-bit number. Spark counts the four-grams of every
training document per language; continuation counts of the lower orders, discounts and interpolation
weights follow from those counts. Models are held in arrays sorted by a 64-bit hash of the n-gram,
with the log probability for every language side by side, and sent to the workers.

Every counted four-gram is part of the models. Up to ``max_grams`` (language, four-gram) pairs they are
broadcast (about 60 bytes a gram and language); beyond that the same tables stay on Spark
(``SpreadModels``) and the grams of the texts are joined to them. Both give the same figures, but for
the rounding of the arrays to float32.

A text gets the language of the lowest cross-entropy per symbol. ``score`` is that language's share
when each language weighs exp(-cross-entropy * min(symbols, 32)). Rejection is calibrated on training
documents left out of the counts (one in ``CALIBRATE_1_IN``): their squared distance from the
language's mean is fitted as tau^2 + sigma^2 / symbols (tau at least ``LEAST_SPREAD``), and a text is
rejected if its cross-entropy lies more than ``REJECT_AT`` such deviations above the mean. A language
without such documents takes the figures of all languages together.

Defined results: null texts and texts without a letter get ``und``, score 0, and are rejected.
Training documents without a language are left out; with none at all every text gets ``und``. Ties go
to the first language in code point order. Repeated rows give repeated results; texts are read whole;
an empty table gives an empty result. Result columns replace input columns of the same name.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialised

ORDER = 4
SYMBOLS = 1 << 16
MAX_GRAMS = 1_000_000
COUNT_AT_ONCE = 1_000_000
SCORE_AT_ONCE = 500_000
CALIBRATE_1_IN = 16
REJECT_AT = 8.0
LEAST_SPREAD = 0.15  # of a language's long documents, nats: nothing within REJECT_AT times this is rejected
SCORE_SYMBOLS = 32
UNKNOWN = "und"

MIX = np.uint64(0x9E3779B97F4A7C15)  # odd, so multiplying by it is one-to-one


@lru_cache(maxsize=1)
def letter_table() -> np.ndarray:
    """Symbol of each code point: its lower-case letter folded to 16 bits; 32 for all but letters."""
    out = np.full(0x110000, 32, np.uint16)
    for point in range(0x110000):
        char = chr(point)
        if char.isalpha():
            low = ord(char.lower()[0])
            out[point] = (low if low < SYMBOLS else (low * 40503 >> 4) % 63_000 + 1_000) & 0xFFFF
    return out


def symbols(text: str) -> np.ndarray:
    """Symbols of a text: letters, single spaces between, one space at either end; empty without a letter."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    found = letter_table()[points]
    space = found == 32
    keep = ~space
    keep[1:] |= ~space[:-1]
    found = found[keep]
    if not (found != 32).any():
        return found[:0]
    found = found[1:] if found[0] == 32 else found
    found = found[:-1] if found[-1] == 32 else found
    return np.concatenate([[32], found, [32]]).astype(np.uint16)


def grams(stream: np.ndarray) -> np.ndarray:
    """Four-gram that ends at each symbol but the leading spaces of a text (see ``padded``)."""
    s = stream.astype(np.uint64)
    return s[:-3] << np.uint64(48) | s[1:-2] << np.uint64(32) | s[2:-1] << np.uint64(16) | s[3:]


def padded(text: str) -> np.ndarray:
    """Symbols with three leading spaces in all, so that every symbol has a context."""
    found = symbols(text)
    return np.concatenate([np.array([32, 32], np.uint16), found]) if len(found) else found


def gram_counts(labelled: DataFrame) -> DataFrame:
    """``labelled(lang, text)`` -> (lang, gram, n), over all rows."""

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, list[np.ndarray]] = defaultdict(list)
        waiting: dict[str, int] = defaultdict(int)

        def counted(lang: str) -> pd.DataFrame:
            value, number = np.unique(np.concatenate(held.pop(lang)), return_counts=True)
            waiting[lang] = 0
            return pd.DataFrame({"lang": lang, "gram": value.view(np.int64), "n": number})

        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"], strict=True):
                stream = padded(text)
                for low in range(0, max(0, len(stream) - 3), COUNT_AT_ONCE):
                    part = grams(stream[low : low + COUNT_AT_ONCE + 3])
                    held[lang].append(part)
                    waiting[lang] += len(part)
                    if waiting[lang] >= COUNT_AT_ONCE:
                        yield counted(lang)
        for lang in list(held):
            yield counted(lang)

    found = labelled.mapInPandas(task, "lang string, gram long, n long")
    return found.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def fitting_counts(counts: DataFrame, max_grams: int) -> pd.DataFrame:
    """The counts at or above the smallest count with which at most ``max_grams`` rows remain.

    Makes a smaller, poorer model; ``fit`` does not use it.
    """
    by_count = counts.groupBy(F.length(F.bin("n")).alias("size")).agg(F.count(F.lit(1)).alias("rows"))
    rows, least = 0, 1
    for size, number in sorted(by_count.collect(), reverse=True):  # one row per power of two
        if rows + number > max_grams:
            least = 1 << size
            break
        rows += number
    return counts.where(F.col("n") >= least).toPandas()


def _sums(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, sums of their values and numbers of their rows."""
    names, at = np.unique(keys, return_inverse=True)
    return names, np.bincount(at, values, len(names)), np.bincount(at, minlength=len(names))


@dataclass
class HashArray:
    """Rows of float32 by 64-bit key, sorted by hash, with a table of starts by leading hash bits."""

    hashes: np.ndarray
    values: np.ndarray
    bits: int = 16
    starts: np.ndarray = field(default=None, repr=False)

    @classmethod
    def of(cls, keys: np.ndarray, values: np.ndarray) -> HashArray:
        hashes = keys * MIX
        order = np.argsort(hashes)
        bits = int(np.clip(np.ceil(np.log2(max(len(keys), 1))) + 2, 8, 22))
        return cls(hashes[order], values[order].astype(np.float32), bits)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row number of each key, -1 where absent."""
        if self.starts is None:
            lead = (self.hashes >> np.uint64(64 - self.bits)).astype(np.int64)
            self.starts = np.searchsorted(lead, np.arange((1 << self.bits) + 1)).astype(np.int32)
        out = np.full(len(keys), -1, np.int32)
        if not len(self.hashes):
            return out
        hashes = keys * MIX
        lead = (hashes >> np.uint64(64 - self.bits)).astype(np.int64)
        at, stop = self.starts[lead], self.starts[lead + 1]
        open_ = np.flatnonzero(at < stop)
        while len(open_):
            hit = self.hashes[at[open_]] == hashes[open_]
            out[open_[hit]] = at[open_[hit]]
            open_ = open_[~hit]
            at[open_] += 1
            open_ = open_[at[open_] < stop[open_]]
        return out


def discount(counts: np.ndarray) -> float:
    """Kneser-Ney discount n1 / (n1 + 2 n2), kept inside (0, 1)."""
    return discounted(int((counts == 1).sum()), int((counts == 2).sum()))


def discounted(once: int, twice: int) -> float:
    """Discount from the numbers of grams seen once and twice."""
    return float(np.clip(once / (once + 2 * twice), 0.1, 0.95)) if once else 0.5


class Models:
    """Kneser-Ney models of all languages in common hash arrays.

    ``levels[n]`` (n = 4 .. 1): log probability of the n-gram's last symbol after the others, per
    language, for every n-gram any language knows. ``backs[n]``: log weight that a context of n - 1
    symbols leaves to the lower order (0 where a language does not know the context).
    """

    def __init__(self, counts: pd.DataFrame):
        self.languages = sorted(counts["lang"].unique())
        self.levels: dict[int, HashArray] = {}
        self.backs: dict[int, HashArray] = {}
        self.limits = {}
        size = len(self.languages)
        own = {}  # order -> language -> (keys, counts)
        for i, lang in enumerate(self.languages):
            rows = counts[counts["lang"] == lang]
            keys, n = rows["gram"].to_numpy().view(np.uint64), rows["n"].to_numpy().astype(float)
            own[ORDER, i] = keys, n
            for order in range(ORDER - 1, 0, -1):
                # types of the higher order by their last symbols: continuation counts
                keys, _, types = _sums(keys & np.uint64((1 << 16 * order) - 1), np.ones(len(keys)))
                own[order, i] = keys, types.astype(float)
        below: HashArray | None = None
        for order in range(1, ORDER + 1):
            every = np.unique(np.concatenate([own[order, i][0] for i in range(size)]))
            contexts = np.unique(every >> np.uint64(16))
            value, back = np.zeros((len(every), size)), np.zeros((len(contexts), size))
            lower = np.full((len(every), size), 1.0 / SYMBOLS)
            if below is not None:
                lower = np.exp(self._values(order - 1, every & np.uint64((1 << 16 * (order - 1)) - 1)))
            for i in range(size):
                keys, n = own[order, i]
                cut = discount(n)
                names, total, types = _sums(keys >> np.uint64(16), n)
                rest = cut * types / total
                place = np.searchsorted(contexts, names)
                weight = np.ones(len(contexts))
                weight[place] = rest
                back[:, i] = np.log(weight)
                share = np.zeros(len(every))
                share[np.searchsorted(every, keys)] = (n - cut) / total[np.searchsorted(names, keys >> np.uint64(16))]
                value[:, i] = np.log(share + weight[np.searchsorted(contexts, every >> np.uint64(16))] * lower[:, i])
            self.levels[order] = below = HashArray.of(every, value)
            self.backs[order] = HashArray.of(contexts, back)

    def _values(self, order: int, keys: np.ndarray) -> np.ndarray:
        """Log probabilities (float32, one column per language) of n-grams of this order, seen or not."""
        if order == 0:
            return np.full((len(keys), len(self.languages)), -np.log(SYMBOLS), np.float32)
        level = self.levels[order]
        at = level.find(keys)
        out = level.values[at] if len(level.values) else np.zeros((len(keys), len(self.languages)), np.float32)
        missing = np.flatnonzero(at < 0)
        if len(missing):
            rest = keys[missing]
            low = self._values(order - 1, rest & np.uint64((1 << 16 * (order - 1)) - 1))
            context = self.backs[order].find(rest >> np.uint64(16))
            known = context >= 0
            low[known] += self.backs[order].values[context[known]]
            out[missing] = low
        return out

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per symbol (nats) of each text and language, and the numbers of symbols."""
        total = np.zeros((len(texts), len(self.languages)))
        number = np.zeros(len(texts), np.int64)
        held: list[np.ndarray] = []
        owner: list[tuple[int, int]] = []
        waiting = 0

        def score() -> None:
            if held:
                value = self._values(ORDER, np.concatenate(held)).astype(np.float64)
                starts = np.cumsum([0, *(n for _, n in owner[:-1])])
                np.add.at(total, [t for t, _ in owner], np.add.reduceat(value, starts, axis=0))
            held.clear(), owner.clear()

        for t, text in enumerate(texts):
            stream = padded(text)
            for low in range(0, max(0, len(stream) - 3), SCORE_AT_ONCE):
                part = grams(stream[low : low + SCORE_AT_ONCE + 3])
                held.append(part)
                owner.append((t, len(part)))
                number[t] += len(part)
                waiting += len(part)
                if waiting >= SCORE_AT_ONCE:
                    score()
                    waiting = 0
        score()
        return -total / np.maximum(number, 1)[:, None], number


class SpreadModels:
    """The figures of ``Models`` as tables on Spark, for any number of grams.

    ``shares[n]`` (n = 4 .. 1; key, s0, s1, ...): discounted share of the n-gram in its context, per
    language. ``weights[n]`` (key, w0, w1, ...): weight that a context of n - 1 symbols leaves to the
    lower order; null where a language does not know it, which is 1.
    """

    def __init__(self, counts: DataFrame):
        self.languages = sorted(r["lang"] for r in counts.select("lang").distinct().collect())  # one row per language
        self.limits = {}
        self.shares, self.weights = {}, {}
        own = counts.select("lang", F.col("gram").alias("key"), "n")
        for order in range(ORDER, 0, -1):
            if order < ORDER:
                last = F.col("key").bitwiseAND(F.lit((1 << 16 * order) - 1))
                own = materialised(own.groupBy("lang", last.alias("key")).agg(F.count(F.lit(1)).alias("n")), "grams")
            found = own.groupBy("lang").agg(F.count_if(F.col("n") == 1).alias("once"), F.count_if(F.col("n") == 2).alias("twice"))
            cuts = {r["lang"]: discounted(r["once"], r["twice"]) for r in found.collect()}  # one row per language
            context = F.shiftrightunsigned("key", 16)
            sums = own.groupBy("lang", context.alias("context")).agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("types"))
            by_language = lambda value: [F.max(F.when(F.col("lang") == x, value(cuts[x]))) for x in self.languages]
            weight = by_language(lambda cut: F.lit(cut) * F.col("types") / F.col("total"))
            share = by_language(lambda cut: (F.col("n") - F.lit(cut)) / F.col("total"))
            named = lambda letter, values: [v.alias(f"{letter}{i}") for i, v in enumerate(values)]
            self.weights[order] = materialised(sums.groupBy(F.col("context").alias("key")).agg(*named("w", weight)), "weights")
            joined = own.withColumn("context", context).join(sums, ["lang", "context"])
            self.shares[order] = materialised(joined.groupBy("key").agg(*named("s", share)), "shares")

    def log_probabilities(self, wanted: DataFrame) -> DataFrame:
        """``wanted(gram)``, distinct -> gram, p0, p1, ...: log probability of the last symbol after the others."""
        out = wanted.withColumns({f"p{i}": F.lit(1.0 / SYMBOLS) for i in range(len(self.languages))})
        for order in range(1, ORDER + 1):
            key = F.col("gram").bitwiseAND(F.lit((1 << 16 * order) - 1)) if order < ORDER else F.col("gram")
            out = out.withColumn("_key", key).withColumn("_context", F.shiftrightunsigned("_key", 16))
            # keys of one symbol are 65,536 at most, and hot
            share, weight = (F.broadcast(t) if order <= most else t for t, most in ((self.shares[order], 1), (self.weights[order], 2)))
            out = out.join(share.withColumnRenamed("key", "_key"), "_key", "left")
            out = out.join(weight.withColumnRenamed("key", "_context"), "_context", "left")
            p = lambda i: F.coalesce(f"s{i}", F.lit(0.0)) + F.coalesce(f"w{i}", F.lit(1.0)) * F.col(f"p{i}")
            out = out.select("gram", *[p(i).alias(f"p{i}") for i in range(len(self.languages))])
        return out.select("gram", *[F.log(f"p{i}").alias(f"p{i}") for i in range(len(self.languages))])

    def entropies(self, texts: DataFrame) -> DataFrame:
        """``texts(row, text)`` -> row, entropy (array, a value per language), number; rows without a letter are left out."""

        def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for row, text in zip(batch["row"], batch["text"], strict=True):
                    stream = padded(text)
                    for low in range(0, max(0, len(stream) - 3), SCORE_AT_ONCE):
                        value, n = np.unique(grams(stream[low : low + SCORE_AT_ONCE + 3]), return_counts=True)
                        yield pd.DataFrame({"row": row, "gram": value.view(np.int64), "n": n})

        held = materialised(texts.mapInPandas(task, "row long, gram long, n long"), "text-grams")
        known = materialised(self.log_probabilities(held.select("gram").distinct()), "probabilities")
        number = F.sum("n").alias("number")
        total = [F.sum(F.col("n") * F.col(f"p{i}")).alias(f"p{i}") for i in range(len(self.languages))]
        sums = held.join(known, "gram").groupBy("row").agg(number, *total)
        return sums.select("row", F.array(*[-F.col(f"p{i}") / F.col("number") for i in range(len(self.languages))]).alias("entropy"), "number")


OUT = "lang_pred string, score double, entropy double, n_symbols long, rejected boolean"


def predicted(models: Models, texts: list[str]) -> pd.DataFrame:
    return verdicts(models.languages, models.limits, *models.entropies(texts))


def verdicts(languages: list[str], limits: dict, entropy: np.ndarray, number: np.ndarray) -> pd.DataFrame:
    """Columns ``OUT`` from the cross-entropies (a column per language) and the numbers of symbols."""
    best = entropy.argmin(axis=1)
    least = entropy[np.arange(len(entropy)), best]
    weigh = np.exp(-(entropy - least[:, None]) * np.minimum(number, SCORE_SYMBOLS)[:, None])
    known = number > 0
    names = np.array([*languages], object)[best]
    if limits:
        limit = np.array([limits[name] for name in languages])[best]
        ceiling = limit[:, 0] + REJECT_AT * np.sqrt(limit[:, 1] + limit[:, 2] / np.maximum(number, 1))
    else:
        ceiling = np.full(len(entropy), np.inf)
    return pd.DataFrame(
        {
            "lang_pred": np.where(known, names, UNKNOWN),
            "score": np.where(known, 1 / weigh.sum(axis=1), 0.0),
            "entropy": np.where(known, least, 0.0),
            "n_symbols": number,
            "rejected": ~known | (least > ceiling),
        }
    )


def identified(text: Column, shared) -> Column:
    """Struct ``OUT`` for a text; ``shared`` is a broadcast of ``Models`` or None."""

    def each(texts: pd.Series) -> pd.DataFrame:
        return predicted(shared.value, list(texts))

    return F.pandas_udf(each, OUT)(F.coalesce(text.cast("string"), F.lit("")))


def fit(labelled: DataFrame, max_grams: int = MAX_GRAMS) -> Models | SpreadModels | None:
    """Models from ``labelled(lang, text)``, broadcast up to ``max_grams`` counts; None if no row has a language and a letter."""
    rows = labelled.where("lang IS NOT NULL AND text IS NOT NULL").select(F.col("lang").cast("string"), "text")
    left_out = F.pmod(F.xxhash64("text"), F.lit(CALIBRATE_1_IN)) == 0
    counts = materialised(gram_counts(rows.where(~left_out)), "grams")
    number = counts.count()
    if not number:
        return None
    models = Models(counts.toPandas()) if number <= max_grams else SpreadModels(counts)
    models.limits = limits(rows.where(left_out), models)
    return models


def own_entropies(labelled: DataFrame, models: Models | SpreadModels) -> DataFrame:
    """(lang, h, n): cross-entropy in its own language and number of symbols of each row with a known language."""
    if isinstance(models, SpreadModels):
        rows = materialised(labelled.where(F.col("lang").isin(models.languages)).withColumn("row", F.monotonically_increasing_id()), "held-back")
        place = F.array_position(F.array(*map(F.lit, models.languages)), F.col("lang")).cast("int")
        scored = rows.select("row", "lang").join(models.entropies(rows.select("row", "text")), "row")
        return scored.select("lang", F.get("entropy", place - 1).alias("h"), F.col("number").alias("n"))
    shared = labelled.sparkSession.sparkContext.broadcast(models)
    places = {name: i for i, name in enumerate(models.languages)}

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            known = batch["lang"].isin(places.keys())
            entropy, number = shared.value.entropies(list(batch["text"][known]))
            lang = batch["lang"][known].to_numpy()
            own = entropy[np.arange(len(lang)), [places[x] for x in lang]] if len(lang) else np.zeros(0)
            yield pd.DataFrame({"lang": lang, "h": own, "n": number})

    return labelled.mapInPandas(task, "lang string, h double, n long")


def limits(labelled: DataFrame, models: Models | SpreadModels) -> dict[str, tuple[float, float, float]]:
    """Per language: mean cross-entropy, tau^2 and sigma^2 of held-back documents in their own language."""
    h, x = F.col("h"), 1 / F.col("n")
    sums = {"docs": F.lit(1.0), "h": h, "hh": h * h, "x": x, "xx": x * x, "hx": h * x, "hhx": h * h * x}
    scored = own_entropies(labelled, models).where("n > 0")
    total = [F.sum(c).alias(k) for k, c in sums.items()]
    found = {r["lang"]: r for r in scored.rollup("lang").agg(*total).collect()}  # one row per language and one for all
    out = {}
    for name in models.languages:
        r = found.get(name) or found.get(None)
        if r is None or not r["docs"]:
            out[name] = (np.inf, 0.0, 0.0)  # nothing to calibrate on: never rejects
            continue
        docs, mean = r["docs"], r["h"] / r["docs"]
        y = r["hh"] - 2 * mean * r["h"] + mean * mean * docs  # sums of (h - mean)^2, alone and by 1 / n
        yx = r["hhx"] - 2 * mean * r["hx"] + mean * mean * r["x"]
        slope = (docs * yx - r["x"] * y) / max(docs * r["xx"] - r["x"] ** 2, 1e-12)
        sigma2 = max(slope, 1.0)
        out[name] = (mean, max((y - sigma2 * r["x"]) / docs, LEAST_SPREAD**2), sigma2)
    return out


def is_held_out(doc_id: Column) -> Column:
    """Documents kept out of learning: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == 2, F.lit(False))


def learned(docs: DataFrame, max_grams: int = MAX_GRAMS) -> Models | SpreadModels | None:
    """Models from the labelled documents that are not held out."""
    return fit(docs.where(~is_held_out(F.col("doc_id"))).select("lang", "text"), max_grams)


def joined_languages(docs: DataFrame, models: SpreadModels, text: str) -> DataFrame:
    """``docs`` with the struct ``OUT`` as ``_found``."""
    rows = materialised(docs.withColumn("_row", F.monotonically_increasing_id()), "rows")
    texts = rows.select(F.col("_row").alias("row"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    scored = models.entropies(texts).select(F.col("row").alias("_row"), F.col("entropy").alias("_h"), F.col("number").alias("_n"))
    languages, limit = models.languages, models.limits

    def each(entropy: pd.Series, number: pd.Series) -> pd.DataFrame:
        return verdicts(languages, limit, np.stack([*entropy]) if len(entropy) else np.zeros((0, len(languages))), number.to_numpy())

    none = F.array(*[F.lit(0.0)] * len(languages))
    found = F.pandas_udf(each, OUT)(F.coalesce("_h", none), F.coalesce("_n", F.lit(0)).cast("bigint"))
    return rows.join(scored, "_row", "left").withColumn("_found", found).drop("_row", "_h", "_n")


def with_language(docs: DataFrame, models: Models | SpreadModels | None, text: str = "text") -> DataFrame:
    """Add lang_pred, score, entropy, n_symbols and rejected."""
    names = [c.split()[0] for c in OUT.split(", ")]
    if models is None:
        nothing = {"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0), "entropy": F.lit(0.0)}
        return docs.withColumns(nothing | {"n_symbols": F.lit(0).cast("bigint"), "rejected": F.lit(True)})
    kept = [c for c in docs.columns if c not in names]
    if isinstance(models, SpreadModels):
        found = joined_languages(docs, models, text)
    else:
        shared = docs.sparkSession.sparkContext.broadcast(models)
        found = docs.withColumn("_found", identified(F.col(text), shared))
    return found.select(*kept, *[F.col(f"_found.{n}").alias(n) for n in names])
