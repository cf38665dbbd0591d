"""Text expressions: cleaning, keyword phrases, labels, JSON edges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import as_col

# Function words that end a keyword phrase (own default; callers may pass their own list).
STOP_WORDS = (
    "a about above after again all also am an and any are as at be because been before being below "
    "best between both but by can could did do does doing down during each few for from further get "
    "had has have having he her here hers him his how i if in into is it its itself just make me more "
    "most much my near no nor not now of off on once only or other our out over own per same she "
    "should so some such than that the their them then there these they this those through to too top "
    "under until up use using very via vs was we were what when where which while who why will with "
    "without would you your"
).split()

_BREAK = "|"
# White space as Unicode defines it; the engines' own \\s is ASCII only.
_SPACE = r"\s\x{1c}-\x{1f}\x{85}\p{Z}"


def clean_text(raw: Column | str) -> Column:
    """Runs of ``|`` become a space, whitespace (Unicode) collapses, ends are trimmed, null gives ''."""
    no_pipes = F.regexp_replace(F.coalesce(as_col(raw), F.lit("")), r"\|+", " ")
    return F.trim(F.regexp_replace(no_pipes, f"[{_SPACE}]+", " "))


def keyword_phrases(text: Column | str, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    """Distinct lower-case phrases in first-seen order.

    A phrase is a maximal run of words that are purely alphabetic, longer than two
    letters and not stop words. Punctuation, pipes, numbers, short words and stop
    words all end a phrase.
    """
    marked = F.regexp_replace(
        F.lower(F.coalesce(as_col(text), F.lit(""))), rf"[^\p{{L}}\p{{N}}{_SPACE}]+", f" {_BREAK} "
    )
    words = F.split(marked, f"[{_SPACE}]+")
    stop = list(stop_words)

    def keep(word: Column) -> Column:
        wanted = word.rlike(r"^\p{L}{3,}$")
        return wanted & ~word.isin(stop) if stop else wanted

    spaced = F.array_join(F.transform(words, lambda w: F.when(keep(w), w).otherwise(F.lit(_BREAK))), " ")
    phrases = F.split(spaced, r"[ |]*\|[ |]*")
    return F.array_distinct(F.filter(phrases, lambda p: p != ""))


def truncate(text: Column | str, limit: int = 40, mark: str = "…") -> Column:
    col = as_col(text)
    return F.when(F.length(col) > limit, F.concat(F.substring(col, 1, limit), F.lit(mark))).otherwise(col)


def title_words(text: Column) -> Column:
    """Underscores to spaces, each word capitalised."""
    return F.initcap(F.replace(text, F.lit("_"), F.lit(" ")))


def segment_label(categories: Column, keywords: Column, segment_id: Column) -> Column:
    """Up to two leading categories and the leading keyword joined by ' & ', else 'Segment <id>'."""
    parts = F.concat(
        F.transform(F.slice(F.coalesce(categories, F.array().cast("array<string>")), 1, 2), title_words),
        F.transform(F.slice(F.coalesce(keywords, F.array().cast("array<string>")), 1, 1), F.initcap),
    )
    return F.when(F.size(parts) > 0, F.array_join(parts, " & ")).otherwise(
        F.concat(F.lit("Segment "), segment_id.cast("string"))
    )


def array_to_json(col: Column | str) -> Column:
    return F.to_json(as_col(col))


def strings_from_json(col: Column | str) -> Column:
    """JSON text to array<string>; invalid text gives null."""
    return F.from_json(as_col(col), "array<string>")


def doubles_from_json(col: Column | str) -> Column:
    return F.from_json(as_col(col), "array<double>")


def title_list(col: Column | str, separator: str = " | ") -> Column:
    return F.array_join(as_col(col), separator)
