"""Text functions: tokens, keyword mentions, character sets, hashtags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def space_tokens(text: Column | str) -> Column:
    """Split on every single space; empty tokens are kept."""
    return F.split(_col(text), " ")


def blank_tokens(text: Column | str) -> Column:
    """Split on runs of white space, Unicode spaces too; no empty tokens."""
    return F.array_remove(F.split(_col(text), r"[\s\p{Zs}]+"), "")


def mentions_word(text: Column | str, word: str) -> Column:
    """True if the text holds ``word`` as written or all in lower case."""
    column = _col(text)
    return column.contains(F.lit(word)) | column.contains(F.lower(F.lit(word)))


def keyword_hits(text: Column | str, words: Sequence[str]) -> Column:
    """Array of the keywords that the text mentions, with nulls that stand for the others.

    Each keyword counts once per text. ``words`` is a list held by the caller,
    so it reaches the tasks as literals and no join is needed.
    """
    return F.array(*[F.when(mentions_word(text, word), F.lit(word)) for word in words])


def mentioned_words(text: Column | str, words: Sequence[str]) -> Column:
    """Array of just the keywords that the text mentions, in the order of ``words``."""
    return F.array_compact(keyword_hits(text, words))


def char_set(text: Column | str) -> Column:
    """Sorted array of the distinct characters of a text."""
    characters = F.array_remove(F.split(_col(text), ""), "")
    return F.sort_array(F.array_distinct(characters))


def shared_chars(left: Column | str, right: Column | str) -> Column:
    """Number of distinct characters that two texts have in common."""
    return F.size(F.array_intersect(char_set(left), char_set(right)))


def hashtag_list(hashtags: Column | str) -> Column:
    """Texts of an array of hashtag structs, in their order."""
    return F.transform(_col(hashtags), lambda tag: tag["text"])


def hashtags_text(hashtags: Column | str) -> Column:
    """Texts of the hashtags, sorted by bytes and joined by a pipe."""
    return F.array_join(F.sort_array(hashtag_list(hashtags)), "|")


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column
