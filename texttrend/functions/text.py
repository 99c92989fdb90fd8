"""Text column expressions. Everything here stays inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The cleaning and token patterns, in Java regex syntax. Python's
# "\s" also covers U+001C..U+001F and all Unicode spaces, hence "(?U)" and the
# extra range. The ASCII ranges in WORD only repeat what \p{L} and \p{N} already
# cover; the regex engine tests them with a bit set, about five times faster.
URL = r"(?U)http[^\s\x1c-\x1f]+"
WHITESPACE = r"(?U)[\s\x1c-\x1f]+"
LEADING_URL = r"(?U)^[\s\x1c-\x1f]*http"
WORD = r"[a-z0-9_\p{L}\p{N}]+"
FIELD_SEPARATOR = ". "
MODEL_MAX_CHARS = 2048


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(text: Column | str) -> Column:
    """Drop URLs, collapse whitespace runs to one space, trim. NULL gives ''."""
    filled = F.coalesce(_col(text), F.lit(""))
    return F.trim(F.regexp_replace(F.regexp_replace(filled, URL, ""), WHITESPACE, " "))


def joined_fields(title: Column | str, description: Column | str, content: Column | str) -> Column:
    """The three article fields joined with '. '; missing ones count as ''."""
    return F.concat_ws(FIELD_SEPARATOR, *[F.coalesce(_col(c), F.lit("")) for c in (title, description, content)])


def article_text(title: Column | str, description: Column | str, content: Column | str) -> Column:
    return clean_text(joined_fields(title, description, content))


def may_clean_to_nothing(title: Column | str, description: Column | str, content: Column | str) -> Column:
    """True where cleaning the joined fields could leave no text at all.

    The separators survive unless a URL swallows the first of them, so the
    joined text must begin with a URL.
    """
    return joined_fields(title, description, content).rlike(LEADING_URL)


def tokenize(text: Column | str) -> Column:
    """Lower-cased words (letters, numbers, underscore) in order, as an array."""
    lowered = F.lower(F.coalesce(_col(text), F.lit("")))
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def truncate_text(text: Column | str, max_chars: int = MODEL_MAX_CHARS) -> Column:
    """The first ``max_chars`` characters, the longest input a model is given."""
    return F.substring(_col(text), 1, max_chars)


def term_starts(sorted_tokens: Column | str) -> Column:
    """Positions in a sorted token array where a new term begins."""
    s = _col(sorted_tokens)
    starts = F.filter(
        F.sequence(F.lit(0), F.size(s) - 1, F.lit(1)),
        lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)),
    )
    return F.when(F.size(s) > 0, starts)


def term_runs(sorted_tokens: Column | str, starts: Column | str) -> Column:
    """Array of (term, tf): each run of equal terms and its length."""
    s, at = _col(sorted_tokens), _col(starts)
    return F.transform(
        at,
        lambda p, j: F.struct(
            F.get(s, p).alias("term"), (F.coalesce(F.get(at, j + 1), F.size(s)) - p).alias("tf")
        ),
    )
