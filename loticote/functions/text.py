"""Text columns: trimming, case, dictionary lookup. All expressions stay inside the JVM."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from loticote.functions import fixed_values as fixed

# Everything that counts as white space, not only the blank that trim() removes by default.
WHITESPACE = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(col: Column) -> Column:
    """Text without white space at its ends.

    ``trim`` with a list of characters copies every character it looks at and searches the list for it. Text
    that begins and ends with a visible ASCII character has nothing to strip and goes around it.
    """
    text = col.cast("string")
    ends = [F.substring(text, 1, 1), F.substring(text, -1, 1)]
    bare = ends[0].between("!", "~") & ends[1].between("!", "~")
    return F.when(bare, text).otherwise(F.trim(text, F.lit(WHITESPACE)))


def normalize_text(col: Column) -> Column:
    return F.lower(strip(col))


def upper_trim(col: Column) -> Column:
    return F.upper(strip(col))


def fold_text(col: Column) -> Column:
    """Case- and accent-insensitive key for grouping and joining: ``bè`` and ``Be`` are one group."""
    return F.collate(normalize_text(col), "UNICODE_CI_AI")


def title_case(col: Column) -> Column:
    """Capitalise every run of letters: ``l'ecole/bar`` becomes ``L'Ecole/Bar``.

    ``initcap`` only starts a new word after a blank, so it is not enough here.
    """
    runs = F.regexp_extract_all(col, F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    words = F.transform(
        runs,
        lambda run: F.concat(F.upper(F.left(run, F.lit(1))), F.lower(F.substr(run, F.lit(2)))),
    )
    return F.array_join(words, "")


def lookup(key: Column, table: Mapping[str, str]) -> Column:
    """One literal-map lookup; NULL when the key is not in the table."""
    entries = [F.lit(part) for pair in table.items() for part in pair]
    return F.try_element_at(F.create_map(*entries), key)


def standardize_type(col: Column, null_label: str | None = None) -> Column:
    """Property type at cleaning: dictionary first, otherwise the text itself with capitals."""
    key = normalize_text(col)
    label = F.initcap(F.coalesce(lookup(key, fixed.PROPERTY_TYPES), key))
    return label if null_label is None else F.coalesce(label, F.lit(null_label))


def standardize_type_at_load(col: Column) -> Column:
    """Property type at loading: the second dictionary, otherwise title case."""
    raw = strip(col)
    return F.coalesce(lookup(F.lower(raw), fixed.PROPERTY_TYPES_AT_LOAD), title_case(raw))


def standardize_offer(col: Column) -> Column:
    return upper_trim(col)


def standardize_source(col: Column) -> Column:
    raw = strip(col)
    return F.coalesce(lookup(F.lower(raw), fixed.SOURCE_NAMES), title_case(raw))


def contains_any(col: Column, words: Sequence[str]) -> Column:
    """True when the text holds any of the words, taken literally.

    One pattern instead of one test per word: the column is named once, so an expression behind
    it is not evaluated again for every word when a filter is pushed below its projection.
    """
    return col.rlike("|".join(re.escape(word) for word in words))
