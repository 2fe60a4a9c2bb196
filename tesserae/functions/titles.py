"""Title keys: one form for all spellings of a title that name the same page."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The names of the category namespace, in any case.
CATEGORY_NAMES = ("category", "kategorie", "catégorie")


def title_key(title: Column, category: bool = False) -> Column:
    """Blank and `_` are the same and drop off at the ends, a leading `:` is
    dropped, the first letter counts in upper case; with category, a leading
    name of the category namespace is dropped too. Null and blank titles have
    the key null.
    """
    names = f"(?:(?iu:{'|'.join(CATEGORY_NAMES)})_*:_*)?" if category else ""
    bare = F.regexp_replace(F.translate(title, " ", "_"), f"^_*:?_*{names}|_+$", "")
    key = F.concat(F.upper(F.substring(bare, 1, 1)), F.substring(bare, 2, 1 << 30))
    return F.when(F.length(bare) > 0, key)


def title_key_sql(title: str, category: bool = False) -> str:
    """The same key for DuckDB."""
    names = f"(?:(?i:{'|'.join(CATEGORY_NAMES)})_*:_*)?" if category else ""
    bare = f"regexp_replace(replace({title}, ' ', '_'), '^_*:?_*{names}|_+$', '', 'g')"
    return f"(CASE WHEN length({bare}) > 0 THEN upper({bare}[1:1]) || {bare}[2:] END)"
