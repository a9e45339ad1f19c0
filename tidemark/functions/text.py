"""Text expressions. Matching is case-sensitive; positions count from 1."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Rich-text tokens and what replaces them, applied in this order.
RICH_TEXT_TOKENS: tuple[tuple[str, str], ...] = (
    ("<div>", ""),
    ("</div>", ""),
    ("<br>", ""),
    ("&nbsp;", ""),
    ("<ul>", " "),
    ("</li>", ""),
    ("</ul>", ""),
    ('<li style="list-style-type: disc">', " "),
    ('<ul style="list-style-type: circle">', " "),
    ('<li style="">', " "),
    ("<ol>", " "),
    ("<li>", " "),
    ("<span>", " "),
    ("</span>", " "),
    ("<b>", ""),
    ("</b>", ""),
    ("</ol>", ""),
)
# Fixed values end.


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text_length(c: Column | str) -> Column:
    """Length without trailing blanks."""
    return F.length(F.rtrim(_col(c)))


def text_before(c: Column | str, marker: str, missing: Column | None = None) -> Column:
    """Text before the first ``marker``; ``missing`` (NULL by default) when it does not occur."""
    c = _col(c)
    missing = F.lit(None).cast("string") if missing is None else missing
    return F.when(F.contains(c, F.lit(marker)), F.substring_index(c, marker, 1)).otherwise(missing)


def text_after(c: Column | str, marker: str, missing: Column | None = None) -> Column:
    """Text after the first ``marker``; ``missing`` (NULL by default) when it does not occur."""
    c = _col(c)
    missing = F.lit(None).cast("string") if missing is None else missing
    at = F.instr(c, marker)
    return F.when(at > 0, c.substr(at + F.lit(len(marker)), F.length(c))).otherwise(missing)


def text_between(c: Column | str, start: str, end: str) -> Column:
    """Text after the first ``start`` up to the next ``end`` (or to the end of the text)."""
    rest = text_after(c, start)
    return text_before(rest, end, missing=rest)


def replace_all(c: Column | str, tokens: tuple[tuple[str, str], ...]) -> Column:
    """Literal replacements in the given order."""
    return reduce(lambda acc, t: F.replace(acc, F.lit(t[0]), F.lit(t[1])), tokens, _col(c))


def plain_text(c: Column | str) -> Column:
    """Rich text without its markup tokens, trimmed."""
    return F.trim(replace_all(c, RICH_TEXT_TOKENS))


def one_line(c: Column | str) -> Column:
    """Remove carriage returns, line feeds and tabs."""
    return F.translate(_col(c), "\r\n\t", "")


def dotted_part(c: Column | str, n: int) -> Column:
    """n-th dot-separated part from the right; NULL when there are more than four parts."""
    parts = F.split(_col(c), "[.]")
    return F.when(F.size(parts) <= 4, F.try_element_at(parts, F.lit(-n)))


def email_first_name(c: Column | str) -> Column:
    return dotted_part(c, 3)


def email_last_name(c: Column | str) -> Column:
    return dotted_part(F.replace(_col(c), F.lit("@"), F.lit(".")), 3)


def initial_capital(c: Column | str) -> Column:
    """First letter upper case, all others lower case (``initcap`` would raise every word)."""
    c = _col(c)
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(c.substr(F.lit(2), F.length(c))))


def path_segment(c: Column | str, n: int) -> Column:
    """n-th segment of a slash-separated path, from 1, or from the end when negative."""
    return F.try_element_at(F.split(_col(c), "/"), F.lit(n))


def file_stem(c: Column | str) -> Column:
    """File name without folders and without its last extension."""
    return F.regexp_replace(F.substring_index(_col(c), "/", -1), r"\.[^.]*$", "")


def list_items(c: Column | str) -> Column:
    """``"[a, b]"`` or ``"a, b"`` as an array of trimmed items; blank text is an empty array."""
    bare = F.regexp_replace(_col(c), r"[\[\]'\"]", "")
    items = F.transform(F.split(bare, ","), lambda x: F.trim(x))
    return F.filter(items, lambda x: x != "")


def file_date(c: Column | str, layout: str) -> Column:
    """Snapshot date of a file name: the 8 digits after the last ``_`` minus one day.

    ``layout`` is ``ddMMyyyy`` or ``yyyyMMdd``; the result is ``yyyyMMdd`` text or ``N/A``.
    """
    digits = F.nullif(F.regexp_extract(_col(c), r"_([0-9]{8})[^_]*$", 1), F.lit(""))
    day = F.date_sub(F.try_to_date(digits, layout), 1)
    return F.coalesce(F.date_format(day, "yyyyMMdd"), F.lit("N/A"))


def blank_to(c: Column | str, value: str = "unknown") -> Column:
    """NULL and blank text become ``value``."""
    c = _col(c)
    return F.when(F.trim(F.coalesce(c, F.lit(""))) == "", F.lit(value)).otherwise(c)


def recode(c: Column | str, mapping: dict[str, str], otherwise: Column | None = None) -> Column:
    """Map listed values; the rest goes to ``otherwise`` (the value itself by default)."""
    c = _col(c)
    out = F.when(F.lit(False), c)
    for value, label in mapping.items():
        out = out.when(c == value, F.lit(label))
    return out.otherwise(c if otherwise is None else otherwise)
