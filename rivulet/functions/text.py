"""Scalar text functions, all built from JVM-side Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must match the reference jobs.
#   page title pattern:        <title>(.+?)</title>      (group 1; default "<unknown>")
#   wiki link pattern:         \[\[(.+?)\]\]             (group 1, target before "|")
#   maximum links per page:    10
#   listing price pattern:     \$[\s]*([\d]+)            (5 lowest per city and overall)
#   listing area pattern:      ([\d]+)[\s]*sqft          (10 lowest per city)
#   exclamation suffix:        !!!
#   event message separator:   " ---> ", missing link "???", missing title "null"
# ---------------------------------------------------------------------------
TITLE_PATTERN = r"<title>(.+?)</title>"
WIKI_LINK_PATTERN = r"\[\[(.+?)\]\]"
MAX_LINKS = 10
PRICE_PATTERN = r"\$[\s]*([\d]+)"
SQFT_PATTERN = r"([\d]+)[\s]*sqft"
EXCLAIM = "!!!"
UNKNOWN_TITLE = "<unknown>"

# Characters Ruby's awk-style String#split(" ") treats as separators.
_RUBY_SPACE = "[ \\t\\n\\x0B\\f\\r]+"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_words(text, mode: str = "java") -> Column:
    """Array of words of ``text`` split on a single space.

    Three tokenisers exist in the reference and disagree on empty words:

    * ``java``   -- ``String.split(" ")``: leading and inner empty words kept,
      trailing ones dropped; an all-space string gives no words, ``''`` gives
      one empty word.
    * ``python`` -- ``str.split(" ")``: every empty word kept.
    * ``ruby``   -- ``String#split(" ")``: runs of whitespace collapse, leading
      whitespace ignored, no empty words.
    """
    t = _col(text)
    if mode == "java":
        trimmed = F.rtrim(t)  # rtrim removes trailing ' ' only
        return (F.when((t != F.lit("")) & (trimmed == F.lit("")),
                       F.array().cast("array<string>"))
                .otherwise(F.split(trimmed, " ", -1)))
    if mode == "python":
        return F.split(t, " ", -1)
    if mode == "ruby":
        return F.filter(F.split(t, _RUBY_SPACE, -1), lambda w: w != F.lit(""))
    raise ValueError(f"unknown split mode {mode!r}")


def append_suffix(c, suffix: str = EXCLAIM, times: int = 1) -> Column:
    """``c`` followed by ``suffix`` ``times`` times (chained exclamation)."""
    return F.concat(_col(c), F.lit(suffix * times))


def page_title(html, pattern: str = TITLE_PATTERN,
               default: str = UNKNOWN_TITLE) -> Column:
    """First group of ``pattern`` or ``default``.

    ``.`` does not cross line breaks (Java regex), so a title spanning lines
    is not found. The group is ``.+?`` so an empty extraction means no match.
    """
    found = F.regexp_extract(_col(html), pattern, 1)
    return F.coalesce(F.nullif(found, F.lit("")), F.lit(default))


def page_links(html, pattern: str = WIKI_LINK_PATTERN,
               max_links: int = MAX_LINKS) -> Column:
    """First ``max_links`` link targets (text before the first ``|``).

    A match made only of pipes has no target and does not use up a slot.
    """
    matches = F.regexp_extract_all(_col(html), F.lit(pattern), 1)
    usable = F.filter(matches, lambda m: ~m.rlike(r"^\|*$"))
    targets = F.transform(usable, lambda m: F.substring_index(m, "|", 1))
    return F.slice(targets, 1, max_links)


def event_message(title, first_href) -> Column:
    """``title ---> href``; no link gives ``???``, no title the text ``null``."""
    return F.concat(F.coalesce(_col(title), F.lit("null")), F.lit(" ---> "),
                    F.coalesce(_col(first_href), F.lit("???")))


def regex_number(text, pattern: str = PRICE_PATTERN) -> Column:
    """First group of ``pattern`` as an int; NULL when absent or out of range."""
    return F.regexp_extract(_col(text), pattern, 1).try_cast("int")


def composite_key(*cols, sep: str = ":") -> Column:
    """Display key ``a:b:c`` (not injective; joins use the columns)."""
    return F.concat_ws(sep, *[_col(c).cast("string") for c in cols])
