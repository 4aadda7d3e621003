"""Text standardisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The word delimiters of the warehouse's INITCAP (public
# documentation) — whitespace and these characters:
#   [ ] ( ) { } / | \ < > ! ? @ " ^ # $ & ~ _ , . : ; * % + -
INITCAP_DELIMITERS = r"""[ ] ( ) { } / | \ < > ! ? @ " ^ # $ & ~ _ , . : ; * % + -""".split(" ")


def _delimiter_class() -> str:
    escaped = "".join("\\" + ch for ch in INITCAP_DELIMITERS)
    return r"\s" + escaped


def title_case(col: Column | str) -> Column:
    """Upper-case the first letter of every word, lower-case the rest.

    Spark's ``initcap`` splits on spaces only (``mary-jane`` -> ``Mary-jane``);
    here any delimiter starts a new word.  The string is cut into alternating
    delimiter / word runs, each run is capitalised, and the runs are joined
    again — one JVM-side expression, no UDF.  NULL stays NULL.
    """
    c = F.col(col) if isinstance(col, str) else col
    cls = _delimiter_class()
    runs = F.regexp_extract_all(c, F.lit(f"[{cls}]+|[^{cls}]+"), 0)
    capped = F.transform(runs, lambda t: F.concat(F.upper(F.left(t, F.lit(1))),
                                                  F.lower(F.substring(t, 2, 2147483647))))
    return F.array_join(capped, "")


def full_name(first: Column | str, last: Column | str) -> Column:
    """``first || ' ' || last``; NULL when either part is NULL (``concat``, not ``concat_ws``)."""
    f = F.col(first) if isinstance(first, str) else first
    l_ = F.col(last) if isinstance(last, str) else last
    return F.concat(f, F.lit(" "), l_)
