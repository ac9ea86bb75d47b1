"""Text reports as rows (one line per row), formatted inside the JVM.

A report is a DataFrame of lines with the grouping key, so it can be written
by any sink; :func:`write_report` writes it in order. Nothing is assembled on
the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed report templates. The greeting-count template prints the count in
# a field of width 3 (the reference's "[%d3]" printed a literal 3; fixed).
TOPN_LINE = "[%s], %s: [%d]  with title [%s] and link [%s]."
TOPN_HEADING = ["", "**************************", " [%s] for %s"]
COUNT_LINE = '[%3d] people said "[%s]" (Hello!) in [%s].'


def topn_report(ranked: DataFrame, descr: str, group: str = "city",
                number: str = "price", title: str = "title", link: str = "link",
                rank: str = "rank") -> DataFrame:
    """``(group, rank, part, line)`` for a per-group ranking: a line per entry, and
    with the first of a group its three heading lines (``part`` 0 to 2)."""
    entry = F.format_string(TOPN_LINE, F.col(group), F.lit(descr), F.col(number),
                            F.col(title), F.col(link))
    heading = [F.format_string(h, F.col(group), F.lit(descr)) if "%" in h else F.lit(h)
               for h in TOPN_HEADING]
    row = lambda part, text: F.struct(F.lit(part).alias("part"), text.alias("line"))
    last = row(len(heading), entry)
    lines = F.when(F.col(rank) == 1, F.array(*[row(k, h) for k, h in enumerate(heading)], last))
    return ranked.select(group, rank, F.inline(lines.otherwise(F.array(last))))


def count_report(counts: DataFrame, key: str, value: str, count: str = "count",
                 template: str = COUNT_LINE) -> DataFrame:
    """``(key, line)``: one line per lookup key, zero counts included."""
    line = F.format_string(template, F.col(count), F.col(value), F.col(key))
    return counts.select(key, line.alias("line"))


def write_report(report: DataFrame, order: list[str], path: str, line: str = "line") -> None:
    """Write the lines as text in ``order``: the rows are range-partitioned by it, so
    the part files, read by name, are the report, and no task sees more than its range."""
    report.orderBy(*order).select(F.col(line).alias("value")).write.text(path)
