"""Out-of-process sentence splitter.

The reference runs its tokeniser in a Python (or Ruby) subprocess that speaks
JSON over stdio. Spark ships Arrow batches of rows to Python workers next to each
executor and reads rows back: :func:`split_words_batches` splits whole batches
and flattens the lists, :class:`SplitSentence` is the row-at-a-time form, a Python
table function. The built-in :func:`rivulet.functions.text.split_words` computes
the same in the JVM; these exist for user code that must run in Python.
"""

from __future__ import annotations

import re
import sys

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

# The UDTF runs in Python workers, which need not be able to import this
# package (it may not be shipped with --py-files): pickle this module's
# functions and classes by value so the small tokeniser travels with the plan.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_RUBY_SPACE = re.compile(r"[ \t\n\v\f\r]+")


def split_sentence(text: str, mode: str = "python") -> list[str]:
    """Pure-Python tokeniser with the three reference behaviours."""
    if mode == "python":
        return text.split(" ")
    if mode == "ruby":
        return [w for w in _RUBY_SPACE.split(text) if w]
    if mode == "java":
        if text and not text.strip(" "):
            return []
        return text.rstrip(" ").split(" ")
    raise ValueError(f"unknown split mode {mode!r}")


@udtf(returnType="word: string", useArrow=True)
class SplitSentence:
    def eval(self, text, mode):
        if text is None:
            return
        for w in split_sentence(text, mode):
            yield (w,)


def split_words_udtf(df: DataFrame, text: str = "text", mode: str = "python",
                     keep: list[str] | None = None) -> DataFrame:
    """One row per word, computed by the Python UDTF (a lateral join)."""
    keep = keep or []
    words = df.lateralJoin(SplitSentence(F.col(text).outer(), F.lit(mode)))
    return words.select(*keep, "word")


def split_lists(texts: pa.Array, mode: str = "python") -> pa.Array:
    """The words of a whole column at once, as lists (null texts stay null)."""
    texts = texts.cast(pa.large_string())
    if mode == "python":
        return pc.split_pattern(texts, " ")
    if mode == "ruby":
        # Runs of white space part words; a run at either end leaves no empty word.
        trimmed = pc.utf8_trim(texts, " \t\n\v\f\r")
        return pc.split_pattern_regex(pc.if_else(pc.equal(trimmed, ""), None, trimmed),
                                      r"[ \t\n\v\f\r]+")
    if mode == "java":
        trimmed = pc.utf8_rtrim(texts, " ")
        blank = pc.and_(pc.equal(trimmed, ""), pc.not_equal(texts, ""))
        return pc.split_pattern(pc.if_else(blank, None, trimmed), " ")
    raise ValueError(f"unknown split mode {mode!r}")


def split_words_batches(df: DataFrame, text: str = "text", mode: str = "python",
                        keep: list[str] | None = None, rows: int = 1 << 16) -> DataFrame:
    """One row per word, split batch by batch in Python workers. Words leave in
    batches of at most ``rows``, however long a text is."""
    keep = keep or []
    if mode not in ("python", "ruby", "java"):
        raise ValueError(f"unknown split mode {mode!r}")

    def run(batches):
        for batch in batches:
            lists = split_lists(batch.column(len(keep)), mode)
            words, parent = pc.list_flatten(lists), pc.list_parent_indices(lists)
            for k in range(0, len(words), rows):
                at = parent.slice(k, rows)
                yield pa.record_batch(
                    [*(c.take(at) for c in batch.columns[:-1]), words.slice(k, rows)],
                    [*keep, "word"])

    kept = "".join(f"`{c}` {df.schema[c].dataType.simpleString()}, " for c in keep)
    return df.select(*keep, text).mapInArrow(run, f"{kept}word string")
