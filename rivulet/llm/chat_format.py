r"""Chat formatting of conversations with typed content parts.

A turn is ``(conv_id, turn, role, parts)``; a part is a struct ``(type, text, ref,
width, height, seconds, pages)`` of type ``text``, ``image``, ``audio`` or
``document``. A visitor, one handler per type, flattens the parts in order: text is
written as it is, every other part as a placeholder, with its reference and the
number of tokens that the placeholder expands to recorded in ``attachments`` (the
k-th placeholder of the output is the k-th entry).

Template of a turn: ``<|im_start|>role\ncontent<|im_end|>\n``. Inside texts and
roles every ``<`` with any number of backslashes and a ``|`` gets one backslash
more, so ``<|`` in the output is always the template's; taking one away reverses
it. In roles ``%`` and newline become ``%25`` and ``%0A``. Two text parts side by
side of which the first ends in ``<`` and backslashes get ``<|part|>`` between.

Everything is DataFrame functions: one shuffle on ``conv_id``, a running sum of
the lengths, one row per conversation. A conversation is one output row, so it
must fit Spark's limit of a row (2 GB); all steps are linear in its length.

Nulls: a null text, role or part list is empty, a null part is left out, a part of
another or null type is a ``<|file|>`` placeholder, rows with a null ``conv_id`` are one
conversation. Rows go by turn (nulls first), then role and content; repeated rows
are turns of their own. An empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END, JOINT = "<|im_start|>", "<|im_end|>", "<|part|>"
PART = ("struct<type:string,text:string,ref:string,width:int,height:int,"
        "seconds:double,pages:int>")


@dataclass(frozen=True)
class Expansion:
    """Tokens a placeholder stands for: images by patches of ``patch`` pixels each
    way, audio by time, documents by page. Unknown sizes count as ``unknown``."""

    patch: int = 28
    per_second: float = 25.0
    per_page: int = 512
    unknown: int = 1


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(F.coalesce(role, F.lit("")), F.lit("%"), F.lit("%25")),
                            F.lit("\n"), F.lit("%0A")))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def text_part(text: Column) -> Column:
    """A part list of one text."""
    return F.array(F.named_struct(
        F.lit("type"), F.lit("text"), F.lit("text"), text.cast("string"),
        *(c for name, kind in (("ref", "string"), ("width", "int"), ("height", "int"),
                               ("seconds", "double"), ("pages", "int"))
          for c in (F.lit(name), F.lit(None).cast(kind)))))


class PartVisitor:
    """Renders a part and counts the tokens it expands to; one handler per type."""

    KINDS = ("image", "audio", "document")

    def __init__(self, expansion: Expansion):
        self.by = expansion

    def image(self, part: Column) -> Column:
        return F.ceil(part["width"] / self.by.patch) * F.ceil(part["height"] / self.by.patch)

    def audio(self, part: Column) -> Column:
        return F.ceil(part["seconds"] * self.by.per_second)

    def document(self, part: Column) -> Column:
        return part["pages"].cast("long") * self.by.per_page

    def is_text(self, part: Column) -> Column:
        return part["type"].eqNullSafe("text")

    def kind(self, part: Column) -> Column:
        return F.when(part["type"].isin(*self.KINDS), part["type"]).otherwise("file")

    def tokens(self, part: Column) -> Column:
        out = F.lit(None).cast("long")
        for name in self.KINDS:
            out = F.when(part["type"] == name, getattr(self, name)(part).cast("long")).otherwise(out)
        return F.coalesce(out, F.lit(self.by.unknown).cast("long"))

    def rendered(self, part: Column, following: Column) -> Column:
        """``following``: the next part, null behind the last."""
        text = F.coalesce(part["text"], F.lit(""))
        joint = F.when(text.rlike(r"<\\*\z") & following.isNotNull() & self.is_text(following),
                       F.lit(JOINT)).otherwise("")
        return (F.when(self.is_text(part), F.concat(escape(text), joint))
                .otherwise(F.concat(F.lit("<|"), self.kind(part), F.lit("|>"))))

    def content(self, parts: Column) -> Column:
        # One place on, with a null behind the last part; no parts stay none.
        moved = F.slice(F.concat(parts, F.array(F.lit(None).cast(PART))), F.lit(2), F.size(parts))
        return F.array_join(F.transform(
            F.arrays_zip(parts.alias("part"), moved.alias("following")),
            lambda z: self.rendered(z["part"], z["following"])), "")

    def attachments(self, parts: Column) -> Column:
        return F.transform(F.filter(parts, lambda p: ~self.is_text(p)),
                           lambda p: F.struct(self.kind(p).alias("kind"), p["ref"].alias("ref"),
                                              self.tokens(p).alias("tokens")))


def format_conversations(turns: DataFrame, loss_roles: tuple[str, ...] = ("assistant",),
                         expansion: Expansion = Expansion()) -> DataFrame:
    """One row per conversation: ``formatted``; ``spans``, for every turn its start
    and length in it and the part under the loss mask (code points; length 0
    outside ``loss_roles``); ``attachments`` with the turn (from 0) they stand in;
    ``attachment_tokens``, what all placeholders expand to."""
    visitor = PartVisitor(expansion)
    parts = F.filter(F.coalesce(F.col("parts").cast(f"array<{PART}>"), F.array()),
                     lambda p: p.isNotNull())
    rows = (turns.select("conv_id", F.col("turn").cast("long").alias("turn"),
                         escape_role(F.col("role")).alias("role"),
                         F.col("role").isin(*loss_roles).alias("loss"), parts.alias("parts"))
            .select("conv_id", "turn", "role", F.coalesce("loss", F.lit(False)).alias("loss"),
                    visitor.content(F.col("parts")).alias("content"),
                    visitor.attachments(F.col("parts")).alias("found"))
            .withColumn("segment", F.concat(F.lit(START), "role", F.lit("\n"), "content",
                                            F.lit(f"{END}\n"))))
    order = Window.partitionBy("conv_id").orderBy(
        F.asc_nulls_first("turn"), "role", "content", F.to_json("found"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    size = F.length("segment").cast("long")
    head = F.length("role") + len(START) + 1
    placed = rows.select(
        "conv_id", F.row_number().over(order).alias("at"), "segment", "found",
        F.struct(F.coalesce(F.sum(size).over(before), F.lit(0)).alias("start"),
                 size.alias("length"), head.alias("head"),
                 F.when(F.col("loss"), F.length("content")).otherwise(0).alias("loss_length"))
        .alias("span"))
    turns_of = F.sort_array(F.collect_list(F.struct("at", "segment", "span", "found")))
    whole = placed.groupBy("conv_id").agg(turns_of.alias("t"))
    attachments = F.flatten(F.transform("t", lambda t: F.transform(
        t["found"], lambda a: F.struct((t["at"] - 1).alias("turn"), a["kind"].alias("kind"),
                                       a["ref"].alias("ref"), a["tokens"].alias("tokens")))))
    return whole.select(
        "conv_id", F.array_join(F.transform("t", lambda t: t["segment"]), "").alias("formatted"),
        F.transform("t", lambda t: F.struct(
            t["span"]["start"].alias("start"), t["span"]["length"].alias("length"),
            (t["span"]["start"] + t["span"]["head"]).alias("loss_start"),
            t["span"]["loss_length"].alias("loss_length"))).alias("spans"),
        attachments.alias("attachments"),
        F.aggregate(attachments, F.lit(0).cast("long"), lambda n, a: n + a["tokens"])
        .alias("attachment_tokens"))


def _plain(content: Column) -> Column:
    """Text of an output range: unescaped between the template's strings."""
    return F.array_join(F.transform(F.split(content, F.lit(r"<\|[a-z_]+\|>")), unescape), "")


def read_back(formatted: DataFrame) -> DataFrame:
    """From ``formatted`` and ``spans`` alone: ``conv_id``, ``formatted_chars``,
    ``turns`` (role and text of every turn) and ``loss_texts`` (what lies under the
    loss mask, in order)."""
    split = F.split("formatted", F.lit(r"<\|im_start\|>"))
    pieces = F.slice(split, F.lit(2), F.greatest(F.size(split) - 1, F.lit(0)))
    role = lambda z: F.substring_index(z["piece"], "\n", 1)
    content = lambda z: F.substring(
        z["piece"], F.length(role(z)) + 2,
        F.length(z["piece"]) - F.length(role(z)) - len(END) - 2)
    masked = lambda z: F.substring(
        z["piece"], (z["span"]["loss_start"] - z["span"]["start"]).cast("int") - len(START) + 1,
        z["span"]["loss_length"].cast("int"))
    return formatted.select(
        "conv_id", F.length("formatted").cast("long").alias("formatted_chars"),
        F.arrays_zip(pieces.alias("piece"), F.col("spans").alias("span")).alias("t")).select(
        "conv_id", "formatted_chars",
        F.transform("t", lambda z: F.struct(unescape_role(role(z)).alias("role"),
                                            _plain(content(z)).alias("text"))).alias("turns"),
        F.transform(F.filter("t", lambda z: z["span"]["loss_length"] > 0),
                    lambda z: _plain(masked(z))).alias("loss_texts"))


def digests(back: DataFrame) -> DataFrame:
    """Counts and digests of read-back conversations."""
    turns = F.array_join(F.transform("turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars")
