"""Relational chat formatting: turns are sorted, runs of one role are merged, the whole is one string.

Template: every run of one role is ``<s>[role]text[+]text...[/]</s>``. Control
strings are built from ``<``, ``[`` and ``]``; inside roles and texts these three and
the escape character are written as ``\\l``, ``\\q``, ``\\e`` and ``\\b``, so no text can
forge a marker and :func:`read_back` restores every turn exactly.

Defined cases: a NULL text is empty, a NULL role is the empty role, a NULL
conv_id is one conversation of its own; turns with equal numbers are ordered by
role, then text; NULL turn numbers come first; repeated rows are turns of
their own; an empty table gives no rows. Only the four named columns are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: template markers
OPEN, ROLE_END, JOIN, CLOSE = "<s>[", "]", "[+]", "[/]</s>"
LOSS_ROLE = "assistant"


def _escape(text: str) -> str:
    return f"replace(replace(replace(replace({text}, '\\\\', '\\\\b'), '<', '\\\\l'), '[', '\\\\q'), ']', '\\\\e')"


def _unescape(text: str) -> str:
    return f"replace(replace(replace(replace({text}, '\\\\e', ']'), '\\\\q', '['), '\\\\l', '<'), '\\\\b', '\\\\')"


def format_chats(turns: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id, pieces, formatted``.

    ``pieces`` are the consecutive parts of ``formatted`` as ``(loss, text)``;
    the parts under the loss mask are the escaped texts of the assistant. Escaping
    happens per row, before the rows of a conversation meet.
    """
    rows = turns.select(
        "conv_id",
        F.struct(
            F.col("turn"),
            F.expr(_escape("coalesce(role, '')")).alias("role"),
            F.expr(_escape("coalesce(text, '')")).alias("text"),
        ).alias("t"),
    )
    sorted_turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    head = f"CASE WHEN i = 0 OR ts[i - 1].role <> t.role THEN concat('{OPEN}', t.role, '{ROLE_END}') ELSE '{JOIN}' END"
    tail = f"CASE WHEN i = size(ts) - 1 OR ts[i + 1].role <> t.role THEN '{CLOSE}' ELSE '' END"
    pieces = (
        "flatten(transform(ts, (t, i) -> array("
        f"named_struct('loss', false, 'text', {head}), "
        f"named_struct('loss', t.role = '{LOSS_ROLE}', 'text', t.text), "
        f"named_struct('loss', false, 'text', {tail}))))"
    )
    return sorted_turns.withColumn("pieces", F.expr(pieces)).select(
        "conv_id", "pieces", F.expr("array_join(transform(pieces, p -> p.text), '')").alias("formatted")
    )


def read_back(chats: DataFrame) -> DataFrame:
    """Turns restored from the formatted string: ``conv_id, formatted, pieces, turns`` (array of role, text)."""
    runs = f"slice(split(formatted, '<s>\\\\['), 2, greatest(size(split(formatted, '<s>\\\\[')) - 1, 0))"
    role = _unescape("substring(r, 1, instr(r, ']') - 1)")
    body = f"substring(r, instr(r, ']') + 1, char_length(r) - instr(r, ']') - {len(CLOSE)})"
    one = (
        f"r -> transform(split({body}, '\\\\[\\\\+\\\\]'), "
        f"x -> named_struct('role', {role}, 'text', {_unescape('x')}))"
    )
    return chats.withColumn("turns", F.expr(f"flatten(transform({runs}, {one}))"))


def digests(chats: DataFrame) -> DataFrame:
    """Digest columns per conversation, taken from the formatted string and its mask."""
    back = read_back(chats)
    said = "array_join(transform(turns, t -> concat(t.role, '\\n', t.text, '\\n')), '')"
    loss = _unescape("array_join(transform(filter(pieces, p -> p.loss), p -> p.text), '')")
    return back.withColumn("__loss", F.expr(loss)).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.expr(said).cast("binary"), 256).alias("turns_sha256"),
        F.char_length("__loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("__loss").cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
