"""Operator 5: chat formatting with a template as a black box.

A template renders a list of turns to text.  Every prefix of a conversation is
rendered whole and consecutive outputs are compared: what the longer one adds is
the new turn's span, and an output that does not start with the one before it
shows a template that rewrites history.  The place of a turn's text in its span
comes from the same prefix with a probe character as its last text; where what
surrounds the probe does not surround the text, the text's only verbatim
occurrence counts, and without one the turn has no place of its text.  The loss
mask covers each assistant turn's text and nothing else.

That is quadratic in the turns of a conversation.  A caller that declares a
template ``local`` (the rendering of turns is that of each, in a row) has its
turns rendered one by one, which counts only if together they equal the
rendering of the whole.

Rows are put in order of turn (then role and text); null role, turn and text
count as empty, first and empty; rows without an id are one conversation.  Rows
that repeat are turns of their own.  Texts of any length are rendered whole.  A
template that rewrites history gives its text, ``rewrites_history`` true, and
null spans.  An empty table gives an empty result; other columns are not read,
whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm import common

Turn = tuple[str, str]
Render = Callable[[Sequence[Turn]], str]

#: Characters of which the first that a conversation does not have is the probe.
PROBES = tuple(map(chr, range(0xE000, 0xF900)))

START, END = "<|im_start|>", "<|im_end|>"
#: Control strings of this and of other public templates.
CONTROL = (START, END, "<|endoftext|>", "<|startoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
_OPENS = re.compile(r"[<\[](?=" + "|".join(re.escape(c[1:]) for c in CONTROL) + ")")
_SLASH = re.compile(r"\\(\\?)")
_ROLE = re.compile(r"\\([\\n])")


def escape(text: str) -> str:
    """``text`` without control strings: a backslash splits each after its first
    character, and a backslash of the text is doubled."""
    return _OPENS.sub(lambda m: m[0] + "\\", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _SLASH.sub(r"\1", text)


def _role_out(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _role_in(role: str) -> str:
    return _ROLE.sub(lambda m: "\n" if m[1] == "n" else "\\", unescape(role))


def render(turns: Sequence[Turn]) -> str:
    """The template: every turn between its marks, role and text escaped."""
    return "".join([f"{START}{_role_out(r)}\n{escape(t)}{END}\n" for r, t in turns])


def parse(formatted: str) -> list[Turn]:
    """The turns of what :func:`render` returned."""
    turns = []
    for part in formatted.split(START)[1:]:
        role, _, text = part[: -len(END) - 1].partition("\n")
        turns.append((_role_in(role), unescape(text)))
    return turns


Span = tuple[int, int, int | None, int | None]


def _text_place(span: str, probed: str, probe: str, text: str) -> tuple[int, int] | None:
    """Where in ``span`` its turn's text is; ``probed`` is the span with a probe for it."""
    if probed.count(probe) == 1:
        head, _, tail = probed.partition(probe)
        if len(head) + len(tail) <= len(span) and span.startswith(head) and span.endswith(tail):
            return len(head), len(span) - len(tail)
    if text and span.count(text) == 1:
        at = span.index(text)
        return at, at + len(text)
    return None


def _probe_for(turns: Sequence[Turn]) -> str:
    used = set().union(*(set(role) | set(text) for role, text in turns))
    return next((p for p in PROBES if p not in used), PROBES[0])


def _each_alone(template: Render, turns: Sequence[Turn]) -> tuple[str, list[Span]] | None:
    """Text and spans of a template that renders every turn by itself; None if it does not."""
    text, probe = template(turns), _probe_for(turns)
    spans: list[Span] = []
    end = 0
    for role, said in turns:
        own = template([(role, said)])
        if not text.startswith(own, end):
            return None
        place = _text_place(own, template([(role, probe)]), probe, said)
        spans.append((end, end + len(own), *((None, None) if place is None else (end + place[0], end + place[1]))))
        end += len(own)
    return (text, spans) if end == len(text) else None


def locate(template: Render, turns: Sequence[Turn], local: bool = False) -> tuple[str, list[Span] | None]:
    """The text, and per turn where its span and the turn's text in it start
    and end; None in place of those if the template rewrites history."""
    alone = _each_alone(template, turns) if local else None
    if alone is not None:
        return alone
    probe = _probe_for(turns)
    before, spans = template([]), []
    for k, (role, said) in enumerate(turns):
        now = template(turns[: k + 1])
        if not now.startswith(before):
            return template(turns), None
        probed = template([*turns[:k], (role, probe)])
        place = _text_place(now[len(before) :], probed[len(before) :], probe, said) if probed.startswith(before) else None
        start = len(before)
        spans.append((start, len(now), *((None, None) if place is None else (start + place[0], start + place[1]))))
        before = now
    return before, spans


_SPAN = "struct<start:int,stop:int,text_start:int,text_stop:int,loss:boolean>"


def format_conversations(
    rows: DataFrame,
    template: Render = render,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    loss_role: str = "assistant",
    local: bool = False,
) -> DataFrame:
    """``conv_id, formatted, rewrites_history, spans``: one row per conversation;
    offsets count code points; a turn without a place of its text has no loss."""
    names = ["conv", "turn", "role", "text"]
    slim = rows.select(*(common.quoted(c).alias(n) for c, n in zip((id_col, turn_col, role_col, text_col), names, strict=True)))
    id_type = slim.schema["conv"].dataType
    ordered = slim.select(
        "conv", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).repartition("conv").sortWithinPartitions("conv", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Turn] = []
        key: object = None

        def done() -> pa.RecordBatch:
            text, spans = locate(template, held, local)
            marks = None if spans is None else [
                {"start": a, "stop": b, "text_start": c, "text_stop": d, "loss": role == loss_role and c is not None}
                for (a, b, c, d), (role, _) in zip(spans, held, strict=True)]
            kind = pa.list_(pa.struct([(n, pa.int32()) for n in ("start", "stop", "text_start", "text_stop")] + [("loss", pa.bool_())]))
            return pa.RecordBatch.from_arrays(
                [pa.array([key], conv_type), pa.array([text], pa.string()), pa.array([spans is None]), pa.array([marks], kind)],
                names=["conv", "formatted", "rewrites_history", "spans"])

        conv_type = pa.int64()
        for batch in batches:
            conv_type = batch.schema.field(0).type
            for conv, role, text in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3)), strict=True):
                if held and conv != key:
                    yield done()
                    held = []
                key = conv
                held.append((role, text))
        if held:
            yield done()

    schema = f"conv {id_type.simpleString()}, formatted string, rewrites_history boolean, spans array<{_SPAN}>"
    return ordered.mapInArrow(run, schema).withColumnRenamed("conv", id_col)


def read_back(formatted: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """Digests of the turns and of the text under the loss mask, from the
    formatted text and its spans alone."""
    id_type = formatted.schema[id_col].dataType.simpleString()
    digest = lambda text: hashlib.sha256(text.encode("utf-8")).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {n: [] for n in ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")}
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                turns = parse(text)
                loss = "".join([unescape(text[s["text_start"] : s["text_stop"]]) for s in spans or [] if s["loss"]])
                out["n_turns"].append(len(turns))
                out["turns_sha256"].append(digest("".join([f"{r}\n{t}\n" for r, t in turns])))
                out["loss_chars"].append(len(loss))
                out["loss_sha256"].append(digest(loss))
                out["formatted_chars"].append(len(text))
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True))],
                names=["conv", *out])

    schema = f"conv {id_type}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return formatted.select(common.quoted(id_col).alias("conv"), "formatted", "spans").mapInArrow(run, schema).withColumnRenamed("conv", id_col)
