"""Chat formatting with a grammar round trip.

A turn is rendered as ``### Role: body\\n</turn>\\n``. A deterministic parser reads rendered text back; an unescaped control
string inside a body is a syntax error or another turn, and a backslash before a control string is taken off. A turn whose
reading differs from its source gets a backslash before every control string of its body, until both are identical.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_arrow

#: Roles with a name of their own; any other role is written as @ and its percent-encoded text.
ROLES = {"system": "System", "user": "User", "assistant": "Assistant", "tool": "Tool"}
_BY_NAME = {name: role for role, name in ROLES.items()}
_NAME = r"(?:System|User|Assistant|Tool|@[A-Za-z0-9_.~%/-]*)"
HEADER = re.compile(rf"### ({_NAME}): ")
CONTROL = re.compile(rf"(\\*)(### {_NAME}: |</turn>)")
END = "\n</turn>\n"
CHUNK_CHARS = 1_000_000


def unescape(body: str) -> str:
    return CONTROL.sub(lambda m: m[0][1:] if m[1] else m[0], body)


def escape(body: str) -> str:
    return CONTROL.sub(lambda m: "\\" + m[0], body)


def parse(rendered: str) -> list[tuple[str, str]] | None:
    """The turns (role, text) of rendered text; None if it isn't of the grammar."""
    turns, at = [], 0
    while at < len(rendered):
        head = HEADER.match(rendered, at)
        if not head:
            return None
        for control in CONTROL.finditer(rendered, head.end()):
            if not control[1]:
                break
        else:
            return None
        stop = control.start() - 1
        if stop < head.end() or not rendered.startswith(END, stop):
            return None
        name = head[1]
        role = unquote(name[1:]) if name[0] == "@" else _BY_NAME[name]
        turns.append((role, unescape(rendered[head.end() : stop])))
        at = stop + len(END)
    return turns


def render(role: str, text: str) -> tuple[str, int, int]:
    """The rendered turn, and where its body starts and ends in it."""
    head = f"### {ROLES.get(role) or '@' + quote(role, safe='')}: "
    body = text
    for _ in range(3):
        rendered = head + body + END
        if parse(rendered) == [(role, text)]:
            return rendered, len(head), len(head) + len(body)
        body = escape(body)
    raise ValueError("a turn can't be rendered so that it reads back")


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_SPAN = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def format_turns(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row for each conversation: ``conv``, formatted, loss_spans (bodies of assistant turns, as offsets) and n_turns.

    Turns stand in order of ``turn``, then role and text; nulls come first, and a null role or text counts as empty. Repeated
    rows are repeated turns; rows without a conversation id form one conversation; other columns are not read. Turns are
    dealt by ranges of (conversation, turn), so a conversation of any length is rendered by many tasks, and each sends on a
    few joined chunks of it rather than rows.
    """
    order = [conv, turn, role, text]

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, held = TaskContext.get().partitionId(), 0, None

        def out(chunk):
            key, pieces, spans, turns, _ = chunk
            columns = [pa.array([key], kind), pa.array([part], pa.int64()), pa.array([seq], pa.int64()), pa.array(["".join(pieces)])]
            return pa.RecordBatch.from_arrays([*columns, pa.array([spans], _SPANS), pa.array([turns], pa.int64())], names=_CHUNK)

        for batch in batches:
            kind = batch.column(0).type
            for key, who, what in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3)), strict=True):
                if held and (held[0] != key or held[4] > CHUNK_CHARS):
                    yield out(held)
                    held, seq = None, seq + 1
                held = held or [key, [], [], 0, 0]
                rendered, start, end = render(who or "", what or "")
                if who == "assistant":
                    held[2].append({"start": held[4] + start, "end": held[4] + end})
                held[1].append(rendered)
                held[3] += 1
                held[4] += len(rendered)
        if held:
            yield out(held)

    _CHUNK = [conv, "part", "seq", "chunk", "spans", "turns"]
    schema = T.StructType([
        df.schema[conv], T.StructField("part", T.LongType()), T.StructField("seq", T.LongType()),
        T.StructField("chunk", T.StringType()), T.StructField("spans", _SPAN), T.StructField("turns", T.LongType()),
    ])
    rows = map_arrow(df.select(*order).repartitionByRange(*order).sortWithinPartitions(*order), segments, schema)
    # Ranges are numbered in sort order, so (part, seq) orders the chunks of a conversation.
    joined = rows.groupBy(conv).agg(F.sort_array(F.collect_list(F.struct("part", "seq", "chunk", "spans", "turns"))).alias("chunks"))

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans, turns = [], [], []
            for chunks in batch.column(1).to_pylist():
                at, own = 0, []
                for c in chunks:
                    own += [{"start": at + s["start"], "end": at + s["end"]} for s in c["spans"]]
                    at += len(c["chunk"])
                texts.append("".join(c["chunk"] for c in chunks))
                spans.append(own)
                turns.append(sum(c["turns"] for c in chunks))
            columns = [batch.column(0), pa.array(texts, pa.string()), pa.array(spans, _SPANS), pa.array(turns, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[conv, "formatted", "loss_spans", "n_turns"])

    final = T.StructType([df.schema[conv], T.StructField("formatted", T.StringType()), T.StructField("loss_spans", _SPAN), T.StructField("n_turns", T.LongType())])
    return map_arrow(joined, assemble, final)
