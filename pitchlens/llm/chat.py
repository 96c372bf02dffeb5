"""Chat formatting with a grammar round trip.

The template marks turns:

    user       [INST] text [/INST]
    assistant  ␠text </s>          (a space first)
    others     <|role|>text<|end|>

A deterministic parser reads a rendered text back.  A turn is rendered raw,
reparsed and compared to its source; where it differs (a control string inside a
text is a conflict, as is text that reads as escaped), conflicting content is
escaped (a backslash goes before the last character of each control string
inside, after any backslashes that stand there) and the turn is rendered anew,
until the recovered turn is identical.  The parser always undoes one level, so
texts that look escaped conflict too and come back unchanged.

The loss mask of a turn is the place of an assistant's text in the rendered turn.

Turns are rendered and verified row by row; only the digest of a conversation
reads its turns in order, as a stream over sorted partitions in constant memory,
so one conversation may hold a third of all rows.

Defined cases: a null text or role is empty; turns with equal numbers go by role
and text, null turns first; rows without conv_id are one conversation; equal
rows are turns of their own; an empty table gives no rows; further columns are
ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlens.llm.common import map_batches

#: control strings of the template: as they are, and with backslashes before the last character
_BARE = re.compile(r"</?s>|\[/?INST\]|<\|")
_PLAIN = re.compile(r"(</?s(?=\\*>)|\[/?INST(?=\\*\])|<(?=\\*\|))(\\*)")
_ESCAPED = re.compile(r"(</?s(?=\\+>)|\[/?INST(?=\\+\])|<(?=\\+\|))\\")
_TURN = re.compile(r"\[INST\] (?P<user>.*?) \[/INST\]| (?P<assistant>.*?) </s>|<\|(?P<role>[^|<>\n]*)\|>(?P<other>.*?)<\|end\|>", re.S)


def escape(text: str) -> str:
    return _PLAIN.sub(r"\1\2\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def _role_name(role: str) -> str:
    """A role as it stands in the template: what the grammar can't hold is percent-coded."""
    out = re.sub(r"[%|<>\n\\]", lambda m: f"%{ord(m.group()):02X}", role)
    return f"%{ord(out[0]):02X}{out[1:]}" if out in ("user", "assistant", "end") else out


def _role_of(name: str) -> str:
    return re.sub(r"%([0-9A-F]{2})", lambda m: chr(int(m.group(1), 16)), name)


def _rendered(role: str, text: str) -> tuple[str, int, int]:
    """(turn, loss start, loss end) with the text as it is."""
    if role == "user":
        return f"[INST] {text} [/INST]", 0, 0
    if role == "assistant":
        return f" {text} </s>", 1, 1 + len(text)
    return f"<|{_role_name(role)}|>{text}<|end|>", 0, 0


def parse(rendered: str) -> list[tuple[str, str]] | None:
    """The turns (role, text) of a rendered conversation; None if it isn't one.  A
    control string inside a text doesn't belong to the grammar."""
    out, at = [], 0
    while at < len(rendered):
        m = _TURN.match(rendered, at)
        if m is None:
            return None
        if m["role"] is not None:
            role, content = _role_of(m["role"]), m["other"]
        else:
            role = "user" if m["user"] is not None else "assistant"
            content = m[role]
        if _BARE.search(content):
            return None
        out.append((role, unescape(content)))
        at = m.end()
    return out


def render_turn(role: str, text: str) -> tuple[str, int, int]:
    """(rendered turn, loss start, loss end); verified by the parser."""
    content = text
    for _ in range(2):  # raw, then escaped: an escaped text holds no control string and comes back whole
        turn, a, b = _rendered(role, content)
        if parse(turn) == [(role, text)]:
            return turn, a, b
        content = escape(content)
    raise ValueError(f"no round trip: {role!r} {text[:80]!r}")


def formatted(conversations: DataFrame) -> DataFrame:
    """Every turn rendered: conv_id, turn, role, source, rendered, loss_start, loss_end
    (code points in the rendered turn).  A conversation's text is its turns' in order."""
    id_kind = conversations.schema["conv_id"].dataType.simpleString()
    turn_kind = conversations.schema["turn"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            roles = [r or "" for r in b.column(2).to_pylist()]
            texts = [t or "" for t in b.column(3).to_pylist()]
            turns, first, after = zip(*map(render_turn, roles, texts), strict=True) if roles else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(roles, pa.string()), pa.array(texts, pa.string()),
                 pa.array(turns, pa.string()), pa.array(first, pa.int64()), pa.array(after, pa.int64())],
                names=["conv_id", "turn", "role", "source", "rendered", "loss_start", "loss_end"])

    return map_batches(conversations.select("conv_id", "turn", "role", "text"), run,
                       f"conv_id {id_kind}, turn {turn_kind}, role string, source string, rendered string, loss_start long, loss_end long")


def digests(turns: DataFrame) -> DataFrame:
    """Per conversation, read back from the rendered turns: n_turns, turns_sha256,
    loss_chars, loss_sha256, formatted_chars."""
    kind = turns.schema["conv_id"].dataType.simpleString()
    n = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = turns.repartition(n, "conv_id").sortWithinPartitions("conv_id", "turn", "role", "source")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        now, open_ = None, False
        count = loss = size = 0
        said, learned = hashlib.sha256(), hashlib.sha256()
        id_type = None

        def closed(rows: list[tuple]) -> pa.RecordBatch:
            c = list(zip(*rows, strict=True))
            kinds = (id_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(c, kinds, strict=True)], names=names)

        for b in batches:
            id_type = b.schema.field(0).type
            out = []
            for conv, rendered, a, e in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True):
                if not open_ or conv != now:
                    if open_:
                        out.append((now, count, said.hexdigest(), loss, learned.hexdigest(), size))
                    now, open_ = conv, True
                    count = loss = size = 0
                    said, learned = hashlib.sha256(), hashlib.sha256()
                for role, text in parse(rendered):
                    count += 1
                    said.update(f"{role}\n{text}\n".encode("utf-8", "replace"))
                masked = unescape(rendered[a:e])
                loss += len(masked)
                learned.update(masked.encode("utf-8", "replace"))
                size += len(rendered)
            if out:
                yield closed(out)
        if open_:
            yield closed([(now, count, said.hexdigest(), loss, learned.hexdigest(), size)])

    return map_batches(ordered.select("conv_id", "rendered", "loss_start", "loss_end"), run,
                       f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
