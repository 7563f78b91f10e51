"""Conversations formatted for training, with typed content parts.

A visitor walks the parts of each turn in order: text is escaped, and every image, audio or document part becomes
a numbered placeholder; its reference and the number of tokens it expands to are recorded. Markers and
placeholders are control strings; a backslash is put into control strings inside texts, and backslashes are
doubled, so that ``parse`` gives back every turn exactly.

Rows are dealt by conversation and sorted by turn; a task holds one conversation at a time, whose formatted text is
one value of the result in any case.

Edge cases: null texts and roles are empty. Turns order by ``turn`` (null first), then role and text, so ties have a
defined order and repeated rows are turns of their own. A null ``conv_id`` is a conversation of its own. Extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Callable, Iterator
from itertools import groupby

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Control strings of common chat templates.
CONTROL = ("<|", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
TURN, BODY, END = "<|turn|>", "<|body|>", "<|end|>"
PARTS = "array<struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"
_CONTROL = re.compile("|".join(re.escape(c[:1]) + f"(?={re.escape(c[1:])})" for c in CONTROL))


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: m[0] + "\\", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


class Visitor:
    """Flattens parts; ``attachments`` holds ``(number, turn, kind, ref, tokens)``, ``spans`` the loss mask."""

    def __init__(self, patch: int = 14, tokens_per_second: float = 12.5, tokens_per_page: int = 512):
        self.patch, self.per_second, self.per_page = patch, tokens_per_second, tokens_per_page
        self.out: list[str] = []
        self.length = self.turns = 0
        self.attachments: list[tuple] = []
        self.spans: list[tuple[int, int]] = []

    def put(self, text: str) -> None:
        self.out.append(text)
        self.length += len(text)

    def text(self, part) -> None:
        start = self.length
        self.put(escape(part["text"] or ""))
        if self.learns and self.length > start:
            self.spans.append((start, self.length))

    def image(self, part) -> None:
        across = [math.ceil((part[side] or 0) / self.patch) for side in ("width", "height")]
        self.attach(part, max(1, across[0] * across[1]))

    def audio(self, part) -> None:
        self.attach(part, max(1, math.ceil((part["seconds"] or 0) * self.per_second)))

    def document(self, part) -> None:
        self.attach(part, max(1, part["pages"] or 1) * self.per_page)

    def attach(self, part, tokens: int) -> None:
        number = len(self.attachments) + 1
        self.put(f"<|{part['kind']}:{number}|>")
        self.attachments.append((number, self.turns, part["kind"], part["ref"], tokens))

    def turn(self, role: str | None, parts) -> None:
        self.learns = role == "assistant"
        self.put(TURN + escape(role or "") + BODY)
        for part in parts if parts is not None else ():
            visit: Callable = {"text": self.text, "image": self.image, "audio": self.audio, "document": self.document}.get(part["kind"])
            if visit is None:
                raise ValueError(f"unknown content part: {part['kind']}")
            visit(part)
        self.put(END)
        self.turns += 1


def parse(formatted: str) -> list[tuple[str, str]]:
    """Role and text of each turn; placeholders stand in the text as ``<|kind:number|>``."""
    turns = []
    for piece in formatted.split(TURN)[1:]:
        role, _, rest = piece.partition(BODY)
        turns.append((unescape(role), unescape(rest[: -len(END)])))
    return turns


FORMATTED = (
    "conv_id bigint, formatted string, n_turns bigint, loss_spans array<struct<start:bigint,end:bigint>>, "
    "attachments array<struct<number:int,turn:int,kind:string,ref:string,tokens:int>>, expanded_tokens bigint"
)


def format_chats(turns: DataFrame, partitions: int | None = None) -> DataFrame:
    """One row per conversation from ``conv_id, turn, role, parts``."""

    def build(batches: Iterator) -> Iterator:
        import pandas as pd

        def rows():
            for batch in batches:
                yield from zip(batch.conv_id, batch.role, batch.parts)

        def packed(chats):
            return pd.DataFrame(chats, columns=["conv_id", "formatted", "n_turns", "loss_spans", "attachments", "expanded_tokens"]).astype({"conv_id": "Int64"})

        chats, size = [], 0
        for conv, group in groupby(rows(), key=lambda r: None if pd.isna(r[0]) else int(r[0])):
            visitor = Visitor()
            for _, role, parts in group:
                visitor.turn(role, parts)
            chats.append((conv, "".join(visitor.out), visitor.turns, visitor.spans, visitor.attachments, sum(a[4] for a in visitor.attachments)))
            size += visitor.length
            if size > 4_000_000:
                yield packed(chats)
                chats, size = [], 0
        if chats:
            yield packed(chats)

    slim = turns.select(F.col("conv_id").cast("bigint"), "turn", "role", "parts")
    dealt = slim.repartition(partitions, "conv_id") if partitions else slim.repartition("conv_id")
    return dealt.sortWithinPartitions("conv_id", "turn", "role", F.to_json("parts")).select("conv_id", "role", "parts").mapInPandas(build, FORMATTED)


def text_parts(rows: DataFrame) -> DataFrame:
    """Plain ``text`` rows as single text parts."""
    part = "array(named_struct('kind', 'text', 'text', text, 'ref', null, 'width', null, 'height', null, 'seconds', null, 'pages', null))"
    return rows.select("conv_id", "turn", "role", F.expr(part).cast(PARTS).alias("parts"))


def digests(chats: DataFrame) -> DataFrame:
    """What the formatted texts say when read back."""

    def read(batches: Iterator) -> Iterator:
        import pandas as pd

        for batch in batches:
            out = []
            for conv, formatted, spans in zip(batch.conv_id, batch.formatted, batch.loss_spans):
                turns, loss = parse(formatted), "".join(unescape(formatted[s["start"] : s["end"]]) for s in spans)
                whole = "".join(f"{role}\n{text}\n" for role, text in turns)
                sha = [hashlib.sha256(x.encode("utf-8", "surrogatepass")).hexdigest() for x in (whole, loss)]
                out.append((conv, len(turns), sha[0], len(loss), sha[1], len(formatted)))
            columns = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            yield pd.DataFrame(out, columns=columns).astype({"conv_id": "Int64"})

    schema = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    return chats.select("conv_id", "formatted", "loss_spans").mapInPandas(read, schema)
