"""Chat formatting: conversations rendered by a compiled template, with the marks of what to learn, and read back."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from itertools import groupby
from operator import itemgetter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proseframe.llm.batches import small_batches
from proseframe.llm.template import compile_template

START, END = "<|im_start|>", "<|im_end|>"
#: strings that mean something to a tokenizer or a parser of chats (fixed values)
CONTROL = (START, END, "<|endoftext|>", "<|system|>", "<|user|>", "<|assistant|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
TEMPLATE = (
    "{% for message in messages %}"
    + START
    + "{{ message.role | line }}\n"
    + '{% if message.role == "assistant" %}{% generation %}{{ message.text | escape }}{% endgeneration %}'
    + "{% else %}{{ message.text | escape }}{% endif %}"
    + END
    + "\n{% endfor %}"
)
#: characters after which a conversation goes on in another row
PART = 1 << 20

_CONTROL = re.compile("|".join(re.escape(c) for c in CONTROL))
_ESCAPED = re.compile(r"\\(.)", re.S)
_PLAIN = {"\\": "\\", "-": "", "n": "\n"}


def escape(text: str) -> str:
    """``text`` without control strings: backslashes are doubled and ``\\-`` put behind the first character of each."""
    return _CONTROL.sub(lambda m: m[0][0] + "\\-" + m[0][1:], text.replace("\\", "\\\\"))


def escape_line(text: str) -> str:
    """The same for a text that must stay on its line."""
    return escape(text).replace("\n", "\\n")


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: _PLAIN[m[1]], text)


def _rows(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[[None if pd.isna(v) else int(v) for v in batch[c].astype("Int64")] if c in ("conv_id", "part") else batch[c] for c in batch.columns])


def render(turns: Iterable[tuple[str | None, str | None]], template) -> Iterator[tuple[str, list[int]]]:
    """A conversation's (role, text) turns as rows of formatted text and [start, end, ...] of its marked stretches."""
    messages = ({"role": role or "", "text": text or ""} for role, text in turns)
    pieces: list[str] = []
    marks: list[int] = []
    size = 0
    for text, marked in template(messages=messages):
        if marked and text:
            if marks and marks[-1] == size:
                marks[-1] += len(text)
            else:
                marks += [size, size + len(text)]
        pieces.append(text)
        size += len(text)
        if size >= PART:
            yield "".join(pieces), marks
            pieces, marks, size = [], [], 0
    if pieces:
        yield "".join(pieces), marks


def format_conversations(rows: DataFrame, template: str = TEMPLATE, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, part, formatted, marks) of each conversation, its turns in order, parts in order within a task.

    Rows are dealt out by conversation and sorted, and each task streams
    through its conversations turn by turn: a very long one goes on in more
    rows of about ``PART`` characters and is never held whole. (Its turns do
    meet in one task: the text of a conversation is a sequence.) ``marks`` are
    the stretches under generation marks, in characters of the row. Null roles
    and texts count as empty; equal turns are in order of role and text;
    repeated rows stay; rows without a conversation id form one; other columns
    are ignored; no rows give no rows.
    """
    small_batches(rows.sparkSession)

    def formatted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        run = compile_template(template, {"escape": escape, "line": escape_line})
        held: list[tuple] = []
        size = 0
        for name, turns in groupby(_rows(batches), key=itemgetter(0)):
            for part, (body, marks) in enumerate(render((t[1:] for t in turns), run)):
                held.append((name, part, body, marks))
                size += len(body)
                if size >= PART or len(held) >= 1000:
                    yield frame(held)
                    held, size = [], 0
        if held:
            yield frame(held)

    def frame(held: list[tuple]) -> pd.DataFrame:
        ids, parts, bodies, marks = zip(*held)
        return pd.DataFrame({"conv_id": pd.array(ids, dtype="Int64"), "part": parts, "formatted": bodies, "marks": marks})

    chosen = rows.select(F.col(conv).cast("bigint").alias("conv_id"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    dealt = chosen.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
    return dealt.mapInPandas(formatted, "conv_id bigint, part bigint, formatted string, marks array<bigint>")


def parse_turns(parts: Iterable[str]) -> Iterator[tuple[str, str]]:
    """The (role, text) turns of formatted text that comes in parts."""
    rest = ""
    for part in parts:
        rest += part
        at = 0
        while (end := rest.find(END + "\n", at)) >= 0:
            if not rest.startswith(START, at):
                raise ValueError("a turn does not begin where the last one ends")
            role, _, text = rest[at + len(START) : end].partition("\n")
            yield unescape(role), unescape(text)
            at = end + len(END) + 1
        rest = rest[at:]
    if rest:
        raise ValueError("the last turn does not end")


def read_back(formatted: DataFrame, ordered: bool = False) -> DataFrame:
    """What formatted rows say, per conversation: turns and marked text, as counts and digests.

    Reads the output alone: turns from their marks, learned text from ``marks``.
    ``ordered``: the rows come straight from :func:`format_conversations`;
    else they are dealt out by conversation and sorted by part first.
    """
    small_batches(formatted.sparkSession)

    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[tuple] = []
        for name, parts in groupby(_rows(batches), key=itemgetter(0)):
            learned, said = hashlib.sha256(), hashlib.sha256()
            sizes = [0, 0, 0]

            def bodies() -> Iterator[str]:
                for _, _, body, marks in parts:
                    marks = list(marks)
                    for start, end in zip(marks[::2], marks[1::2]):
                        text = unescape(body[start:end])
                        learned.update(text.encode())
                        sizes[1] += len(text)
                    sizes[2] += len(body)
                    yield body

            for role, text in parse_turns(bodies()):
                said.update(f"{role}\n{text}\n".encode())
                sizes[0] += 1
            out.append((name, sizes[0], said.hexdigest(), sizes[1], learned.hexdigest(), sizes[2]))
            if len(out) >= 5000:
                yield frame(out)
                out = []
        if out:
            yield frame(out)

    def frame(out: list[tuple]) -> pd.DataFrame:
        data = pd.DataFrame(out, columns=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])
        return data.assign(conv_id=pd.array(data["conv_id"].tolist(), dtype="Int64"))

    if not ordered:
        formatted = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    rows = formatted.select("conv_id", "part", "formatted", "marks")
    return rows.mapInPandas(digests, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")
