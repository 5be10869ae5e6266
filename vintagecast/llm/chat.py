"""Conversations rendered by a compiled template, with a loss mask, and read back.

The production template marks every turn.  Inside roles and texts its control
strings are broken by a backslash (and backslashes doubled), so no text can
end a turn or open one, and every text can be had back as it was.

Defined cases: null role or text counts as empty; turns go by turn number
(nulls first), ties by role and text, repeated rows each count; rows with a
null ``conv_id`` are one conversation with a null id; an empty table gives an
empty result; other columns don't matter.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches
from .template import compile_template

#: Control strings of the template.
CONTROL = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
#: A turn of a user, of an assistant (its text is to be learnt), of anyone else.
TEMPLATE = (
    "{% for m in messages %}<s>"
    "{% if m.role == 'user' %}[INST] {{ m.text | escape }} [/INST]"
    "{% elif m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}</s>"
    "{% else %}<<SYS>>{{ m.role | escape }}<</SYS>>{{ m.text | escape }}</s>"
    "{% endif %}{% endfor %}"
)
_OPENS = re.compile("|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in sorted(CONTROL)))
_SCAN = re.compile(r"\\.|" + "|".join(map(re.escape, sorted(CONTROL, key=len, reverse=True))), re.S)


def escape(text: object) -> str:
    """``text`` with no control string in it; ``unescape`` undoes it."""
    text = "" if text is None else str(text)
    if "\\" in text:
        text = text.replace("\\", "\\\\")
    return _OPENS.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S) if "\\" in text else text


def read_back(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a text in the production template."""
    marks = [(m[0], m.start(), m.end()) for m in _SCAN.finditer(formatted) if m[0][0] != "\\"]
    turns, i = [], 0
    plain = lambda a, b: unescape(formatted[a:b])
    while i < len(marks):
        names = [m[0] for m in marks[i : i + 4]]
        if names[:3] == ["<s>", "[INST]", "[/INST]"]:
            turns.append(("user", plain(marks[i + 1][2] + 1, marks[i + 2][1] - 1)))
            i += 3
        elif names[:2] == ["<s>", "</s>"]:
            turns.append(("assistant", plain(marks[i][2], marks[i + 1][1])))
            i += 2
        elif names == ["<s>", "<<SYS>>", "<</SYS>>", "</s>"]:
            turns.append((plain(marks[i + 1][2], marks[i + 2][1]), plain(marks[i + 2][2], marks[i + 3][1])))
            i += 4
        else:
            raise ValueError(f"not in the template at {marks[i][1]}: {names}")
    return turns


FORMATTED = "conv_id long, n_turns long, formatted string, spans array<struct<start:long,end:long>>"


def _render(template: str):
    def render_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compile_template(template, {"escape": escape})
        conv, messages, done = None, [], []

        def close() -> None:
            text, spans = render({"messages": messages})
            done.append((conv, len(messages), text, [{"start": s, "end": e} for s, e in spans]))

        def batch() -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
            cols = [pa.array(c, t) for c, t in zip(list(zip(*done)) or [[]] * 4, kinds)]
            done.clear()
            return pa.RecordBatch.from_arrays(cols, names=["conv_id", "n_turns", "formatted", "spans"])

        for b in batches:
            for c, role, text in zip(*(b.column(i).to_pylist() for i in range(3))):
                if messages and c != conv:
                    close()
                    messages = []
                conv = c
                messages.append({"role": role or "", "text": text or ""})
            yield batch()
        if messages:
            close()
        yield batch()

    return render_all


def _dealt(turns: DataFrame) -> DataFrame:
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")


def format_conversations(turns: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """Per conversation: conv_id, n_turns, formatted, spans (start and end, in
    code points, of what is under the loss mask).  Rows are dealt by
    conversation and sorted on disk; a task holds one conversation at a time
    (``format_chunks`` holds a part of it)."""
    return _dealt(turns).mapInArrow(_render(template), FORMATTED)


#: Code points after which a chunk of whole turns ends.
CHUNK_CHARS = 1 << 16
CHUNKS = "conv_id long, part long, start long, n_turns long, text string, spans array<struct<start:long,end:long>>"


def _render_chunks(chunk_chars: int):
    def render_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compile_template(TEMPLATE, {"escape": escape})
        conv, part, start, n, length, texts, spans, done, waiting = None, 0, 0, 0, 0, [], [], [], 0

        def close() -> None:
            nonlocal part, start, n, length, texts, spans, waiting
            done.append((conv, part, start, n, "".join(texts), [{"start": a, "end": b} for a, b in spans]))
            waiting += length
            part, start, n, length, texts, spans = part + 1, start + length, 0, 0, [], []

        def batch() -> pa.RecordBatch:
            nonlocal waiting
            kinds = [pa.int64()] * 4 + [pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
            cols = [pa.array(c, t) for c, t in zip(list(zip(*done)) or [[]] * 6, kinds)]
            done.clear()
            waiting = 0
            return pa.RecordBatch.from_arrays(cols, names=["conv_id", "part", "start", "n_turns", "text", "spans"])

        for b in batches:
            for c, role, text in zip(*(b.column(i).to_pylist() for i in range(3))):
                if (n or part) and c != conv:
                    if n:
                        close()
                    part = start = 0
                conv = c
                made, learnt = render({"messages": [{"role": role or "", "text": text or ""}]})  # the template knows no other turn
                spans += [(length + x, length + y) for x, y in learnt]
                texts.append(made)
                n, length = n + 1, length + len(made)
                if length >= chunk_chars:
                    close()
                if waiting >= 64 * chunk_chars:
                    yield batch()
            yield batch()
        if n:
            close()
        yield batch()

    return render_all


def format_chunks(turns: DataFrame, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """The conversations in the production template as chunks of whole turns:
    conv_id, part (from 0), start (code points before it), n_turns, text, spans
    (within the text).  A task holds a chunk and a batch of turns, however long a
    conversation is; its chunks come in order in one partition."""
    return _dealt(small_batches(turns)).mapInArrow(_render_chunks(chunk_chars), CHUNKS)


def _digest_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv = sha = loss = None
    n = chars = length = 0
    rows = []
    for b in batches:
        for c, part, text, spans in zip(*(b.column(k).to_pylist() for k in ("conv_id", "part", "text", "spans"))):
            if part == 0:
                if sha:
                    rows.append((conv, n, sha.hexdigest(), chars, loss.hexdigest(), length))
                conv, sha, loss, n, chars, length = c, hashlib.sha256(), hashlib.sha256(), 0, 0, 0
            for role, said in read_back(text):
                sha.update(f"{role}\n{said}\n".encode())
                n += 1
            for s in spans:
                learnt = unescape(text[s["start"] : s["end"]])
                loss.update(learnt.encode())
                chars += len(learnt)
            length += len(text)
        yield _digest_batch(rows)
        rows = []
    if sha:
        rows.append((conv, n, sha.hexdigest(), chars, loss.hexdigest(), length))
    yield _digest_batch(rows)


def digest_chunks(chunks: DataFrame) -> DataFrame:
    """``digests`` of ``format_chunks``, read in the order they were made (no
    shuffle in between), by running digests."""
    return chunks.select("conv_id", "part", "text", "spans").mapInArrow(_digest_chunks, DIGESTS)


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[]] * 6, kinds)], names=[x.split()[0] for x in DIGESTS.split(", ")])


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for conv, text, spans in zip(*(b.column(c).to_pylist() for c in ("conv_id", "formatted", "spans"))):
            turns = read_back(text)
            sha, loss, chars = hashlib.sha256(), hashlib.sha256(), 0
            for role, said in turns:
                sha.update(f"{role}\n{said}\n".encode())
            for s in spans:
                learnt = unescape(text[s["start"] : s["end"]])
                loss.update(learnt.encode())
                chars += len(learnt)
            rows.append((conv, len(turns), sha.hexdigest(), chars, loss.hexdigest(), len(text)))
        yield _digest_batch(rows)


def digests(formatted: DataFrame) -> DataFrame:
    """What the formatted texts and spans give back, as digests."""
    return formatted.select("conv_id", "formatted", "spans").mapInArrow(_digest, DIGESTS)
