"""Chat formatting at token level (operator 2).

A turn is written as ``### Role: text</turn>\\n``.  Role, separator and end are
reserved ids behind the vocabulary; role names and texts are encoded on their
own, so no merge ever crosses a border, and the parts are spliced.  The loss
mask (the texts of the ``trained`` roles) is the prefix sum of +1 and -1 at
their borders.

Texts (and the names of roles without an id of their own) are escaped so that
no control string can occur in them: every backslash is doubled, and a
backslash goes between two ``#``, before the ``/`` of ``</turn>`` and, in
names, after the colon of ``: ``; dropping each first backslash restores the
text.

Turns of a conversation are in order of (turn, role, text), nulls first;
repeated rows stay.  A null text or role is empty, rows without conv_id form
one conversation, an empty table gives no row.  Conversations are stored in
parts of whole turns of at most about ``part_tokens`` ids, so that a very long
one needs no more memory than a short one.  Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import input_bytes, materialize, tasks_for

ROLES = ("system", "user", "assistant")
#: Control strings by offset from the first reserved id: one per known role,
#: the start of any other role, the end of its name, the end of a turn.
CONTROL = (*(f"### {r.capitalize()}: " for r in ROLES), "### Role ", ": ", "</turn>\n")
OTHER, NAME_END, TURN_END = len(ROLES), len(ROLES) + 1, len(ROLES) + 2
PART = "conv_id long, part long, turns int, input_ids binary, loss_mask binary"


def escape(text: str) -> str:
    if "\\" in text:
        text = text.replace("\\", "\\\\")
    if "#" in text:
        text = re.sub("#(?=#)", r"#\\", text)
    return text.replace("</turn>", "<\\/turn>")


def unescape(text: str) -> str:
    return re.sub(r"(?s)\\(.)", r"\1", text) if "\\" in text else text


@lru_cache(maxsize=2)
def encoding(path: str):
    """(tiktoken encoding, first reserved id) of a rank file; the id after the
    ranks stays free for an end of text."""
    import public_tokenizers
    import tiktoken
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return (tiktoken.Encoding("chat", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}),
            max(ranks.values()) + 2)


def assemble(turns: list[tuple[str, str]], path: str, trained: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, loss mask, ids per turn) of (role, text) turns."""
    enc, base = encoding(path)
    segments, spans, per_turn = [], [], []  # spans: numbers of the segments under the loss

    def put(ids: list[int]) -> None:
        segments.append(ids)

    encode = enc.encode_ordinary
    for role, text in turns:
        at = len(segments)
        if role in ROLES:
            put([base + ROLES.index(role)])
        else:
            put([base + OTHER])
            put(encode(escape(role).replace(": ", ":\\ ")))
            put([base + NAME_END])
        if role in trained:
            spans.append(len(segments))
        put(encode(escape(text)))
        put([base + TURN_END])
        per_turn.append(len(segments) - at)
    lens = np.fromiter(map(len, segments), np.int64, len(segments))
    ends = np.cumsum(lens)
    total = int(ends[-1]) if len(ends) else 0
    ids = np.fromiter((i for s in segments for i in s), np.uint32, total)
    step = np.zeros(total + 1, np.int64)
    np.add.at(step, (ends - lens)[spans], 1)
    np.add.at(step, ends[spans], -1)
    turn_ends = ends[np.cumsum(per_turn) - 1] if per_turn else ends[:0]
    return ids, np.cumsum(step[:-1]).astype(np.uint8), np.diff(turn_ends, prepend=0)


def format_conversations(rows: DataFrame, path: str, trained: tuple = ("assistant",),
                         part_tokens: int = 1 << 20) -> DataFrame:
    """(conv_id, turn, role, text) -> parts: ids (little-endian uint32) and
    loss mask (one byte per id) of consecutive turns."""
    spark = rows.sparkSession
    sorted_ = (rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
               .repartition(tasks_for(spark, input_bytes(rows)), "conv_id")
               .sortWithinPartitions("conv_id", "turn", "role", "text"))

    def run(batches):
        key, part, chars, held = None, 0, 0, []

        def flush(conv_id, number, turns):
            ids, mask, _ = assemble(turns, path, trained)
            return pa.RecordBatch.from_pydict({
                "conv_id": pa.array([conv_id], pa.int64()), "part": pa.array([number], pa.int64()),
                "turns": pa.array([len(turns)], pa.int32()), "input_ids": pa.array([ids.tobytes()], pa.binary()),
                "loss_mask": pa.array([mask.tobytes()], pa.binary())})

        out, size = [], 0
        for batch in batches:
            for conv_id, _, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if held and (conv_id != key or chars > part_tokens):
                    out.append(flush(key, part, held))
                    part, chars, held = part + 1, 0, []
                    size += out[-1].nbytes
                    if len(out) == 500 or size > 32 << 20:
                        yield from pa.Table.from_batches(out).combine_chunks().to_batches()
                        out, size = [], 0
                if conv_id != key:
                    key, part = conv_id, 0
                held.append((role or "", text or ""))
                chars += len(held[-1][0]) + len(held[-1][1]) + 3
        if held:
            out.append(flush(key, part, held))
        if out:
            yield from pa.Table.from_batches(out).combine_chunks().to_batches()

    return sorted_.mapInArrow(run, PART)


def parse(ids: np.ndarray, mask: np.ndarray, path: str):
    """Yields (role, text, text under the loss, formatted characters) per turn."""
    enc, base = encoding(path)

    def text_of(part: np.ndarray) -> str:
        return enc.decode_bytes(part.tolist()).decode("utf-8")

    marks = np.flatnonzero(ids >= base)
    k = 0
    while k < len(marks):
        at, kind = int(marks[k]), int(ids[marks[k]]) - base
        chars = len(CONTROL[kind])
        if kind == OTHER:
            k += 1
            name = text_of(ids[at + 1:marks[k]])
            role, at = unescape(name), int(marks[k])
            chars += len(name) + len(CONTROL[NAME_END])
        else:
            role = ROLES[kind]
        k += 1
        end = int(marks[k])
        if ids[end] - base != TURN_END:
            raise ValueError("a turn does not end")
        body = text_of(ids[at + 1:end])
        loss = unescape(text_of(ids[at:end][mask[at:end] == 1]))
        yield role, unescape(body), loss, chars + len(body) + len(CONTROL[TURN_END])
        k += 1


def read_back(parts: DataFrame, path: str) -> DataFrame:
    """Digests of each conversation from its stored parts, in order."""
    spark = parts.sparkSession
    schema = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
              "formatted_chars long, n_tokens long, loss_tokens long")
    sorted_ = (parts.repartition(tasks_for(spark, input_bytes(parts)), "conv_id")
               .sortWithinPartitions("conv_id", "part"))

    def run(batches):
        names = [c.split()[0] for c in schema.split(", ")]
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
        out: list = []
        state = None

        def row():
            return (key, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), *state[4:])

        def batch_of(got):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*got), types)], names)

        key = None
        for batch in batches:
            for conv_id, _, _, raw, mask in zip(*(c.to_pylist() for c in batch.columns)):
                if state is None or conv_id != key:
                    if state is not None:
                        out.append(row())
                    key, state = conv_id, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0, 0]
                ids, mask = np.frombuffer(raw, "<u4"), np.frombuffer(mask, np.uint8)
                state[5] += len(ids)
                state[6] += int(mask.sum())
                for role, text, loss, chars in parse(ids, mask, path):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                    state[2] += len(loss)
                    state[3].update(loss.encode())
                    state[4] += chars
            if len(out) >= 5000:
                yield batch_of(out)
                out = []
        if state is not None:
            out.append(row())
        if out:
            yield batch_of(out)

    return sorted_.mapInArrow(run, schema)


def op2(conversations: DataFrame, path: str) -> DataFrame:
    spark = conversations.sparkSession
    probe = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", probe), (-7, 1, "assistant", probe)],
                                  "conv_id long, turn long, role string, text string")
    rows = conversations.select("conv_id", "turn", "role", "text").unionByName(extra)
    return read_back(materialize(format_conversations(rows, path), "chat-parts"), path)
