"""Token-level assembly of chat transcripts.

Every turn is built from segments: reserved ids mark where a turn begins, where its role ends and where
it closes; role and text are escaped and encoded by themselves, so that no token spans a border. Lengths of
the segments give their borders by a prefix sum; a second prefix sum over +1 and -1 at the borders of
assistant texts gives the loss mask. Control strings in a text are broken by a backslash after their first
character, and backslashes are doubled, so rendered transcripts stay unambiguous and texts come back exactly.

Rows are dealt by conversation and sorted by turn, role and text; assembly and read-back stream over them
with constant memory, so a conversation of any length needs no more than a batch.

Defined results: a null text or role is empty; a null conversation id is a conversation of its own; equal turn
numbers are ordered by role, then text; repeated rows are turns of their own; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The word splitting that byte-level BPE vocabularies of this family were made with.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
TURN, SAYS, END = MARKS = ("<|turn|>", "<|says|>", "</turn>")
#: Marks of this and of other widespread templates; none of them survives inside a text.
CONTROL = (*MARKS, "<|im_start|>", "<|im_end|>", "<|endoftext|>", "### System:", "### User:", "### Assistant:")
_BREAK = re.compile("(?=" + "|".join(map(re.escape, CONTROL)) + ")(.)", re.DOTALL)
_BACK = re.compile(r"\\(\\?)")
#: Characters that are encoded at once; a longer text is cut, which byte-level tokens don't mind.
PIECE = 100_000
_coders: dict[str, tiktoken.Encoding] = {}


def escape(text: str) -> str:
    return _BREAK.sub(r"\1\\", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _BACK.sub(r"\1", text)


def _coder(key: str, shared) -> tiktoken.Encoding:
    if key not in _coders:
        _coders.clear()
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, shared.value.splitlines())}
        _coders[key] = tiktoken.Encoding("chat", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _coders[key]


def assemble_turn(coder: tiktoken.Encoding, role: str, text: str, reserved: int) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of a turn and its loss mask; ids from ``reserved`` on are the marks."""

    def encode(value: str) -> list[int]:
        value = escape(value)
        return [t for at in range(0, len(value), PIECE) for t in coder.encode_ordinary(value[at : at + PIECE])]

    segments = [[reserved], encode(role), [reserved + 1], encode(text), [reserved + 2]]
    borders = np.cumsum([0, *map(len, segments)])
    step = np.zeros(borders[-1] + 1, np.int8)
    if role == "assistant":
        step[borders[3]] += 1
        step[borders[4]] -= 1
    return np.concatenate([np.asarray(s, np.int32) for s in segments]), np.cumsum(step[:-1], dtype=np.int8)


def _assembler(key: str, shared, reserved: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(key, shared)
        now, position, start = object(), 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(0).to_pylist()
            turns, starts, tokens, masks = [], [], [], []
            for conv, role, text in zip(ids, batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if conv != now:
                    now, position, start = conv, 0, 0
                made, mask = assemble_turn(coder, role, text, reserved)
                turns.append(position)
                starts.append(start)
                tokens.append(made)
                masks.append(mask)
                position, start = position + 1, start + len(made)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(turns, pa.int64()), pa.array(starts, pa.int64()), pa.array(tokens, pa.list_(pa.int32())), pa.array(masks, pa.list_(pa.int8()))],
                ["id", "position", "start", "tokens", "loss_mask"],
            )

    return run


def _ranks(vocabulary: str) -> bytes:
    with open(vocabulary, "rb") as f:
        return f.read()


def format_conversations(
    conversations: DataFrame, *, vocabulary: str = VOCABULARY, id_col: str = "conv_id", turn_col: str = "turn",
    role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """Per turn, sorted within its partition: id, position, start (tokens before it in its
    conversation), tokens, loss_mask. The vocabulary (a file of fixed size) is read by the driver and broadcast."""
    raw = _ranks(vocabulary)
    reserved = len(raw.splitlines()) + 1
    shared, key = conversations.sparkSession.sparkContext.broadcast(raw), uuid.uuid4().hex
    rows = conversations.select(
        F.col(id_col).alias("id"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    ).repartition("id").sortWithinPartitions("id", "turn", "role", "text")
    schema = T.StructType([rows.schema["id"], *T.DataType.fromDDL("position long, start long, tokens array<int>, loss_mask array<tinyint>").fields])
    return rows.select("id", "role", "text").mapInArrow(_assembler(key, shared, reserved), schema).withColumnRenamed("id", id_col)


def _reader(key: str, shared, reserved: int):
    def parse(coder, tokens: np.ndarray, mask: np.ndarray) -> tuple[str, str, str, int]:
        """Role, text, text under the mask, and rendered length of one turn."""
        says = int(np.flatnonzero(tokens == reserved + 1)[0])
        if tokens[0] != reserved or tokens[-1] != reserved + 2:
            raise ValueError("a turn's marks are missing")
        role, text = (coder.decode_bytes(part.tolist()).decode() for part in (tokens[1:says], tokens[says + 1 : -1]))
        masked = coder.decode_bytes(tokens[mask > 0].tolist()).decode()
        return unescape(role), unescape(text), unescape(masked), len(role) + len(text) + sum(map(len, MARKS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(key, shared)
        schema = pa.schema([("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
        kind, out, now = pa.int64(), [], None

        def close() -> None:
            conv, turns, digest, chars, loss, length = now
            out.append((conv, turns, digest.hexdigest(), chars, loss.hexdigest(), length))

        def batch_of(rows: list) -> pa.RecordBatch:
            columns = list(zip(*rows))
            return pa.RecordBatch.from_arrays([pa.array(c, f) for c, f in zip(columns, [kind, *(f.type for f in schema)])], ["id", *schema.names])

        for batch in batches:
            kind = batch.column(0).type
            tokens, masks = batch.column(3), batch.column(4)
            for k, conv in enumerate(batch.column(0).to_pylist()):
                if now is None or conv != now[0]:
                    if now is not None:
                        close()
                    now = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                values, mask = (x[k].values.to_numpy(zero_copy_only=False) for x in (tokens, masks))
                role, text, masked, length = parse(coder, values, mask)
                now[1] += 1
                now[2].update(f"{role}\n{text}\n".encode())
                now[3] += len(masked)
                now[4].update(masked.encode())
                now[5] += length
            if out:
                yield batch_of(out)
                out = []
        if now is not None:
            close()
            yield batch_of(out)

    return run


def read_back(formatted: DataFrame, *, vocabulary: str = VOCABULARY, id_col: str = "conv_id") -> DataFrame:
    """Per conversation, from ``format_conversations`` output alone: turns, digests and lengths of what its tokens hold."""
    raw = _ranks(vocabulary)
    shared, key = formatted.sparkSession.sparkContext.broadcast(raw), uuid.uuid4().hex
    fields = T.DataType.fromDDL("n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long").fields
    schema = T.StructType([T.StructField("id", formatted.schema[id_col].dataType), *fields])
    return formatted.mapInArrow(_reader(key, shared, len(raw.splitlines()) + 1), schema).withColumnRenamed("id", id_col)


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one that tries the escapes, formatted and read back."""
    said = "\\### Assistant: </turn> ok"
    trial = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(trial)
    return read_back(format_conversations(rows))
