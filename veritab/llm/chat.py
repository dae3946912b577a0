"""Chat formatting by token-level assembly.

Every segment of a turn (role, text) is encoded on its own, and the reserved ids of the template are spliced
in between as ids, never as text, so no content can produce a control id. Control strings that occur in a
text are also escaped reversibly: a backslash goes between ``<`` and ``|`` (and one more where backslashes
already stand there), so ``<|`` never appears in the formatted text except where the template wrote it.

One turn is ``<|im_start|>`` role ``\\n`` text ``<|im_end|>`` ``\\n``. The loss mask of a turn covers exactly the
tokens of an assistant's text; mask borders are prefix sums of the segment lengths, first within the turn and
then over the turns of a conversation. Turns are rows, so a conversation of any length is spread over tasks
while it is encoded; only the running positions and digests follow a conversation in order.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# split pattern of the vocabulary file above (fixed value, published with it)
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
START_ID, END_ID = 50257, 50258
TRAINED_ROLES = ("assistant",)

_ESCAPE, _UNESCAPE = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    return _ESCAPE.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    """A role is one line: backslashes are doubled and a line break becomes backslash n."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


class Codec:
    """Byte-level vocabulary read from ``path``; ids from START_ID on are reserved for the template."""

    def __init__(self, path: str = VOCABULARY):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("chat", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> list[int]:
        return self.encoding.encode_ordinary(text)

    def decode(self, ids: list[int]) -> str:
        return self.encoding.decode_bytes(ids).decode("utf-8")


def assemble(codec: Codec, role: str, text: str) -> tuple[list[int], int, int]:
    """(ids of one turn, first and one-past-last position of the text's tokens under the loss mask)."""
    segments = [[START_ID], codec.encode(escape_role(role)), codec.encode("\n"), codec.encode(escape(text)), [END_ID], codec.encode("\n")]
    bounds = np.concatenate(([0], np.cumsum([len(s) for s in segments])))
    ids = [i for s in segments for i in s]
    trained = role in TRAINED_ROLES
    return ids, int(bounds[3]), int(bounds[4]) if trained else int(bounds[3])


def read_turn(codec: Codec, ids: list[int], loss: tuple[int, int]) -> tuple[str, str, str, int]:
    """(role, text, text under the loss mask, characters of the formatted turn) read back from ids and mask."""
    end = ids.index(END_ID)
    body = codec.decode(ids[1:end])
    role, _, text = body.partition("\n")
    trained = codec.decode(ids[loss[0] : loss[1]])
    formatted = len(START) + len(body) + len(END) + len(codec.decode(ids[end + 1 :]))
    return unescape_role(role), unescape(text), unescape(trained), formatted


def _encode(path: str):
    state: list[Codec] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not state:
            state.append(Codec(path))
        for b in batches:
            t = b.to_pydict()
            made = [assemble(state[0], r or "", x or "") for r, x in zip(t["role"], t["text"])]
            yield pa.RecordBatch.from_arrays(
                [b.column("conv_id"), b.column("turn"), b.column("role"), pa.array([m[0] for m in made], pa.list_(pa.int32())), pa.array([m[1] for m in made], pa.int32()), pa.array([m[2] for m in made], pa.int32())],
                names=["conv_id", "turn", "role", "ids", "loss_start", "loss_end"],
            )

    return run


def format_turns(conversations: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per turn: conv_id, turn, role, ids, loss_start, loss_end (token positions of the mask inside the turn).

    A null role or text is empty. Extra columns are ignored."""
    cols = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    kind = cols.schema["conv_id"].dataType.simpleString()
    return cols.mapInArrow(_encode(vocabulary), f"conv_id {kind}, turn long, role string, ids array<int>, loss_start int, loss_end int")


def _positions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last, at = object(), 0
    for b in batches:
        conv = b.column("conv_id").to_pylist()
        n = np.diff(np.asarray(b.column("ids").offsets))
        out = np.empty(len(conv), dtype=np.int64)
        for i, c in enumerate(conv):
            at = at if c == last else 0
            last, out[i] = c, at
            at += int(n[i])
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out)], names=[*b.schema.names, "first_token"])


def in_order(turns: DataFrame) -> DataFrame:
    """Turns of a conversation next to one another, by turn (ties by role, then ids); nothing is held in memory."""
    return turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "ids")


def assemble_conversations(turns: DataFrame) -> DataFrame:
    """Add ``first_token``, the position of the turn's first token in its conversation (a running prefix sum);
    the mask of the conversation is [first_token + loss_start, first_token + loss_end) over its turns."""
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in turns.schema)
    return in_order(turns).mapInArrow(_positions, f"{schema}, first_token long")


def _read_back(path: str):
    state: list[Codec] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not state:
            state.append(Codec(path))
        for b in batches:
            t = b.to_pydict()
            got = [read_turn(state[0], i, (a, z)) for i, a, z in zip(t["ids"], t["loss_start"], t["loss_end"])]
            texts = [pa.array([g[k] for g in got], pa.string()) for k in range(3)]
            yield pa.RecordBatch.from_arrays([b.column("conv_id"), b.column("turn"), *texts, pa.array([g[3] for g in got], pa.int64()), pa.array([len(i) for i in t["ids"]], pa.int64())], names=["conv_id", "turn", "role", "text", "trained", "formatted", "tokens"])

    return run


def read_turns(turns: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Role, text, text under the loss mask and formatted length of every turn, read back from ids and mask."""
    kind = turns.schema["conv_id"].dataType.simpleString()
    return turns.mapInArrow(_read_back(vocabulary), f"conv_id {kind}, turn long, role string, text string, trained string, formatted long, tokens long")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    # a running digest per conversation: state of constant size whatever the number of turns
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_tokens"]
    kind, last, s = None, object(), None
    done: list[list] = [[] for _ in names]

    def close():
        if s is not None:
            for c, v in zip(done, (last, s[0], s[1].hexdigest(), s[2], s[3].hexdigest(), s[4], s[5])):
                c.append(v)

    def out() -> pa.RecordBatch:
        types = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
        made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(done, types)], names=names)
        for c in done:
            c.clear()
        return made

    for b in batches:
        kind = b.schema.field("conv_id").type
        t = b.to_pydict()
        for conv, role, text, trained, formatted, tokens in zip(t["conv_id"], t["role"], t["text"], t["trained"], t["formatted"], t["tokens"]):
            if s is None or conv != last:
                close()
                last, s = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
            s[0] += 1
            s[1].update(f"{role}\n{text}\n".encode())
            s[2] += len(trained)
            s[3].update(trained.encode())
            s[4] += formatted
            s[5] += tokens
        yield out()
    if s is not None:
        close()
        yield out()


def digest(read: DataFrame) -> DataFrame:
    """Per conversation: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_tokens. Conversations
    whose id is null are one conversation."""
    kind = read.schema["conv_id"].dataType.simpleString()
    ordered = read.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.mapInArrow(_digests, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_tokens long")
