"""Chat formatting by columnar byte assembly.

Turns are put into segments "<|im_start|>role\\ntext<|im_end|>\\n" for a whole Arrow batch at once:
segment lengths, their running sums and scatter indices are computed in numpy, and headers, roles,
texts and ends are copied into one preallocated buffer, which becomes the Arrow column as it is. The
loss mask of a segment is the span of its text, for assistant turns.

A control string inside a text (or role) is broken after its first character by a backslash, and a
backslash is doubled; so is, in a role, a line feed broken. No control string is ever found inside a text, and reading
back gives the text exactly.

Turns are sorted by (conversation, turn) within partitions and go through as a stream: a conversation
is never gathered, however many turns it has. Its digests, which a hash over all its turns needs in
order, are carried from batch to batch.

Defined cases: a null text is empty; a null role is an empty role; a null turn comes first; rows of one
turn number are ordered by role, then text; a null conversation id is a conversation of its own; an
empty table gives no rows; a long text is copied whole; other columns are not touched.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import parquet, ship

START, MIDDLE, STOP = b"<|im_start|>", b"\n", b"<|im_end|>\n"
#: Control strings, by first character: the template's own and those of other common templates.
CONTROL = {"<": ("|im_start|>", "|im_end|>", "s>", "/s>", "|endoftext|>"), "[": ("INST]", "/INST]")}
TRAINED = "assistant"
#: Bytes of text that are assembled at once, and from which an item is copied without indices of its bytes.
SLICE, LONG = 1 << 20, 1 << 12


def escaped(texts: pa.Array) -> pa.Array:
    out = pc.replace_substring(texts, "\\", "\\\\")
    for first, rests in CONTROL.items():
        out = pc.replace_substring_regex(out, f"({re.escape(first)})({'|'.join(map(re.escape, rests))})", r"\1\\\2")
    return out


def unescaped(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    texts = texts.cast(pa.large_binary())
    at = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    return np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8), at


def scattered(out: np.ndarray, to: np.ndarray, data: np.ndarray, at: np.ndarray) -> None:
    """Copies item i of data, from at[i] to at[i+1], to out at to[i]: short ones by scatter indices, LONG ones each as they are."""
    size = np.diff(at)
    for i in np.flatnonzero(size > LONG).tolist():
        out[to[i] : to[i] + size[i]] = data[at[i] : at[i + 1]]
    short = np.flatnonzero(size <= LONG)
    size = size[short]
    step = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    out[np.repeat(to[short], size) + step] = data[np.repeat(at[:-1][short], size) + step]


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The segments of these turns as one column, and where, in bytes, the text of each begins and ends in its segment."""
    n = len(texts)
    role, role_at = _bytes_of(pc.replace_substring(escaped(roles), "\n", "\\\n"))
    text, text_at = _bytes_of(escaped(texts))
    begin = len(START) + np.diff(role_at) + len(MIDDLE)
    end = begin + np.diff(text_at)
    offsets = np.zeros(n + 1, dtype=np.int64)
    np.cumsum(end + len(STOP), out=offsets[1:])
    out = np.empty(int(offsets[-1]), dtype=np.uint8)
    for fixed, to in ((START, offsets[:-1]), (MIDDLE, offsets[:-1] + begin - len(MIDDLE)), (STOP, offsets[:-1] + end)):
        out[to[:, None] + np.arange(len(fixed))] = np.frombuffer(fixed, dtype=np.uint8)
    scattered(out, offsets[:-1] + len(START), role, role_at)
    scattered(out, offsets[:-1] + begin, text, text_at)
    return pa.LargeStringArray.from_buffers(n, pa.py_buffer(offsets), pa.py_buffer(out)), begin, end


def _formatted(batches):
    """conv_id, segment, loss_from, loss_to (bytes, null outside of the loss) of each turn, in bounded pieces."""
    for whole in batches:
        ends, i = np.cumsum(pc.fill_null(pc.binary_length(whole.column(2)), 0).to_numpy().astype(np.int64)), 0
        while i < whole.num_rows:  # some SLICE bytes of text at a time, one turn at least
            stop = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + SLICE, side="right")))
            batch, i = whole.slice(i, min(stop, i + 1024) - i), min(stop, i + 1024)
            roles, texts = (pc.fill_null(batch.column(k), "") for k in (1, 2))
            segments, begin, end = assemble(roles, texts)
            mask = pc.invert(pc.equal(roles, TRAINED)).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([batch.column(0), segments.cast(pa.string()), pa.array(begin, mask=mask), pa.array(end, mask=mask)], names=["conv_id", "segment", "loss_from", "loss_to"])


def read_back(segment: str) -> tuple[str, str]:
    """(role, text) of a segment."""
    inner = segment[len(START) : -len(STOP)]
    role = re.match(r"(?:[^\\\n]|\\.)*", inner, flags=re.S)[0]
    return unescaped(role), unescaped(inner[len(role) + len(MIDDLE) :])


class Digest:
    """What a conversation comes to, turn by turn."""

    def __init__(self, conv):
        self.conv, self.turns, self.loss_chars, self.chars = conv, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, segment: str, loss_from: int | None, loss_to: int | None) -> None:
        role, text = read_back(segment)
        self.turns += 1
        self.chars += len(segment)
        self.all.update(f"{role}\n{text}\n".encode())
        if loss_from is not None:
            under = unescaped(segment.encode()[loss_from:loss_to].decode())
            self.loss_chars += len(under)
            self.loss.update(under.encode())

    def row(self) -> tuple:
        return self.conv, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


DIGEST = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def _digested(batches):
    """One row per conversation of a sorted stream of formatted turns."""
    now, done = None, []
    for batch in batches:
        for conv, segment, a, b in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if now is None or conv != now.conv:
                if now is not None:
                    done.append(now.row())
                now = Digest(conv)
            now.add(segment, a, b)
        if len(done) >= 1000:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), DIGEST.types, strict=True)], schema=DIGEST)
            done = []
    if now is not None:
        done.append(now.row())
    if done:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), DIGEST.types, strict=True)], schema=DIGEST)


def sorted_turns(rows: DataFrame) -> DataFrame:
    turns = rows.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"), F.col("turn").alias("turn"))
    return turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")


def format_turns(rows: DataFrame) -> DataFrame:
    """One row per turn, in order within its conversation: conv_id, segment, loss_from, loss_to. A conversation is its segments end to end."""
    ship(rows.sparkSession)
    return sorted_turns(rows).mapInArrow(_formatted, "conv_id bigint, segment string, loss_from bigint, loss_to bigint")


def digests(formatted: DataFrame) -> DataFrame:
    """One row per conversation, read back from the formatted turns; their partitions and order are used as they are."""
    return formatted.mapInArrow(_digested, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")


def op8_columnar_chat(spark, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string")
    rows = parquet(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    return digests(format_turns(rows))


OP8_SQL = r"""
with c as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]' union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), e as (
  select *, length(regexp_replace(replace(text, '\', '\\'), '<(\|im_start\|>|\|im_end\|>|s>|/s>|\|endoftext\|>)|\[(/?INST\])', '@@\1\2', 'g')) as n_text from c
)
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       cast(sum(case when role = 'assistant' then length(text) else 0 end) as bigint) as loss_chars,
       sha256(coalesce(string_agg(case when role = 'assistant' then text end, '' order by turn, role, text), '')) as loss_sha256,
       cast(sum(12 + length(role) + 1 + n_text + 11) as bigint) as formatted_chars
from e group by conv_id
"""
