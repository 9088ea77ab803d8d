"""Chat formatting with offset-aligned loss masks.

A conversation is rendered whole, encoded once with character offsets, and the
sorted spans of its turns are intersected with the sorted token spans by binary
search. A token carries loss where its characters meet an assistant text; its
``loss_start`` and ``loss_end`` give the part that does (a token may also hold
characters of the markup around it).

Template, for each turn: ``<|turn|>role\\n`` text ``<|end|>\\n``. Inside texts and
roles ``\\`` becomes ``\\\\`` and ``<|`` becomes ``<\\|``, so no text can hold a mark,
and the original comes back; in roles a line break becomes ``\\n`` as two characters.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kontor.llm.common import per_row

TOKENIZER = "byte_bpe_50k.json"
ASSISTANT = "assistant"
TURN, END = "<|turn|>", "<|end|>"
# Conversations encoded by one call.
BATCH = 32

FORMATTED = (
    "formatted string, token_ids array<int>, token_start array<int>, token_end array<int>, "
    "loss_mask array<boolean>, loss_start array<int>, loss_end array<int>"
)


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return re.sub(r"\\([\\|n])", lambda m: "\n" if m[1] == "n" else m[1], text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the spans of its assistant texts, in order."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head = f"{TURN}{escape(role).replace('\n', '\\n')}\n"
        body = escape(text)
        if role == ASSISTANT and body:
            spans.append((at + len(head), at + len(head) + len(body)))
        out += [head, body, END, "\n"]
        at += len(head) + len(body) + len(END) + 1
    return "".join(out), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns (role, text) of a formatted conversation."""
    turns = []
    for part in formatted.split(TURN)[1:]:
        head, _, rest = part.partition("\n")
        turns.append((unescape(head), unescape(rest[: rest.rindex(END)])))
    return turns


@lru_cache(maxsize=4)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    from tokenizers.processors import ByteLevel

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    t.no_truncation()
    t.no_padding()
    t.post_processor = ByteLevel(trim_offsets=False)  # white space belongs to its token's span
    return t


def align(offsets: list[tuple[int, int]], spans: list[tuple[int, int]]) -> tuple[np.ndarray, ...]:
    """(start, end, loss_start, loss_end) of each token; an empty intersection where it has no loss.

    Both lists are sorted, spans do not meet. A token's first span is the first
    that ends after the token starts; a token over several spans gets the first.
    """
    at = np.array(offsets, np.int32).reshape(-1, 2)
    start, end = at[:, 0], at[:, 1]
    if not spans:
        return start, end, start, start
    s = np.array(spans, np.int32)
    k = np.searchsorted(s[:, 1], start, side="right")
    inside = np.minimum(k, len(s) - 1)
    low, high = np.maximum(start, s[inside, 0]), np.minimum(end, s[inside, 1])
    none = (k == len(s)) | (high <= low)
    return start, end, np.where(none, start, low), np.where(none, start, high)


def format_conversations(
    conversations: DataFrame,
    tokenizer: str | None = None,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """One row for each conversation: conv_id and the columns of ``FORMATTED``.

    Rows of one conv_id are its turns, by turn (null first; ties by role, then
    text, null first; equal rows stay as often as they come). Null roles and texts
    are empty. Rows without conv_id are one conversation. No rows give no rows;
    other columns are ignored. ``tokenizer`` is the path of a tokenizers file; by
    default that of ``TOKENIZER`` among the public tokenizers. A conversation is
    assembled from sorted rows as they pass, so a task holds one at a time.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructField, StructType

    path, batch_size = tokenizer, BATCH
    schema = StructType(
        [StructField("conv_id", conversations.schema[conv_id].dataType), *StructType.fromDDL(FORMATTED).fields]
    )
    arrow = to_arrow_schema(schema)

    def encoded(found: list[tuple[object, list[tuple[str, str]]]]) -> pa.RecordBatch:
        if path is None:
            import public_tokenizers

            t = _tokenizer(public_tokenizers.path(TOKENIZER))
        else:
            t = _tokenizer(path)
        made = [render(turns) for _, turns in found]
        rows = []
        for (cid, _), (whole, spans), e in zip(
            found, made, t.encode_batch([m[0] for m in made], add_special_tokens=False)
        ):
            start, end, low, high = align(e.offsets, spans)
            rows.append((cid, whole, e.ids, start, end, high > low, low, high))
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready: list[tuple[object, list[tuple[str, str]]]] = []
        for batch in batches:
            for cid, r, x in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2))):
                if not ready or ready[-1][0] != cid:
                    if len(ready) >= batch_size:
                        yield encoded(ready)
                        ready = []
                    ready.append((cid, []))
                ready[-1][1].append((r or "", x or ""))
        if ready:
            yield encoded(ready)

    rows = conversations.select(
        F.col(f"`{conv_id}`").alias("conv_id"),
        F.col(f"`{turn}`").alias("turn"),
        F.col(f"`{role}`").alias("role"),
        F.col(f"`{text}`").alias("text"),
    )
    return (
        rows.repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .select("conv_id", "role", "text")
        .mapInArrow(work, schema)
    )


def _loss_text(formatted: str, mask: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> str:
    """The text under the mask: the union of the tokens' parts, in order (tokens that
    share a character, as bytes of one, count it once)."""
    low, high = starts[mask], np.maximum.accumulate(ends[mask])
    if not len(low):
        return ""
    low = np.maximum(low, np.concatenate([[0], high[:-1]]))
    new = np.concatenate([[True], low[1:] > high[:-1]])  # a part that does not adjoin the one before
    first = np.nonzero(new)[0]
    last = np.append(first[1:], len(low)) - 1
    return unescape("".join(formatted[a:b] for a, b in zip(low[first].tolist(), high[last].tolist())))


def _read_back(c: dict[str, list]) -> dict[str, list]:
    out = {k: [] for k in ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")}
    for formatted, mask, starts, ends in zip(c["formatted"], c["loss_mask"], c["loss_start"], c["loss_end"]):
        turns, loss = parse(formatted), _loss_text(formatted, mask, starts, ends)
        out["n_turns"].append(len(turns))
        out["turns_sha256"].append(hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest())
        out["loss_chars"].append(len(loss))
        out["loss_sha256"].append(hashlib.sha256(loss.encode()).hexdigest())
        out["formatted_chars"].append(len(formatted))
    return out


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), read
    from the formatted text and the mask alone."""
    return per_row(
        formatted.select("conv_id", "formatted", "loss_mask", "loss_start", "loss_end"),
        ["formatted", "loss_mask", "loss_start", "loss_end"],
        _read_back,
        "n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint",
        slice_rows=64,
    )
