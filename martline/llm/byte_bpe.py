"""Byte-level BPE with a local rank file.

``encode`` turns text into token ids, packed as little-endian unsigned 32-bit
integers; ``decode`` turns them back into the very bytes of the text. Long texts
are cut where the splitting pattern cuts anyway, at white space above all. Under
``PATTERN`` a run of white space of more than ``LONG`` characters is one match, less its
last character before other text; it is encoded by the ranks alone, as the pattern's
engine fails on it. Only a longer stretch without white space, or a long run under another
pattern, is seen whole.

Defined results: a null or empty text has no tokens; special tokens are not
known, their names are ordinary text. Columns of the input pass through; one
that is named like the output column is replaced by it.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martline.llm.common import column, free_name

LONG = 1 << 16
#: The pattern whose white-space runs are known to be one match.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Before a space that stands between text and a letter, and between a letter and a line
#: end: no match of a pattern that binds a space only to what follows it can span these.
_SAFE = regex.compile(r"(?<=\S)(?= \p{L})|(?<=[A-Za-z])(?=[\r\n])")
#: Under ``PATTERN`` no match goes from text into white space.
_SAFE_HERE = regex.compile(r"(?<=\P{White_Space})(?=\p{White_Space})|(?<=[A-Za-z\u4e00-\u9fa5])(?=[,.;:!?、。，；：！？])")


@lru_cache(maxsize=4)
def encoding(ranks: str, pattern: str) -> tiktoken.Encoding:
    """Loaded once per worker process."""
    with open(ranks, "rb") as file:
        table = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file if line.strip())}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=table, special_tokens={})


def _cut(text: str, start: int, end: int, long: int, safe: regex.Pattern) -> Iterator[str]:
    while end - start > long:
        cut = safe.search(text, start + long, end)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    if start < end:
        yield text[start:end]


def _parts(text: str, long: int, known_runs: bool) -> Iterator[tuple[str, bool]]:
    """``text`` in pieces, each with whether it is one match of white space."""
    start = 0
    if known_runs and len(text) > long:
        for run in regex.finditer(rf"(?<!\p{{White_Space}})\p{{White_Space}}{{{max(long, 1) + 1},}}+", text):
            yield from ((p, False) for p in _cut(text, start, run.start(), long, _SAFE_HERE))
            start = run.end() - (run.end() < len(text))
            yield text[run.start() : start], True
    yield from ((p, False) for p in _cut(text, start, len(text), long, _SAFE_HERE if known_runs else _SAFE))


def pieces(text: str, long: int = LONG) -> Iterator[str]:
    """``text`` in pieces of about ``long`` characters, cut at safe places of ``PATTERN`` only."""
    return (p for p, _ in _parts(text, long, True))


def encode_text(text: str | None, known: tiktoken.Encoding) -> bytes:
    parts = _parts(text or "", LONG, known._pat_str == PATTERN)
    ids = (known._encode_single_piece(p.encode()) if run else known.encode_ordinary(p) for p, run in parts)
    return b"".join(np.array(i, "<u4").tobytes() for i in ids)


def decode_ids(ids: bytes | None, known: tiktoken.Encoding, step: int = LONG) -> bytes:
    """Tokens are byte strings, so any cut between two ids is safe."""
    numbers = np.frombuffer(ids or b"", "<u4")
    return b"".join(known.decode_bytes(numbers[i : i + step].tolist()) for i in range(0, len(numbers), step))


def _binary(values: Iterable[bytes]) -> pa.Array:
    """A binary array, gathered in one buffer: a worker keeps what lists of a batch's values once took."""
    data, ends = bytearray(), [0]
    for value in values:
        data += value
        ends.append(len(data))
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(np.array(ends, np.int32)), pa.py_buffer(data)])


def encode(
    docs: DataFrame, ranks: str, pattern: str, text: str = "text", into: str = "tokens", checked: str | None = None
) -> DataFrame:
    """``docs`` with binary ``into``: the ids of the whole text.

    ``checked`` names a column that tells whether the ids decode to the bytes of the
    text; the decoded bytes of one text at a time are held for it.
    """

    @F.arrow_udf(T.BinaryType())
    def encoded(texts: pa.Array) -> pa.Array:
        known = encoding(ranks, pattern)
        return _binary(encode_text(t.as_py(), known) for t in texts)

    @F.arrow_udf(T.StructType([T.StructField("ids", T.BinaryType()), T.StructField("same", T.BooleanType())]))
    def encoded_and_checked(texts: pa.Array) -> pa.Array:
        known, same = encoding(ranks, pattern), []

        def ids() -> Iterator[bytes]:
            for t in texts:
                found = encode_text(whole := t.as_py() or "", known)
                same.append(decode_ids(found, known) == whole.encode())
                yield found

        return pa.StructArray.from_arrays([_binary(ids()), pa.array(same, pa.bool_())], names=["ids", "same"])

    if checked is None:
        return docs.withColumn(into, encoded(column(text)))
    both = free_name(docs, "encoded")
    made = docs.withColumn(both, encoded_and_checked(column(text)))
    return made.withColumns({into: column(both)["ids"], checked: column(both)["same"]}).drop(both)


def decode(docs: DataFrame, ranks: str, pattern: str, tokens: str = "tokens", into: str = "decoded") -> DataFrame:
    """``docs`` with binary ``into``: the bytes that the ids stand for."""

    @F.arrow_udf(T.BinaryType())
    def decoded(ids: pa.Array) -> pa.Array:
        known = encoding(ranks, pattern)
        return _binary(decode_ids(x.as_py(), known) for x in ids)

    return docs.withColumn(into, decoded(column(tokens)))
