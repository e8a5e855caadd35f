"""SentencePiece encoding and decoding by a table of distinct chunks.

Text is normalised the way the model does it (a space becomes the mark U+2581,
one mark is put in front) and cut before every run of marks. If no piece of
the vocabulary holds a mark after another character, no merge can cross such a
cut, so every chunk is segmented alone. Each batch holds a table of its
distinct chunks: the library segments a chunk once, and ids are joined back by
the chunks' positions. The table lives in the task: a table of the whole
corpus would have to be joined to every word by a shuffle of every word.

A vocabulary that breaks the condition, lacks byte pieces (so that characters may
be unknown) or has a normalisation of its own is encoded text by text.

Null text counts as empty and has no ids. Repeated rows, ties and extra columns
do not matter: the functions work on one column.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from basketry.llm.common import ranges, strings, structs

MARK = "▁"
CHUNK = re.compile(f"{MARK}+[^{MARK}]*")
#: Distinct chunks a worker remembers between batches; beyond it the table starts anew (no effect on results). About 6 MB,
#: which stay with the worker when its task ends.
REMEMBERED = 30_000
#: Characters taken up at once.
GROUP = 1 << 18



def _bytes_of(model, i: int) -> bytes:
    """What one id stands for in decoded text."""
    piece = model.id_to_piece(i)
    if model.is_byte(i):
        return bytes([int(piece[3:5], 16)])
    return b"" if model.is_control(i) else piece.replace(MARK, " ").encode()


class Codec:
    """A model with the table of chunks met so far; ids of a chunk are kept as comma-joined text."""

    def __init__(self, model: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model)
        ids = range(self.model.get_piece_size())
        pieces = list(map(self.model.id_to_piece, ids))
        crossing = any(MARK in p.lstrip(MARK) for p in pieces)
        plain = all(self.model.encode(t, out_type=str) == e for t, e in ((" ", [MARK * 2]), ("ﬁ", [MARK, "ﬁ"])))
        self.by_chunk = plain and any(map(self.model.is_byte, ids)) and not crossing and MARK in pieces
        self.bytes = {str(i): _bytes_of(self.model, i) for i in ids}
        self.digits = list(map(str, ids))
        self.table: dict[str, str] = {}

    def learn(self, chunks: set[str]) -> None:
        new = list(chunks - self.table.keys())
        digits, lone = self.digits.__getitem__, self.digits[self.model.piece_to_id(MARK)]
        # the library puts one mark in front; it gives no ids for an empty text
        ids = self.model.encode([c[1:] for c in new], num_threads=1)
        self.table.update(zip(new, [",".join(map(digits, i)) or lone for i in ids]))

    def encode(self, texts: list[str]) -> Iterator[str]:
        """The comma-joined ids of each text; texts are taken up in groups of about GROUP characters."""
        group, size = [], 0
        for text in texts:
            group.append(text)
            size += len(text)
            if size >= GROUP:
                yield from self._group(group)
                group, size = [], 0
        yield from self._group(group)

    def _group(self, texts: list[str]) -> Iterator[str]:
        if not self.by_chunk:
            yield from (",".join(map(str, self.model.encode(t))) for t in texts)
            return
        cut = [CHUNK.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        if len(self.table) > REMEMBERED:
            self.table.clear()
        self.learn(set(chain.from_iterable(cut)))
        known = self.table.__getitem__
        for chunks in cut:
            yield ",".join(map(known, chunks))

    def decode(self, joined: str) -> bytes:
        """What the library's decode gives for comma-joined ids, as UTF-8."""
        if not joined:
            return b""
        if not self.by_chunk:
            return self.model.decode(list(map(int, joined.split(",")))).encode()
        return b"".join(map(self.bytes.__getitem__, joined.split(","))).removeprefix(b" ")


@lru_cache(maxsize=2)
def codec(model: str) -> Codec:
    return Codec(model)


DIGEST = pa.struct([("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def _sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def digest(text: Column, model: str) -> Column:
    """Struct of the number of ids, the digest of the ids and the digest of the decoded text."""

    @F.arrow_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def run(column: pa.Array) -> pa.Array:
        own = codec(model)
        return structs(DIGEST, (
            (joined.count(",") + bool(joined), _sha(joined.encode()), _sha(own.decode(joined)))
            for joined in own.encode(strings(column))))

    return run(text)


def _lists(rows: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    return pa.ListArray.from_arrays(ends, pa.array(np.concatenate([np.zeros(0, np.int32), *rows])))


def _numbers(joined: str) -> np.ndarray:
    return np.fromstring(joined, np.int32, sep=",")


def encode(text: Column, model: str) -> Column:
    """Array of ids."""

    @F.arrow_udf("array<int>")
    def run(column: pa.Array) -> pa.Array:
        own = codec(model)
        return _lists([_numbers(j) for a, b in ranges(column) for j in own.encode(strings(column[a:b]))])

    return run(text)


def decode(ids: Column, model: str) -> Column:
    """Text of an array of ids; null and empty arrays give an empty text."""

    @F.arrow_udf("string")
    def run(column: pa.Array) -> pa.Array:
        library = codec(model).model
        rows = (column[i].values for i in range(len(column)))  # one row's numbers as Python objects at a time
        return pa.array([library.decode(v.to_pylist()) if v is not None and len(v) else "" for v in rows], pa.string())

    return run(ids)


def round_trip(text: Column, model: str) -> Column:
    """Struct of the ids and whether they decode to the text."""

    @F.arrow_udf("ids array<int>, decodes boolean")
    def run(column: pa.Array) -> pa.Array:
        own, rows, same = codec(model), [], []
        for a, b in ranges(column):
            texts = strings(column[a:b])
            for given, joined in zip(texts, own.encode(texts)):
                rows.append(_numbers(joined))
                same.append(own.decode(joined) == given.encode())
        return pa.StructArray.from_arrays([_lists(rows), pa.array(same, pa.bool_())], names=["ids", "decodes"])

    return run(text)
