"""Harmonic packing of token sequences.

A document's tokens are cut into pieces, each piece falls into the class ``k``
with ``capacity / (k + 1) < length <= capacity / k``, and a bin of class ``k``
takes exactly ``k`` pieces. Bins therefore need no search and no knowledge of
other workers: every task packs its own rows, and nothing is shuffled.

Plain harmonic packing wastes up to half of a bin whose pieces are just above
a class boundary. Since cutting is allowed, a piece of a class below
``FINE_CLASS`` is first cut down to exactly ``capacity // k`` tokens and its
tail is classed again; pieces of higher classes waste at most one part in
``FINE_CLASS + 1``. When a task ends, the pieces of its unfilled bins are laid
end to end and cut at the capacity; what is left of that is cut into powers of
two, which need no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type

#: Classes from here on are not cut to their boundary.
FINE_CLASS = 16
#: Fixed value: how byte_bpe_50k.json splits a text before merging.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

SCHEMA = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, class int"


def encoder(path: str, ranks: str | None = None):
    """A function from text to the bytes of its little-endian 32-bit ids.

    ``ranks`` may name the same vocabulary as a tiktoken file. That library
    gives the same ids several times faster; texts that hold a special token's
    string still go to the tokenizer, which alone knows those.
    """
    import base64

    import tiktoken
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    special = [t.content for t in model.get_added_tokens_decoder().values()]
    if ranks:
        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        ordinary = tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=table, special_tokens={}).encode_ordinary

    def encode(text: str) -> bytes:
        if ranks and not any(s in text for s in special):
            ids = ordinary(text)
        else:
            ids = model.encode(text, add_special_tokens=False).ids
        return np.asarray(ids, "<u4").tobytes()

    return encode


def cuts(tokens: int, capacity: int) -> list[tuple[int, int]]:
    """(length, class) of a document's pieces, in order."""
    found = [(capacity, 1)] * (tokens // capacity)
    rest = tokens % capacity
    while rest:
        k = capacity // rest
        if k >= FINE_CLASS or rest * k == capacity:
            found.append((rest, k))
            break
        size = capacity // (k + 1)
        found.append((size, capacity // size))
        rest -= size
    return found


class Packer:
    """The bins of one task. Emits rows of (doc, start, ids, doc_tokens, sequence, offset, class)."""

    def __init__(self, capacity: int, first_sequence: int):
        self.capacity, self.next = capacity, first_sequence
        self.open: dict[int, list[tuple]] = {}

    def _bin(self, pieces: list[tuple], k: int) -> list[tuple]:
        rows, offset = [], 0
        for doc, start, ids, total in pieces:
            rows.append((doc, start, ids, total, self.next, offset, k))
            offset += len(ids) // 4
        self.next += 1
        return rows

    def add(self, doc, ids: bytes) -> list[tuple]:
        rows, start, total = [], 0, len(ids) // 4
        for size, k in cuts(total, self.capacity):
            pieces = self.open.setdefault(k, [])
            pieces.append((doc, start, ids[4 * start : 4 * (start + size)], total))
            if len(pieces) == k:
                rows += self._bin(self.open.pop(k), k)
            start += size
        return rows

    def finish(self) -> list[tuple]:
        """The pieces of unfilled bins, cut at the capacity and then at powers of two; class 0."""
        rows, rest = [], [p for k in sorted(self.open) for p in self.open[k]]
        left = sum(len(p[2]) // 4 for p in rest)
        self.open = {}
        while left:
            size = self.capacity if left >= self.capacity else 1 << (left.bit_length() - 1)
            left -= size
            taken = []
            while size:
                doc, start, ids, total = rest[0]
                n = min(size, len(ids) // 4)
                taken.append((doc, start, ids[: 4 * n], total))
                rest[0] = (doc, start + n, ids[4 * n :], total)
                size -= n
                if not rest[0][2]:
                    rest.pop(0)
            rows += self._bin(taken, 0)
        return rows


def pack(docs: DataFrame, tokenizer: str, ranks: str | None = None, end_id: int = 1, capacity: int = 2048, with_ids: bool = False) -> DataFrame:
    """Pack ``docs`` (doc_id, text) into sequences of at most ``capacity`` tokens.

    One row a piece: where it lies in its document (``start``) and in its
    sequence (``offset``), its crc32 over little-endian 32-bit ids and, with
    ``with_ids``, the ids. ``class`` is the harmonic class, 0 for a task's last
    bins. A null or empty text is the end id alone. doc_ids may be of any
    type; null or repeated ones stay separate documents. Other columns are ignored. An empty table gives no
    rows. A task holds one batch of texts and at most one unfilled bin a class.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer, ranks), np.asarray([end_id], "<u4").tobytes()
        packer = Packer(capacity, TaskContext.get().partitionId() << 33)
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "class"]

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            columns = [[r[0] for r in rows], [r[1] for r in rows], [len(r[2]) // 4 for r in rows], [zlib.crc32(r[2]) for r in rows], [r[3] for r in rows], [r[4] for r in rows], [r[5] for r in rows], [r[6] for r in rows]]
            types = [kind, *[pa.int64()] * 6, pa.int32()]
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            ids = [pa.array([np.frombuffer(r[2], "<u4").astype(np.int32) for r in rows], pa.list_(pa.int32()))] if with_ids else []
            return pa.RecordBatch.from_arrays(arrays + ids, names + ["ids"] * with_ids)

        rows: list[tuple] = []
        held = 0
        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                new = packer.add(doc, encode(text.as_py() or "") + end)
                rows += new
                held += sum(len(r[2]) for r in new)
                if held > 1 << 23:
                    yield batch(rows)
                    rows, held = [], 0
        yield batch(rows + packer.finish())

    rows = docs.select("doc_id", docs["text"].cast("string"))
    kind = to_arrow_type(rows.schema["doc_id"].dataType)
    return rows.mapInArrow(work, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {SCHEMA}" + (", ids array<int>" if with_ids else ""))
