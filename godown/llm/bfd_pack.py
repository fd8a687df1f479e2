"""Best-fit-decreasing packing (1): token ids into sequences of one length, written as binary matrices.

Each task packs the blocks of documents it reads, so no row is shuffled: within a block, documents are cut
losslessly into full sequences and a rest, the rests go in decreasing length into the fullest open sequence that
still holds them, found in a segment tree over the free capacities. A block of some million tokens fills its
sequences but for a few; the padding does not depend on how many blocks there are beyond one open end a block.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from godown.llm.pretok import ranks_for, text_batches, words_for
from godown.session import checkpoint_dir

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
SEQUENCE_TOKENS = 2048
#: Tokens packed together: the memory of a task.
BLOCK_TOKENS = 8_000_000
END_ID = 50256
SCHEMA = ("sequence_id long, n_tokens int, input_ids binary, position_ids binary, cu_seqlens array<int>, "
          "doc_ids array<long>, starts array<long>, doc_tokens array<long>")


class CapacityTree:
    """Open sequences by free capacity: a segment tree that counts them, and a stack of them per capacity."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)
        self.open: list[list[int]] = [[] for _ in range(self.size)]

    def _add(self, free: int, by: int) -> None:
        i = free + self.size
        while i:
            self.count[i] += by
            i >>= 1

    def put(self, free: int, sequence: int) -> None:
        self.open[free].append(sequence)
        self._add(free, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """The sequence with the least free capacity of at least ``need``, and that capacity."""
        i, count = need + self.size, self.count
        if not count[i]:
            while i > 1 and (i & 1 or not count[i + 1]):  # up until a right neighbour holds one
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.size:
                i = 2 * i if count[2 * i] else 2 * i + 1
        free = i - self.size
        self._add(free, -1)
        return self.open[free].pop(), free


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Items (by index) of each sequence; no length may exceed the capacity, and equal ones go by index."""
    tree, out = CapacityTree(capacity), []
    for k in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        n = lengths[k]
        found = tree.take(n) if n < capacity else None
        if found is None:
            found = len(out), capacity
            out.append([])
        out[found[0]].append(k)
        if found[1] > n:
            tree.put(found[1] - n, found[0])
    return out


def _pack_block(docs: list[tuple], first: int, capacity: int, dtype, pad: int) -> pa.RecordBatch:
    pieces = [(d, at) for d, (_, ids) in enumerate(docs) for at in range(0, len(ids), capacity)]
    size = [min(capacity, len(docs[d][1]) - at) for d, at in pieces]
    columns: list[list] = [[] for _ in range(8)]
    for n, members in enumerate(best_fit_decreasing(size, capacity)):
        row = np.full(capacity, pad, dtype)
        position = np.zeros(capacity, "<u4")
        cu = [0]
        for k in members:
            d, at = pieces[k]
            row[cu[-1]:cu[-1] + size[k]] = docs[d][1][at:at + size[k]]
            position[cu[-1]:cu[-1] + size[k]] = np.arange(size[k])
            cu.append(cu[-1] + size[k])
        for c, v in zip(columns, (first + n, cu[-1], row.tobytes(), position.astype("<u2").tobytes(), cu,
                                  [docs[pieces[k][0]][0] for k in members], [pieces[k][1] for k in members],
                                  [len(docs[pieces[k][0]][1]) for k in members]), strict=True):
            c.append(v)
    types = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int32()), *[pa.list_(pa.int64())] * 3]
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                           names=[f.split()[0] for f in SCHEMA.split(", ")])


def pack_bfd(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY,
             capacity: int = SEQUENCE_TOKENS, end_id: int = END_ID, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """One row per sequence of ``capacity`` tokens: its id row and position resets (binary, little-endian),
    the cumulative segment lengths, and whose tokens each segment holds from which start.

    Every document ends with ``end_id``, so a null or empty text is that one token. Overlong documents are cut
    every ``capacity`` tokens and nothing is lost. Positions start at 0 in each segment. Unused places hold
    ``end_id``. Ids take 2 bytes up to a vocabulary of 65,536, else 4; positions 2 bytes. Sequence ids are unique,
    by partition. Repeated rows and null ids are packed like any other; an empty table gives no sequence.
    """
    def run(batches):
        encode = ranks_for(vocabulary)
        first, block, size = TaskContext.get().partitionId() << 33, [], 0
        for b in batches:
            texts, ids = b.column(1).to_pylist(), b.column(0).to_pylist()
            for i, j in text_batches(texts, 4_000_000):
                for d, t in zip(ids[i:j], texts[i:j], strict=True):
                    own = np.append(encode(t) if t else np.zeros(0, np.uint32), np.uint32(end_id)).astype(dtype)
                    block.append((d, own))
                    size += len(own)
                if size >= block_tokens:
                    out = _pack_block(block, first, capacity, dtype, end_id)
                    first, block, size = first + out.num_rows, [], 0
                    yield from (out.slice(k, 512) for k in range(0, out.num_rows, 512))
        if block:
            out = _pack_block(block, first, capacity, dtype, end_id)
            yield from (out.slice(k, 512) for k in range(0, out.num_rows, 512))

    if capacity > 1 << 16:
        raise ValueError("positions take 2 bytes: a capacity of 65,536 at most")
    n_ids = max(words_for(vocabulary).tokenizer.get_vocab_size(), end_id + 1)
    dtype = np.dtype("<u2" if n_ids <= 1 << 16 else "<u4")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, SCHEMA)


def write_packed(packed: DataFrame, path: str) -> DataFrame:
    """Write the sequences as a Parquet table (a binary matrix row each) and return the written table."""
    packed.write.mode("error").option("compression", "zstd").parquet(path)
    return packed.sparkSession.read.schema(packed.schema).parquet(path)


def unpack(packed: DataFrame) -> DataFrame:
    """One row per segment, read back from the binary rows: whose it is, where it lies, and a CRC-32 of its ids
    as unsigned 32-bit. Checks that the positions restart at 0 in each segment."""
    def run(batches):
        for b in batches:
            out: list[list] = [[] for _ in range(9)]
            for r in b.to_pylist():
                cu = r["cu_seqlens"]
                position = np.frombuffer(r["position_ids"], "<u2")
                ids = np.frombuffer(r["input_ids"], f"<u{len(r['input_ids']) // len(position)}").astype("<u4")
                for k, (a, z) in enumerate(zip(cu, cu[1:], strict=False)):
                    resets = bool(np.array_equal(position[a:z], np.arange(z - a, dtype="<u2")))
                    for c, v in zip(out, (r["doc_ids"][k], r["starts"][k], z - a, zlib.crc32(ids[a:z].tobytes()),
                                          r["doc_tokens"][k], r["sequence_id"], a, k, resets), strict=True):
                        c.append(v)
            types = [pa.int64()] * 8 + [pa.bool_()]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=names)

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "segment", "position_reset"]
    return packed.mapInArrow(run, ", ".join(f"{n} long" for n in names[:-1]) + ", position_reset boolean")


def op1_bfd_pack(spark, sf_dir: str) -> DataFrame:
    path = f"{checkpoint_dir(spark).rstrip('/')}/packed-{uuid.uuid4().hex}"
    return unpack(write_packed(pack_bfd(spark.read.parquet(f"{sf_dir}/documents.parquet")), path))
