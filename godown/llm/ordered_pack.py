"""Order-preserving packing (9): dynamic programming over cuts at document and sentence ends.

Documents keep the order in which they are read, one after the other, and the run of their tokens is cut into windows
of at most ``capacity``. A cut costs nothing at a document's end, a little at a sentence's end and more inside
a sentence (only offered where a sentence is longer than a window); a window costs its padding. A window of a power
of two tokens is not padded, so it costs none. Padding of the other windows is ``capacity - length``, so the
best window start is a sliding minimum of cost + position, kept in a monotone queue.

Each task packs what it reads, in blocks; the last window of a block is left open for the next one.
"""

from __future__ import annotations

from collections import deque
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from godown.llm.byte_bpe import token_bytes
from godown.llm.pretok import ranks_for, text_batches

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
SEQUENCE_TOKENS = 2048
END_ID = 1
BLOCK_TOKENS = 4_000_000
#: Costs in tokens: of a window, of a cut at a sentence's end, of a cut inside a sentence.
WINDOW_COST, SENTENCE_COST, INSIDE_COST = 32, 16, 256
#: Inside sentences longer than a window, cuts are offered after every so many tokens.
INSIDE_STEP = 32
SCHEMA = ("doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


@lru_cache(2)
def sentence_tables(vocabulary: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per id: ends in . ! or ? (closing marks aside); holds a line end; begins with white space."""
    text = [t.decode("utf-8", "replace") for t in token_bytes(vocabulary)]
    stop = np.array([t.rstrip("\"')]»”’").endswith((".", "!", "?", "…")) for t in text])
    return stop, np.array(["\n" in t for t in text]), np.array([t[:1].isspace() for t in text])


def sentence_ends(ids: np.ndarray, tables) -> np.ndarray:
    """Positions after the ids that end a sentence: a stop before white space, or a line end."""
    stop, line, space = tables
    if len(ids) < 2:
        return np.zeros(0, np.int64)
    return np.flatnonzero((stop[ids[:-1]] & space[ids[1:]]) | line[ids[:-1]]) + 1


def cut_windows(position: np.ndarray, penalty: np.ndarray, capacity: int) -> list[int]:
    """Indexes into ``position`` (0 first, the end last) of the cuts with the least total cost.

    ``position`` rises by at most ``capacity`` a step. Ties go to the longer window.
    """
    n = len(position)
    hits: list[list[int]] = [[] for _ in range(n)]  # starts of windows of a power of two tokens
    for k in range(capacity.bit_length()):
        want = position - (1 << k)
        i = np.searchsorted(position, want)
        for j in np.flatnonzero((want >= 0) & (position[np.minimum(i, n - 1)] == want)).tolist():
            hits[j].append(int(i[j]))
    pos, pen = position.tolist(), penalty.tolist()
    best, back = [0] * n, [0] * n
    queue: deque[int] = deque()  # rising start, rising best + position
    for j in range(1, n):
        key = best[j - 1] + pos[j - 1]
        while queue and best[queue[-1]] + pos[queue[-1]] > key:
            queue.pop()
        queue.append(j - 1)
        while pos[j] - pos[queue[0]] > capacity:
            queue.popleft()
        i = queue[0]
        cost = best[i] + pos[i] - pos[j] + capacity
        for h in hits[j]:
            if best[h] < cost or best[h] == cost and h < i:
                cost, i = best[h], h
        best[j], back[j] = cost + pen[j] + WINDOW_COST, i
    cuts, j = [], n - 1
    while j:
        cuts.append(j)
        j = back[j]
    return [0, *cuts[::-1]]


def candidates(docs: list[tuple], tables, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions at which the run of documents may be cut, and what each cut costs."""
    positions, penalties, base = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)], 0
    for _, _, _, ids in docs:
        ends = sentence_ends(ids[:-1], tables)
        gaps = np.diff(np.concatenate([[0], ends, [len(ids)]]))
        inside = [np.arange(s + INSIDE_STEP, s + g, INSIDE_STEP) for s, g in
                  zip(np.concatenate([[0], ends])[gaps > capacity], gaps[gaps > capacity], strict=True)]
        own = np.concatenate([ends, *inside, [len(ids)]]).astype(np.int64)
        cost = np.full(len(own), SENTENCE_COST)
        cost[len(ends):] = INSIDE_COST
        cost[-1] = 0
        order = np.argsort(own, kind="stable")
        positions.append(own[order] + base)
        penalties.append(cost[order])
        base += len(ids)
    return np.concatenate(positions), np.concatenate(penalties)


def _windows(docs: list[tuple], tables, capacity: int, last: bool) -> tuple[list[list[tuple]], list[tuple]]:
    """Windows as lists of (doc, start, ids, doc_tokens), and the documents left over for the next block."""
    position, penalty = candidates(docs, tables, capacity)
    cuts = position[cut_windows(position, penalty, capacity)]
    if not last:
        cuts = cuts[:-1]  # the open window
    base = np.concatenate([[0], np.cumsum([len(d[3]) for d in docs])])
    out = []
    for a, z in zip(cuts.tolist(), cuts[1:].tolist(), strict=False):
        d, pieces = int(np.searchsorted(base, a, "right")) - 1, []
        while d < len(docs) and base[d] < z:
            doc, total, start, ids = docs[d]
            lo, hi = max(0, a - int(base[d])), min(len(ids), z - int(base[d]))
            pieces.append((doc, start + lo, ids[lo:hi], total))
            d += 1
        out.append(pieces)
    z = int(cuts[-1])
    d = int(np.searchsorted(base, z, "right")) - 1
    rest = [(doc, total, start + max(0, z - int(base[d + k])), ids[max(0, z - int(base[d + k])):])
            for k, (doc, total, start, ids) in enumerate(docs[d:])]
    return out, rest


def pack_ordered(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY,
                 capacity: int = SEQUENCE_TOKENS, end_id: int = END_ID, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (unsigned 32-bit little-endian), doc_tokens, sequence_id, offset.

    Every document ends with ``end_id``, so a null or empty text is that one token. Each id lies in exactly one
    piece, and pieces follow the order of the rows read by a task; sequence ids are unique, by partition, and
    rise in that order. Repeated rows and null ids are packed like any other; an empty table gives no piece.
    """
    def emit(windows, first):
        flat = [(doc, start, ids, total, first + n, offset) for n, pieces in enumerate(windows)
                for (doc, start, ids, total), offset in
                zip(pieces, np.concatenate([[0], np.cumsum([len(p[2]) for p in pieces])]).tolist(), strict=False)]
        for k in range(0, len(flat), 4096):
            doc, start, ids, total, sequence, offset = zip(*flat[k:k + 4096], strict=True)
            yield pa.record_batch(
                [pa.array(doc, pa.int64()), pa.array(start, pa.int64()), pa.array([len(x) for x in ids], pa.int64()),
                 pa.array([x.astype("<u4", copy=False).tobytes() for x in ids], pa.binary()), pa.array(total, pa.int64()),
                 pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())],
                names=[f.split()[0] for f in SCHEMA.split(", ")])

    def run(batches):
        encode, tables = ranks_for(vocabulary), sentence_tables(vocabulary)
        first, block, size = TaskContext.get().partitionId() << 33, [], 0
        for b in batches:
            texts, doc_ids = b.column(1).to_pylist(), b.column(0).to_pylist()
            for i, j in text_batches(texts, 4_000_000):
                for d, t in zip(doc_ids[i:j], texts[i:j], strict=True):
                    ids = np.append(encode(t) if t else np.zeros(0, np.uint32), np.uint32(end_id))
                    block.append((d, len(ids), 0, ids))
                    size += len(ids)
                if size >= block_tokens:
                    windows, block = _windows(block, tables, capacity, False)
                    size = sum(len(d[3]) for d in block)
                    yield from emit(windows, first)
                    first += len(windows)
        if block:
            yield from emit(_windows(block, tables, capacity, True)[0], first)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, SCHEMA)


def op9_ordered_pack(spark, sf_dir: str) -> DataFrame:
    return pack_ordered(spark.read.parquet(f"{sf_dir}/documents.parquet")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
