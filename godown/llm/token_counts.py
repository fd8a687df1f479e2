"""Token counts (10): pieces counted once per distinct pre-token, joined to per-document frequencies.

Two passes over the texts. The first gives the distinct pre-tokens, each of which the library encodes once.
The second gives, per block of documents and pre-token, one row with the packed list of (document, frequency). The
two meet in a join on the pre-token; a frequent pre-token has one row a block, and Spark splits skewed joins.
Sums follow, pre-aggregated and packed, one group a block (its size is bounded by the block). Pre-tokens that are entries of the vocabulary (a fixed table) are counted in
the second pass itself. No ids are kept, and nothing goes through the driver.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from godown.llm.pretok import Splitter, byte_chars, special_tokens, text_batches, words_for

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
#: Characters of text, and documents, whose pre-tokens are listed together (memory of a task, not a limit on anything).
BLOCK_CHARS, BLOCK_DOCS = 32_000_000, 65_535
#: Postings that a task adds up before it passes their sums on.
HELD_POSTINGS = 4_000_000


@lru_cache(2)
def known_words(vocabulary: str) -> dict[str, int]:
    """Pieces of those pre-tokens that are entries of the vocabulary, as the library counts them."""
    tokenizer = words_for(vocabulary).tokenizer
    byte_of = {c: b for b, c in enumerate(byte_chars())}
    specials = special_tokens(vocabulary)
    words = []
    for t in tokenizer.get_vocab():
        try:
            words.append(t if t in specials else bytes(byte_of[c] for c in t).decode())
        except UnicodeDecodeError:
            continue
    return {w: len(e.ids) for w, e in zip(words, tokenizer.encode_batch_fast(words, add_special_tokens=False), strict=True)}


def _distinct(vocabulary: str):
    def run(batches):
        splitter, known = Splitter(special_tokens(vocabulary)), known_words(vocabulary)

        def words(chunks):
            own = {w for c in chunks for w in splitter.split(c) if w not in known}
            return pa.record_batch([pa.array(list(own), pa.string())], names=["word"])

        chunks: set[str] = set()
        for b in batches:
            for t in b.column(0).to_pylist():
                chunks.update(splitter.chunks(t) if t else ())
                if len(chunks) > 400_000:
                    yield words(chunks)
                    chunks = set()
        yield words(chunks)
    return run


def _count(vocabulary: str):
    def run(batches):
        tokenizer = words_for(vocabulary).tokenizer
        for b in batches:
            got = tokenizer.encode_batch_fast(b.column(0).to_pylist(), add_special_tokens=False)
            n = np.fromiter((len(e.ids) for e in got), np.int64, b.num_rows)
            yield pa.record_batch([b.column(0), pa.array(n)], names=["word", "pieces"])
    return run


def _flat(lists: Iterable[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All numbers, and where each list starts."""
    arrays = [np.array(x, np.int32) for x in lists]
    return np.concatenate(arrays) if arrays else np.zeros(0, np.int32), np.concatenate([[0], np.cumsum([len(x) for x in arrays])])


def _block(ids: list, texts: list, base: int, splitter: Splitter, known: dict[str, int]):
    """Rows (word, base, packed) of a block. ``packed`` holds the documents as 16-bit numbers, then as many frequencies of
    one byte (a larger one takes several places). A word of its own, which no text can hold, carries id, bytes and known pieces
    of every document.
    """
    if len(texts) > 1 << 16:
        raise ValueError("a block numbers its documents with 16 bits")
    chunk_no: dict[str, int] = {}
    chunk, doc_at = _flat([chunk_no.setdefault(c, len(chunk_no)) for c in splitter.chunks(t)] if t else [] for t in texts)
    doc = np.repeat(np.arange(len(texts)), np.diff(doc_at))
    word_no: dict[str, int] = {}
    word, word_at = _flat([word_no.setdefault(w, len(word_no)) for w in splitter.split(c)] for c in chunk_no)
    del chunk_no
    length = np.diff(word_at)[chunk]  # words of each chunk in the texts
    start = np.cumsum(length) - length
    at = np.arange(length.sum()) - np.repeat(start, length) + np.repeat(word_at[chunk], length)
    key = word[at].astype(np.int64)
    key *= len(texts)
    key += np.repeat(doc, length)
    del at, start, length, doc, chunk
    key, freq = np.unique(key, return_counts=True)
    of_word, of_doc = np.divmod(key, len(texts))
    names = list(word_no)
    pieces = np.array([known.get(w, 0) for w in names], np.int64)
    sure = np.zeros(len(texts), np.int64)
    np.add.at(sure, of_doc, freq * pieces[of_word])
    sizes = np.array([len(t.encode()) if t else 0 for t in texts], np.int64)
    null = np.array([i is None for i in ids], np.int64)
    own = np.concatenate([np.array([i or 0 for i in ids], np.int64), null, sizes, sure]).astype("<i8").tobytes()
    yield pa.record_batch([pa.array([f"\0{base}\0"]), pa.array([base]), pa.array([own], pa.binary())], names=["word", "base", "packed"])
    times = -(-freq // 255)  # places of one byte
    part = np.full(times.sum(), 255)
    part[np.cumsum(times) - 1] = freq - 255 * (times - 1)
    of_doc, of_word = np.repeat(of_doc, times).astype("<u2"), np.repeat(of_word, times)
    part, bounds = part.astype(np.uint8), np.searchsorted(of_word, np.arange(len(names) + 1)).tolist()
    rare = np.flatnonzero(pieces == 0).tolist()
    for k in range(0, len(rare), 20_000):
        some = rare[k:k + 20_000]
        packed = [of_doc[bounds[w]:bounds[w + 1]].tobytes() + part[bounds[w]:bounds[w + 1]].tobytes() for w in some]
        yield pa.record_batch([pa.array([names[w] for w in some], pa.string()), pa.array([base] * len(some), pa.int64()),
                               pa.array(packed, pa.binary())], names=["word", "base", "packed"])


def _frequencies(vocabulary: str):
    def run(batches):
        splitter, known = Splitter(special_tokens(vocabulary)), known_words(vocabulary)
        base = TaskContext.get().partitionId() << 40
        ids, texts, size = [], [], 0
        for b in batches:
            new, new_ids = b.column(1).to_pylist(), b.column(0).to_pylist()
            for i, j in ((k, min(k + BLOCK_DOCS, j)) for i, j in text_batches(new, BLOCK_CHARS // 16) for k in range(i, j, BLOCK_DOCS)):
                own = sum(len(t) for t in new[i:j] if t)
                if ids and (size + own > BLOCK_CHARS or len(ids) + j - i > BLOCK_DOCS):
                    yield from _block(ids, texts, base, splitter, known)
                    base += len(ids)
                    ids, texts, size = [], [], 0
                ids += new_ids[i:j]
                texts += new[i:j]
                size += own
        if ids:
            yield from _block(ids, texts, base, splitter, known)
    return run


def _sums(batches):
    """(base, documents, packed): tokens of some of a block's documents, packed as 16-bit numbers and then 32-bit sums;
    or the block's documents themselves."""
    names = ["base", "documents", "packed"]
    rows, tokens, held = [], [], 0

    def passed_on():
        row, value = np.concatenate(rows), np.concatenate(tokens)
        order = np.argsort(row, kind="stable")
        row, value = row[order], value[order]
        first = np.flatnonzero(np.diff(row, prepend=-1))
        row, value = row[first], np.add.reduceat(value, first)
        base, place = row >> 16, (row & 0xFFFF).astype("<u2")
        cut = [*np.flatnonzero(np.diff(base, prepend=-1)).tolist(), len(base)]
        packed = [place[x:y].tobytes() + value[x:y].astype("<u4").tobytes() for x, y in zip(cut, cut[1:], strict=False)]
        return pa.record_batch([pa.array(bases[base[cut[:-1]]]), pa.nulls(len(packed), pa.binary()), pa.array(packed, pa.binary())],
                               names=names)

    bases, number = np.zeros(0, np.int64), {}
    for b in batches:
        own = b.column(3).is_null()  # no pre-token, so it met none
        for k in np.flatnonzero(own.to_numpy(zero_copy_only=False)).tolist():
            yield pa.record_batch([b.column(1).slice(k, 1), b.column(2).slice(k, 1), pa.nulls(1, pa.binary())], names=names)
        b = b.filter(pc.invert(own))
        if not b.num_rows:
            continue
        packed = b.column(2)
        raw = np.frombuffer(packed.buffers()[2], np.uint8)
        bounds = np.frombuffer(packed.buffers()[1], np.int32)[packed.offset:packed.offset + b.num_rows + 1].astype(np.int64)
        n = np.diff(bounds) // 3
        of = np.repeat(np.arange(b.num_rows), n)
        k = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
        at = bounds[of] + 2 * k
        place = raw[at].astype(np.int64) | raw[at + 1].astype(np.int64) << 8
        freq = raw[bounds[of] + 2 * n[of] + k].astype(np.int64)
        block, own_block = np.unique(b.column(1).to_numpy(), return_inverse=True)
        numbers = np.array([number.setdefault(x, len(number)) for x in block.tolist()])
        rows.append(numbers[own_block][of] << 16 | place)
        tokens.append(freq * b.column(3).to_numpy()[of])
        held += len(of)
        if held >= HELD_POSTINGS:
            bases = np.fromiter(number, np.int64, len(number))
            yield passed_on()
            rows, tokens, held = [], [], 0
            number.clear()
    if held:
        bases = np.fromiter(number, np.int64, len(number))
        yield passed_on()


def _total(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """The documents of one block with the sums of all that was counted for them."""
    documents = next(x for x in table["documents"].to_pylist() if x is not None)
    ids, null, sizes, total = np.frombuffer(documents, "<i8").reshape(4, -1).copy()
    for packed in table["packed"].to_pylist():
        if packed is not None:
            n = len(packed) // 6
            total[np.frombuffer(packed, "<u2", n)] += np.frombuffer(packed, "<u4", n, 2 * n)
    return pa.table({"doc_id": pa.array(ids, mask=null.astype(bool)), "n_bytes": sizes, "n_tokens": total})


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY,
                 limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit (n_tokens > ``limit``), one row per input row.

    Counts are those of the tokenizers library for the byte-level ``vocabulary`` (.json), special strings in a
    text being one token each. Null and empty texts have 0 bytes and 0 tokens; a null id stays null; repeated
    rows each give a row; an empty table gives none. Other columns are not read. ``docs`` should be a table or
    another plan that gives the same rows in the same order when a lost task is run again.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    pieces = (rows.select("text").mapInArrow(_distinct(vocabulary), "word string").distinct()
              .mapInArrow(_count(vocabulary), "word string, pieces long"))
    freq = rows.mapInArrow(_frequencies(vocabulary), "word string, base long, packed binary")
    # Each block's documents have a key of their own, so they spread over all tasks and pass the join by.
    sums = (freq.join(pieces, "word", "left").select("word", "base", "packed", "pieces")
            .mapInArrow(_sums, "base long, documents binary, packed binary"))
    counts = sums.groupBy("base").applyInArrow(_total, "doc_id long, n_bytes long, n_tokens long")
    return counts.withColumn("over_limit", F.col("n_tokens") > limit)


def op10_token_counts(spark, sf_dir: str) -> DataFrame:
    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
