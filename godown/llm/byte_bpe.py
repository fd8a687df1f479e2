"""Byte-level BPE encoding and decoding (6) by the tokenizers library over Arrow batches.

``encode`` gives ids with the character span of each; ``decode`` reverses the byte table. Both are maps over the
rows: no shuffle, and a lost task is simply run again.
"""

from __future__ import annotations

import codecs
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from godown.llm.pretok import byte_chars, words_for

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
#: Bytes of text that ``encode``, and ids that ``decode``, handle at once.
BATCH_BYTES, DECODE_IDS = 3_000_000, 500_000


@lru_cache(4)
def token_bytes(vocabulary: str) -> list[bytes]:
    """The bytes of each id: its characters taken back through the byte table. Special strings are their UTF-8."""
    byte_of = {c: b for b, c in enumerate(byte_chars())}
    tokens = words_for(vocabulary).tokenizer.get_vocab(with_added_tokens=True)
    special = {t.content for t in words_for(vocabulary).tokenizer.get_added_tokens_decoder().values()}
    out = [b""] * (max(tokens.values()) + 1)
    for t, i in tokens.items():
        out[i] = t.encode() if t in special else bytes(byte_of[c] for c in t)
    return out


def char_spans(texts: pa.Array, offsets: np.ndarray, ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of each id of a batch of texts, the first character and the one after the last; ids that share a character all
    span it. Also how many ids of each text begin inside a character."""
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(texts.buffers()[2], np.uint8)[bounds[0]:bounds[-1]] if bounds[-1] else np.zeros(0, np.uint8)
    begins = (raw & 0xC0) != 0x80
    char = np.cumsum(begins, dtype=np.int32)  # characters begun up to and with this byte
    size = lengths[ids]
    stop = np.cumsum(size)
    first = np.where(bounds[:-1] > bounds[0], char[bounds[:-1] - bounds[0] - 1] if len(char) else 0, 0)  # characters before each text
    own = np.repeat(first, np.diff(offsets))
    inside = np.concatenate([[0], np.cumsum(~begins[stop - size], dtype=np.int32)]) if len(ids) else np.zeros(1, np.int64)
    return char[stop - size] - 1 - own, char[stop - 1] - own, (inside[offsets[1:]] - inside[offsets[:-1]]).astype(np.int64)


def token_texts(ids, table: list[bytes]) -> list[str]:
    """Text that each id completes: a character split over several ids belongs to the last of them."""
    decoder = codecs.getincrementaldecoder("utf-8")("replace")
    out = [decoder.decode(table[i]) for i in ids]
    if out:
        out[-1] += decoder.decode(b"", True)
    return out


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, ids, starts, ends, n_split_tokens: token ids of every whole text, their character spans, and how
    many ids begin inside a character.

    A null or empty text has empty lists; a null id stays null; repeated rows each give a row. Columns other
    than these two are not read, so their names cannot clash.
    """
    def run(batches):
        words = words_for(vocabulary)
        lengths = np.array([len(t) for t in token_bytes(vocabulary)], np.int64)
        for b in batches:
            texts = pc.fill_null(b.column(1).cast(pa.large_string()), "")
            at = 0
            sizes = pc.binary_length(texts).to_numpy()
            while at < b.num_rows:
                n = max(1, int(np.searchsorted(np.cumsum(sizes[at:]), BATCH_BYTES, "right")))
                some = texts.slice(at, n)
                offsets, ids = words.encode_array(some)
                starts, ends, inside = char_spans(some, offsets, ids, lengths)
                lists = [pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(v.astype(np.int32)))
                         for v in (ids, starts, ends)]
                yield pa.record_batch([b.column(0).slice(at, n), *lists, pa.array(inside)],
                                      names=["doc_id", "ids", "starts", "ends", "n_split_tokens"])
                at += n

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>, starts array<int>, ends array<int>, n_split_tokens long")


def decode(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", vocabulary: str = VOCABULARY,
           extra: list[str] | None = None) -> DataFrame:
    """doc_id, ids, decoded (the exact bytes) and the columns in ``extra``.

    Null or empty ids give no bytes. A list may start or end inside a character: its bytes come back as they
    are. ``token_texts`` gives the text id by id, each split character with the id that completes it.
    """
    extra = extra or []
    def run(batches):
        table = token_bytes(vocabulary)
        get = table.__getitem__
        for b in batches:
            lists = b.column(1)
            bounds = lists.offsets.to_numpy().astype(np.int64)
            ids = lists.values.to_numpy()
            at = 0
            while at < b.num_rows:
                n = max(1, int(np.searchsorted(bounds[at + 1:] - bounds[at], DECODE_IDS, "right")))
                parts = [b"".join(map(get, ids[x:y].tolist())) for x, y in zip(bounds[at:at + n], bounds[at + 1:at + n + 1], strict=True)]
                cut = [b.column(k).slice(at, n) for k in range(b.num_columns)]
                yield pa.record_batch([*cut, pa.array(parts, pa.binary())],
                                      names=["doc_id", "ids", *[f"extra{k}" for k in range(len(extra))], "decoded"])
                at += n

    rows = encoded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"),
                          *[F.col(c).alias(f"extra{k}") for k, c in enumerate(extra)])
    out = rows.mapInArrow(run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema) + ", decoded binary")
    return out.select("doc_id", "ids", *[F.col(f"extra{k}").alias(c) for k, c in enumerate(extra)], "decoded")


def op6_byte_bpe(spark, sf_dir: str) -> DataFrame:
    encoded = encode(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    spans = encoded.select("doc_id", "ids", F.coalesce(F.array_max("ends"), F.lit(0)).cast("long").alias("n_chars"),
                           "n_split_tokens")
    return decode(spans, extra=["n_chars", "n_split_tokens"]).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"), "n_chars", "n_split_tokens")
