"""Filter interaction audit (11): what each filter removes, in every order in which the filters can be applied.

A document fails some of the filters; that set is its mask. An order's inverse permutation gives the step of each filter.
The step at which a document goes is the least step of a filter that it fails: a product of the mask matrix (0 where it
fails, infinite elsewhere) with the transposed position matrix, with minimum for the sum and plus for the product. Documents
count only by (part, mask, labels), so the product runs over a few rows a part; the steps then scatter the rows' weights.

The texts are read once and leave the first tasks as a mask and a 128-bit digest. Equal texts are found by sums: rows are
counted by document, then by digest, so a text with any number of copies is a few rows before it moves.
"""

from __future__ import annotations

import hashlib
import re
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from godown.llm.pieces import word_pieces

FILTERS = "ABCDE"
#: The filter that needs the whole table: a copy of an earlier document.
COPY = FILTERS.index("E")
#: Parameters of the filters: least words, least percent of distinct words, most percent of capitals.
LEAST_WORDS, DISTINCT_PERCENT, CAPITALS_PERCENT = 100, 80, 10
_SIGNS = re.compile(rb"[#$%&*|]")
_CAPITALS = bytes(range(65, 91))
_SPLIT = bytes.maketrans(b"", b"")  # bytes.split() already splits at [\x20\x09-\x0D]


def text_mask(text: str | None) -> int:
    """Bits of the filters A to D that a text fails (a null text counts as empty)."""
    raw = (text or "").encode()
    n, distinct = 0, set()
    for words in word_pieces(raw, _SPLIT):
        n += len(words)
        distinct.update(words)
    capitals = len(raw) - len(raw.translate(None, _CAPITALS))
    return ((n < LEAST_WORDS) | (100 * len(distinct) < DISTINCT_PERCENT * n) << 1
            | (100 * capitals > CAPITALS_PERCENT * len(text or "")) << 2 | (_SIGNS.search(raw) is not None) << 3)


def _failures(batches):
    """(doc_id, part, mask, digest) of every row."""
    for b in batches:
        masks, digests = [], []
        for t in b.column(2):
            text = t.as_py()
            masks.append(text_mask(text))
            digests.append(hashlib.blake2b((text or "").encode(), digest_size=16).digest())
        yield pa.record_batch([b.column(0), b.column(1), pa.array(masks, pa.int32()), pa.array(digests, pa.binary())],
                              names=["doc_id", "part", "mask", "digest"])


def positions(filters: int) -> tuple[np.ndarray, np.ndarray]:
    """All orders of the filters (filter by step), and their inverse permutations (step by filter)."""
    orders = np.array(list(permutations(range(filters))))
    return orders, np.argsort(orders, axis=1)


def removal_steps(masks: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Min-plus product of the masks with the positions: the step (from 0) at which each mask goes in each order, and the
    number of filters where it stays."""
    filters = places.shape[1]
    fails = (masks[:, None] >> np.arange(filters)) & 1
    cost = np.where(fails, 0, filters)
    return np.minimum((cost[:, None, :] + places[None, :, :]).min(axis=2), filters)


def audit_counts(masks: np.ndarray, weights: np.ndarray, filters: int) -> dict[str, np.ndarray]:
    """Counts by (order, step): kept, removed, redundant, unique_fails, shapley, and what was removed of the other weights.

    ``weights`` has a row a mask: documents, good documents, toxic documents.
    """
    orders, places = positions(filters)
    step = removal_steps(masks, places)
    gone = np.zeros((len(orders), filters + 1, weights.shape[1]), np.int64)
    np.add.at(gone, (np.arange(len(orders))[None, :], step), weights[:, None, :])
    gone = gone[:, :filters]
    removed = gone[:, :, 0]
    fails = ((masks[:, None] >> np.arange(filters)) & 1).astype(bool)
    early = np.zeros((len(orders), filters), np.int64)  # by filter: it fails the filter, but an earlier one took it
    unique = np.zeros(filters, np.int64)
    for f in range(filters):
        early[:, f] = np.where(step < places[None, :, f], weights[:, None, 0], 0)[fails[:, f]].sum(axis=0)
        unique[f] = weights[masks == 1 << f, 0].sum()
    by_filter = np.take_along_axis(removed, places, axis=1)
    return {"kept": weights[:, 0].sum() - np.cumsum(removed, axis=1), "removed": removed,
            "redundant": np.take_along_axis(early, orders, axis=1), "unique_fails": unique[orders],
            "good_lost": gone[:, :, 1], "toxic_lost": gone[:, :, 2], "shapley": by_filter.sum(axis=0)[orders]}


_COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def _audit(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """All orders and steps of one part; its rows are at most a row a mask and label."""
    mask, good, toxic, copies, firsts = (table[c].to_numpy() for c in ("mask", "good", "toxic", "copies", "firsts"))
    masks = np.concatenate([mask | 1 << COPY, mask])
    n = np.concatenate([copies, firsts])
    good, toxic = np.tile(good, 2), np.tile(toxic, 2)
    found = audit_counts(masks, np.stack([n, n * good, n * toxic], axis=1), len(FILTERS))
    orders, _ = positions(len(FILTERS))
    names = np.repeat(["".join(FILTERS[f] for f in o) for o in orders], len(FILTERS))
    return pa.table({"part": [key[0].as_py()] * len(names), "filter_order": names.tolist(),
                     "step": pa.array(np.tile(np.arange(1, len(FILTERS) + 1, dtype=np.int32), len(orders))),
                     **{c: found[c].ravel() for c in _COUNTS}})


def failure_counts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   part_col: str = "lang") -> DataFrame:
    """(part, mask, good, toxic, copies, firsts): rows by the filters A to D that they fail; copies also fail E."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                       F.col(text_col).cast("string").alias("text"))
    rows = rows.mapInArrow(_failures, "doc_id long, part string, mask int, digest binary")
    rows = rows.groupBy("doc_id", "part", "mask", "digest").agg(F.count("*").alias("n"))
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("quality") == 1).alias("good"), (F.col("toxic") == 1).alias("toxic"))
             .filter("doc_id is not null").groupBy("doc_id").agg(*[F.coalesce(F.bool_or(c), F.lit(False)).alias(c) for c in ("good", "toxic")]))
    # Rows without an id have no labels and are no copies: they pass the join and the search for copies by.
    named = rows.filter("doc_id is not null").join(known, "doc_id", "left")
    groups = named.groupBy("digest", "part", "mask", *[F.coalesce(F.col(c), F.lit(False)).cast("int").alias(c) for c in ("good", "toxic")]).agg(
        F.sum("n").alias("n"), F.min(F.struct("doc_id", "n")).alias("first"))
    least = F.min("first.doc_id").over(Window.partitionBy("digest"))  # a row a part and label, however many copies
    firsts = F.when(F.col("first.doc_id") == F.col("least"), F.col("first.n")).otherwise(0)
    counted = groups.withColumn("least", least).select("part", "mask", "good", "toxic", (F.col("n") - firsts).alias("copies"), firsts.alias("firsts"))
    zero = F.lit(0)
    return (counted.unionByName(rows.filter("doc_id is null").select("part", "mask", zero.alias("good"), zero.alias("toxic"),
                                                                     zero.cast("long").alias("copies"), F.col("n").alias("firsts")))
            .groupBy("part", "mask", "good", "toxic").agg(F.sum("copies").alias("copies"), F.sum("firsts").alias("firsts")))


def filter_audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost and shapley: a row a part, order
    of the five filters and step.

    A null or empty text is a text of no words; a null part counts as the empty string. A row fails E if a row with a smaller
    id, in whatever part, has the same text; repeated rows of one id are each counted and are no copies of each other. A row
    with a null id is counted, has no labels, and is neither a copy nor the first of others. A document is good (toxic) if
    any of its labels says so; null labels say nothing. An empty table has no parts. Only the named columns are read.
    """
    counts = failure_counts(docs, labels, id_col, text_col, part_col)
    return counts.groupBy("part").applyInArrow(
        _audit, "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in _COUNTS))


def op11_filter_audit(spark, sf_dir: str) -> DataFrame:
    return filter_audit(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
