"""Vector code compression (13): product codes, each part's nearest entry found in a GNAT over the entries.

A vector becomes whole numbers and is cut into equal parts; each part is coded by its codebook's nearest entry. The entries
of a codebook stand in a geometric near-neighbour access tree: a node holds split points, its other entries go to the
nearest one's child, and for every split point and child the least and largest distance between them are kept. A query's
distances to the split points then eliminate children: by the triangle inequality no entry there can be nearer than
the best one so far. Elimination is strict and distances are rounded outwards, so an entry that ties is always met;
what is met is compared in whole numbers, ties going to the lower index.

A round of training is one pass over the vectors: tasks sum their parts by entry, the sums are added by (part, entry,
place), and the new codebooks, whose size depends on the parameters alone, go to the next round's tasks.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from godown.session import cut_lineage

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Split points of a node, entries below which it is a leaf.
DEGREE, LEAF = 8, 96


def _down(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x, -np.inf)


def _up(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x, np.inf)


def exact_doubles(most: int, width: int) -> bool:
    """Whether doubles hold every product and sum of a squared distance exactly, for components of at most ``most``."""
    return 4 * most * most * width < 1 << 53


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of whole-number rows: by a matrix product for doubles, which then hold each value exactly, else in
    64-bit whole numbers."""
    if x.dtype != np.float64:
        return np.stack([((x - e) ** 2).sum(axis=1) for e in y], axis=1) if len(y) else np.zeros((len(x), 0), x.dtype)
    d = x @ (-2 * y.T)
    d += np.einsum("ij,ij->i", x, x)[:, None]
    d += np.einsum("ij,ij->i", y, y)
    return d


class Gnat:
    """Nearest entry of whole-number queries, exactly. ``compared`` counts the distances that were computed."""

    def __init__(self, entries: np.ndarray, degree: int = DEGREE, leaf: int = LEAF):
        self.entries, self.degree, self.leaf, self.compared = entries, degree, leaf, 0
        self.root = self._node(np.arange(len(entries)))

    def _node(self, ids: np.ndarray):
        if len(ids) <= max(self.leaf, self.degree):
            return ids, None, None, None
        chosen = [0]  # split points far from each other
        far = squared(self.entries[ids], self.entries[ids[:1]])[:, 0]
        while len(chosen) < self.degree:
            chosen.append(int(far.argmax()))
            if not far[chosen[-1]]:  # the others equal a split point
                chosen.pop()
                break
            far = np.minimum(far, squared(self.entries[ids], self.entries[ids[chosen[-1:]]])[:, 0])
        chosen = np.sort(chosen)
        splits, rest = ids[chosen], np.delete(ids, chosen)
        d = squared(self.entries[splits], self.entries[rest])
        home = d.argmin(axis=0)
        low, high = np.full((len(splits), len(splits)), np.inf), np.full((len(splits), len(splits)), -np.inf)
        children = []
        for j in range(len(splits)):
            own = home == j
            children.append(self._node(rest[own]) if own.any() else None)
            if own.any():
                low[:, j] = _down(np.sqrt(d[:, own].min(axis=1)))
                high[:, j] = _up(np.sqrt(d[:, own].max(axis=1)))
        return splits, children, low, high

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of each query's nearest entry, the lower index of several."""
        most = max((int(np.abs(x).max()) for x in (queries, self.entries) if x.size), default=0)
        kind = np.float64 if exact_doubles(most, self.entries.shape[1]) else np.int64
        best = np.full(len(queries), np.inf if kind is np.float64 else np.iinfo(np.int64).max, kind)
        index = np.full(len(queries), len(self.entries))
        self._visit(self.root, queries.astype(kind), self.entries.astype(kind), np.arange(len(queries)), best, index)
        return index, best.astype(np.int64)

    def _visit(self, node, queries, entries, rows, best, index) -> None:
        ids, children, low, high = node
        d = squared(queries[rows], entries[ids])
        self.compared += d.size
        k = d.argmin(axis=1)  # the ids of a node ascend, so of equal distances this is the lower index
        near = d[np.arange(len(rows)), k]
        better = (near < best[rows]) | (near == best[rows]) & (ids[k] < index[rows])
        best[rows[better]], index[rows[better]] = near[better], ids[k[better]]
        if children is None:
            return
        for j, child in enumerate(children):  # the nearest split point's child first
            if child is not None and len(own := np.flatnonzero(k == j)):
                self._visit(child, queries, entries, rows[own], best, index)
        # Rounded outwards: from a split point, what may be nearer or tie lies between these two distances.
        reach = _up(np.sqrt(best[rows]))[:, None]
        inner, outer = _down(_down(np.sqrt(d)) - reach), _up(_up(np.sqrt(d)) + reach)
        for j, child in enumerate(children):
            if child is not None:
                gone = ((inner > high[:, j]) | (outer < low[:, j])).any(axis=1) | (k == j)
                if not gone.all():
                    self._visit(child, queries, entries, rows[~gone], best, index)


def _whole(batches):
    """(vec_id, label, dim, q): whole-number components, 32 bits each, of the vectors that are kept."""
    for b in batches:
        vectors = b.column(2)
        length = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy()
        x = pc.list_flatten(vectors).to_numpy(zero_copy_only=False).astype(np.float64)  # a null component becomes NaN
        end = np.cumsum(length)
        unusable = np.concatenate([[0], np.cumsum(~np.isfinite(x))])
        kept = (unusable[end] == unusable[end - length]) & vectors.is_valid().to_numpy(zero_copy_only=False)
        with np.errstate(over="ignore"):
            x = np.floor(np.where(np.isfinite(x), x, 0) * SCALE)
        x[~np.repeat(kept, length)] = 0
        if len(x) and 4 * np.abs(x).max() ** 2 * length.max() >= 2.0 ** 62:
            raise OverflowError("components are too large for squared distances of 64 bits")
        raw, at = x.astype("<i4").tobytes(), np.flatnonzero(kept)
        rows = b.take(pa.array(at))
        q = [raw[4 * (end[k] - length[k]):4 * end[k]] for k in at]
        yield pa.record_batch([rows.column(0), rows.column(1), pa.array(length[at].astype(np.int32)), pa.array(q, pa.binary())],
                              names=["vec_id", "label", "dim", "q"])


def _matrix(raw: list[bytes], width: int) -> np.ndarray:
    """Vectors as rows, shorter ones padded with zeros."""
    if all(len(v) == 4 * width for v in raw):
        return np.frombuffer(b"".join(raw), "<i4").reshape(len(raw), width).astype(np.int64)
    return np.frombuffer(b"".join(v.ljust(4 * width, b"\0") for v in raw), "<i4").reshape(len(raw), width).astype(np.int64)


def _sums(books):
    """(part, entry, n, total): sizes and component sums of what each entry is the nearest of, in one task."""
    def run(batches):
        book = books.value
        trees = [Gnat(x) for x in book]
        total, count = np.zeros(book.shape, np.int64), np.zeros(book.shape[:2], np.int64)
        for b in batches:
            parts = np.split(_matrix(b.column(0).to_pylist(), book.shape[0] * book.shape[2]), len(book), axis=1)
            for p, x in enumerate(parts):
                index, _ = trees[p].nearest(x)
                order = np.argsort(index, kind="stable")
                first = np.flatnonzero(np.diff(index[order], prepend=-1))
                total[p, index[order[first]]] += np.add.reduceat(x[order], first, axis=0)
                count[p] += np.bincount(index, minlength=count.shape[1])
        part, entry = np.nonzero(count)
        yield pa.record_batch([pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(count[part, entry]),
                               pa.array(list(total[part, entry]), pa.list_(pa.int64()))], names=["part", "entry", "n", "total"])
    return run


def _codes(books):
    def run(batches):
        book = books.value
        trees = [Gnat(x) for x in book]
        for b in batches:
            codes, error = np.zeros((b.num_rows, len(book)), np.uint8), np.zeros(b.num_rows, np.int64)
            parts = np.split(_matrix(b.column(2).to_pylist(), book.shape[0] * book.shape[2]), len(book), axis=1)
            for p, x in enumerate(parts):
                index, d = trees[p].nearest(x)
                codes[:, p] = index
                error += d
            yield pa.record_batch([b.column(0), b.column(1), pa.array([c.tobytes().hex() for c in codes], pa.string()),
                                   pa.array(error)], names=["vec_id", "label", "code", "error"])
    return run


def train(vectors: DataFrame, width: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (part, entry, place) after ``rounds`` rounds over ``vectors`` (vec_id, q)."""
    spark = vectors.sparkSession
    first = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "q").select("q").limit(entries).toArrow()["q"].to_pylist()
    books = _matrix(first, width).reshape(len(first), parts, width // parts).transpose(1, 0, 2).copy()
    for _ in range(rounds):
        sent = spark.sparkContext.broadcast(books)  # entries x width numbers, whatever the input
        found = vectors.select("q").mapInArrow(_sums(sent), "part int, entry int, n long, total array<long>")
        n = F.sum("n").alias("n")
        sums = (found.select("part", "entry", "n", F.posexplode("total").alias("place", "x"))
                .groupBy("part", "entry", "place").agg(n, F.sum("x").alias("x"))).toArrow()
        part, entry, place, n, x = (sums[c].to_numpy() for c in ("part", "entry", "place", "n", "x"))
        books[part, entry, place] = x // n  # whole numbers, rounded down
        sent.destroy()
    return books


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = PARTS,
             entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of every vector without null or non-finite components.

    The first codebooks are the vectors with the smallest ids; of equal ids the one whose bytes come first, null ids last.
    With fewer vectors than ``entries`` the codebooks are shorter. Repeated rows each count. Vectors shorter than the
    longest one, and a length that ``parts`` does not divide, count as padded with zeros. An empty vector is kept and all
    zeros. A component beyond 64-bit distances is an error. Rows with a null label share theirs. An empty table gives none.
    Only the three columns are read. ``entries`` is 256 at most, so that an index has two hex digits.
    """
    spark = vectors.sparkSession
    label = vectors.schema[label_col].dataType.simpleString()
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"),
                          F.col(vector_col).cast("array<double>").alias("v"))
    kept = cut_lineage(rows.mapInArrow(_whole, f"vec_id long, label {label}, dim int, q binary"))
    longest = kept.agg(F.max("dim")).first()[0] or 0
    books = train(kept, -(-longest // parts) * parts, parts, entries, rounds)
    sent = spark.sparkContext.broadcast(books)
    coded = cut_lineage(kept.select("vec_id", "label", "q").mapInArrow(_codes(sent), f"vec_id long, label {label}, code string, error long"))
    # Summed before it moves; the join has a row a label on one side, and Spark splits a label with many vectors.
    by_label = coded.groupBy(F.col("label").alias("l")).agg(F.sum("error").alias("label_error"))
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("l"))).select(
        "vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def op13_gnat_codes(spark, sf_dir: str) -> DataFrame:
    return compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
