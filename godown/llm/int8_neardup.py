"""Near-duplicate embeddings (7): int8 tile products with rigorous error bounds.

Equal vectors become one with a weight. Distinct ones are dealt to cells around pivots; a vector also visits each other
cell that can hold a neighbour within the angle (triangle inequality, so none is missed). Cells are cut into blocks,
and a tile is the product of two blocks' int8 matrices. Blocks are written once; a task reads a few for each side and pairs
them, so no tile goes through a shuffle. With x = s*q + e, |cos(x, y) - s*s'*q.q'| is at most
|s*q| |e'| + |e| |s'*q'| + |e| |e'|. Pairs that this bound proves above or below the threshold are settled; the others
are computed again in double precision. A tile returns link counts and a spanning forest, never its pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from godown.llm.components import connected_components, free_finished
from godown.session import cut_lineage, drop_written

THRESHOLD = 0.95
#: Vectors of a block: a tile is the product of two.
BLOCK = 2048
#: Pivots are fitted on a sample of at most so many vectors, and as many of these numbers of pivots are tried.
SAMPLE, PIVOTS = 4096, (1, 8, 32)
#: Cells are paired in at most so many groups, and a file of blocks has at most so many bytes.
GROUPS, FILE_BYTES = 32, 1 << 24
SLACK = 1e-5  # of single-precision products, far above their rounding error
MARGIN = 1e-9  # of angles


def _units(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    norm = np.sqrt(np.einsum("ij,ij->i", x, x))
    return x / norm[:, None], norm


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes of the unit vectors, their scales, the norms of scale * code, and upper bounds of the errors' norms."""
    unit, _ = _units(x)
    scale = np.abs(unit).max(axis=1) / 127
    code = np.rint(unit / scale[:, None]).astype(np.int8)
    near = code * scale[:, None]
    error = unit - near
    return code, scale, np.sqrt((near * near).sum(axis=1)), np.sqrt((error * error).sum(axis=1)) * (1 + 1e-12) + 1e-12


def tile_links(x: np.ndarray, y: np.ndarray, threshold: float = THRESHOLD, same: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Indexes (i, j) of all pairs with a cosine of ``threshold`` or more; with ``same``, i < j of one block."""
    (qx, sx, nx, ex), (qy, sy, ny, ey) = quantise(x), quantise(y)
    kind = np.float32 if x.shape[1] <= 1024 else np.float64  # whole-number products stay exact
    product = qx.astype(kind) @ qy.astype(kind).T
    near = product.astype(np.float32, copy=False)
    near *= sx.astype(np.float32)[:, None]
    near *= sy.astype(np.float32)[None, :]
    bound = nx * ey.max() + ex * (ny + ey).max()
    found_i, found_j = [], []
    for i in range(0, len(x), 256):  # a strip at a time bounds the index arrays
        a, j = np.nonzero(near[i:i + 256] >= (threshold - bound[i:i + 256, None] - SLACK).astype(np.float32))
        a += i
        if same:
            a, j = a[a < j], j[a < j]
        dot = np.einsum("ij,ij->i", qx[a].astype(np.float64), qy[j].astype(np.float64)) * sx[a] * sy[j]
        off = nx[a] * ey[j] + ex[a] * ny[j] + ex[a] * ey[j] + 1e-12
        sure = dot - off >= threshold
        open_ = np.flatnonzero(~sure & (dot + off >= threshold))
        u, v = x[a[open_]], y[j[open_]]
        cos = np.einsum("ij,ij->i", u, v) / np.sqrt(np.einsum("ij,ij->i", u, u) * np.einsum("ij,ij->i", v, v))
        sure[open_] = cos >= threshold
        found_i.append(a[sure])
        found_j.append(j[sure])
    return np.concatenate(found_i), np.concatenate(found_j)


def forest(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """Least node of each node's component, for links between nodes 0 to n - 1."""
    label = np.arange(n)
    while True:
        before = label.copy()
        low = np.minimum(label[i], label[j])
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        label = label[label]
        if np.array_equal(before, label):
            return label


def _angles(unit: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(unit @ pivots.T, -1, 1))


def _spread_pivots(unit: np.ndarray, k: int) -> np.ndarray:
    """Farthest-first start, then a few rounds of spherical means."""
    chosen = [0]
    far = _angles(unit, unit[[0]])[:, 0]
    while len(chosen) < min(k, len(unit)):
        chosen.append(int(far.argmax()))
        far = np.minimum(far, _angles(unit, unit[[chosen[-1]]])[:, 0])
    pivots = unit[chosen]
    for _ in range(5):
        home = _angles(unit, pivots).argmin(axis=1)
        means = np.stack([unit[home == c].sum(axis=0) if (home == c).any() else pivots[c] for c in range(len(pivots))])
        norm = np.sqrt((means * means).sum(axis=1))
        pivots = np.where(norm[:, None] > 1e-9, means / np.maximum(norm, 1e-9)[:, None], pivots)
    return pivots


def fit_pivots(sample: np.ndarray, angle: float) -> np.ndarray:
    """Pivots for which the sample's tiles and visits cost least; one pivot means no pruning. Changes only speed."""
    unit, best = _units(sample)[0], None
    for k in PIVOTS:
        pivots = _spread_pivots(unit, k)
        a = _angles(unit, pivots)
        home = a.argmin(axis=1)
        radius = np.array([a[home == c, c].max(initial=0) for c in range(len(pivots))])
        visits = (a <= a.min(axis=1)[:, None] + 2 * angle) & (a <= radius[None, :] + angle)
        visits[np.arange(len(a)), home] = False
        size = np.bincount(home, minlength=len(pivots)) / len(a)
        cost = (size * (size / 2 + visits.mean(axis=0))).sum() + 0.002 * visits.sum(axis=1).mean()
        if best is None or cost < best[0]:
            best = cost, pivots
    return best[1]


def _clean(kind: str):
    """(vec_id, dim, raw): the vector as bytes, null if it links with nothing."""
    def run(batches):
        for b in batches:
            v = b.column(1)
            lengths = v.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            flat = v.flatten().to_numpy(zero_copy_only=False).astype(kind)  # null components become NaN
            starts = np.cumsum(lengths) - lengths
            raw, dims = [None] * len(v), np.zeros(len(v), np.int32)
            for d in np.unique(lengths[lengths > 0]):
                at = np.flatnonzero(lengths == d)
                x = flat[starts[at][:, None] + np.arange(d)]
                ok = np.isfinite(x).all(axis=1) & x.any(axis=1)
                at, x = at[ok], x[ok]
                if kind == "<f8" and len(x):
                    most = np.abs(x).max(axis=1)
                    far = (most <= 1e-100) | (most >= 1e100)  # the squares of very large or small components have no double
                    x[far] = np.ldexp(x[far], -np.frexp(most[far])[1][:, None])
                x = x + np.array(0, kind)  # -0 becomes 0
                dims[at] = d
                for k, row in zip(at.tolist(), x, strict=True):
                    raw[k] = row.tobytes()
            yield pa.record_batch([b.column(0), pa.array(dims, pa.int32()), pa.array(raw, pa.binary())],
                                  names=["vec_id", "dim", "raw"])
    return run


def _deal(pivots, kind: str, angle: float, radius: dict | None):
    """(dim, cell, home, ...): a row's home cell with its angle, or with ``radius`` also the cells it visits."""
    def run(batches):
        for b in batches:
            out: list[list] = [[] for _ in range(7)]
            dims, raw = b.column("dim").to_numpy(), b.column("raw").to_pylist()
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                x = np.stack([np.frombuffer(raw[k], kind) for k in at]).astype(np.float64)
                a = _angles(_units(x)[0], pivots.value[int(d)])
                home = a.argmin(axis=1)
                least = a[np.arange(len(a)), home]
                visits = np.zeros(a.shape, bool)
                if radius is not None:
                    reach = np.array([radius.get((int(d), c), -np.inf) for c in range(a.shape[1])])
                    visits = (a <= least[:, None] + 2 * angle + MARGIN) & (a <= reach[None, :] + angle + MARGIN)
                visits[np.arange(len(a)), home] = True
                r, c = np.nonzero(visits)
                rep, weight = b.column("rep").to_numpy()[at], b.column("m").to_numpy()[at]
                for col, v in zip(out, (np.full(len(r), d), c, home[r] == c, least[r], rep[r], weight[r], [raw[at[k]] for k in r]), strict=True):
                    col.extend(v)
            yield pa.record_batch([pa.array(v, t) for v, t in zip(out, (pa.int32(), pa.int32(), pa.bool_(), pa.float64(),
                                                                        pa.int64(), pa.int64(), pa.binary()), strict=True)],
                                  names=["dim", "cell", "home", "angle", "rep", "m", "raw"])
    return run


def _pack(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """One row of a block: its reps and weights as 64-bit numbers and its vectors, in the order of the reps."""
    reps = table["rep"].to_numpy()
    order = np.argsort(reps)
    raw = table["raw"].to_pylist()
    return pa.table({"dim": [key[0].as_py()], "cell": [key[1].as_py()], "home": [key[2].as_py()], "no": [key[3].as_py()],
                     "reps": [reps[order].astype("<i8").tobytes()], "weights": [table["m"].to_numpy()[order].astype("<i8").tobytes()],
                     "vectors": [b"".join(raw[k] for k in order)]},
                    schema=pa.schema([("dim", pa.int32()), ("cell", pa.int32()), ("home", pa.bool_()), ("no", pa.int32()),
                                      ("reps", pa.binary()), ("weights", pa.binary()), ("vectors", pa.binary())]))


def _tiles(kind: str, threshold: float):
    """Rows (a, b, n): n linked vectors of a (b null), or a and b in one component of a tile."""
    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                r = {n: batch.column(n)[k].as_py() for n in batch.schema.names}
                (rx, ry), (wx, wy) = ([np.frombuffer(r[f"{n}{s}"], "<i8") for s in "xy"] for n in ("reps", "weights"))
                x, y = (np.frombuffer(r[f"vectors{s}"], kind).reshape(-1, r["dim"]).astype(np.float64) for s in "xy")
                same = r["homey"] and r["nox"] == r["noy"]
                i, j = tile_links(x, y, threshold, same)
                count = np.zeros(len(rx) + len(ry), np.int64)
                shift = 0 if same else len(rx)
                np.add.at(count, i, wy[j])
                if r["homey"]:
                    np.add.at(count, j + shift, wx[i])
                nodes = np.concatenate([rx, ry])
                label = forest(i, j + shift, len(nodes))
                has, tied = np.flatnonzero(count), np.flatnonzero(label != np.arange(len(nodes)))
                yield pa.record_batch([
                    pa.array(np.concatenate([nodes[has], nodes[tied]])),
                    pa.array(np.concatenate([np.zeros(len(has), np.int64), nodes[label[tied]]]),
                             mask=np.concatenate([np.ones(len(has), bool), np.zeros(len(tied), bool)])),
                    pa.array(np.concatenate([count[has], np.zeros(len(tied), np.int64)]))], names=["a", "b", "n"])
    return run


def _same_vector() -> Column:
    """128 bits of a vector: equal for equal vectors, and in place of them where rows look for their own."""
    return F.substring(F.unhex(F.sha2("raw", 256)), 1, 16)


def _pairs(blocks: DataFrame, groups: list[int]) -> DataFrame | None:
    """Every two blocks of a cell that may hold links, the first of them of rows that are at home there. A task takes a few blocks
    of either side from the written table: what is paired is read, never moved."""
    out, names = None, ["home", "no", "reps", "weights", "vectors"]
    for g in groups:
        of = blocks.filter(F.col("grp") == g)
        x = of.filter("home").select("dim", "cell", *[F.col(n).alias(f"{n}x") for n in names])
        y = of.select("dim", "cell", *[F.col(n).alias(f"{n}y") for n in names])
        two = x.join(y.hint("shuffle_replicate_nl"), ["dim", "cell"]).filter("not homey or nox <= noy")
        out = two if out is None else out.unionByName(two)
    return out


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD,
                    block: int = BLOCK) -> DataFrame:
    """vec_id, n_links (other rows with a cosine of ``threshold`` or more), component_id (smallest id reachable by
    links) and kept (vec_id = component_id), one row per input row.

    Vectors that are null, empty, zero or hold null or non-finite components, and rows with a null id, link with
    nothing and are their own component (null for a null id, kept false). Vectors of different lengths do
    not link. Equal vectors and repeated rows count as links of each other. An empty table gives none. Only the two
    columns are read. ``threshold`` must be positive.
    """
    spark = vectors.sparkSession
    single = dict(vectors.dtypes)[vector_col] == "array<float>"
    kind, angle = ("<f4" if single else "<f8"), float(np.arccos(threshold))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                          F.col(vector_col).cast("array<float>" if single else "array<double>").alias("v"))
    clean = rows.mapInArrow(_clean(kind), "vec_id long, dim int, raw binary")
    rows = cut_lineage(clean.select("vec_id", "dim", _same_vector().alias("key")))
    distinct = cut_lineage(clean.filter("raw is not null and vec_id is not null").groupBy("dim", "raw")
                           .agg(F.min("vec_id").alias("rep"), F.count("*").alias("m")).withColumn("key", _same_vector()))
    free_finished(spark)

    pivots = {}
    for d in [r["dim"] for r in distinct.select("dim").distinct().collect()]:
        some = distinct.filter(F.col("dim") == d).orderBy(F.xxhash64("rep"), "rep").limit(SAMPLE).select("raw").toArrow()["raw"]
        pivots[d] = fit_pivots(np.stack([np.frombuffer(v, kind) for v in some.to_pylist()]).astype(np.float64), angle)
    pivots = spark.sparkContext.broadcast(pivots)
    schema = "dim int, cell int, home boolean, angle double, rep long, m long, raw binary"
    cells = distinct.mapInArrow(_deal(pivots, kind, angle, None), schema).groupBy("dim", "cell").agg(F.max("angle").alias("r"))
    radius = {(r["dim"], r["cell"]): r["r"] for r in cells.collect()}  # a row a pivot
    dealt = distinct.select("dim", "rep", "m", "raw").mapInArrow(_deal(pivots, kind, angle, radius), schema).drop("angle")
    sizes = {(r["dim"], r["cell"], r["home"]): -(-r["n"] // block)  # at most two rows a pivot
             for r in dealt.groupBy("dim", "cell", "home").agg(F.count("*").alias("n")).collect()}
    found = spark.createDataFrame([], "a long, b long, n long")
    if sizes:
        cell_blocks: dict[tuple[int, int], int] = {}
        for (d, c, _), n in sizes.items():
            cell_blocks[d, c] = cell_blocks.get((d, c), 0) + n
        group = {k: i % GROUPS for i, k in enumerate(sorted(cell_blocks, key=lambda k: (-cell_blocks[k] * k[0], k)))}
        plan = spark.createDataFrame([(*k, n, group[k[:2]]) for k, n in sizes.items()], "dim int, cell int, home boolean, blocks int, grp int")
        numbered = dealt.join(F.broadcast(plan), ["dim", "cell", "home"]).withColumn("no", F.pmod(F.xxhash64("rep"), "blocks").cast("int"))
        packed = numbered.groupBy("dim", "cell", "home", "no").applyInArrow(
            _pack, "dim int, cell int, home boolean, no int, reps binary, weights binary, vectors binary")
        # Few enough blocks a file that a task holds a side of its pairs, and enough files that the tasks are many.
        wide = max(d for d, _ in cell_blocks) * int(kind[-1]) * block
        files = max(8, 2 * math.isqrt(spark.sparkContext.defaultParallelism))
        a_file = max(1, min(FILE_BYTES // wide, -(-sum(sizes.values()) // files)))
        blocks = cut_lineage(packed.join(F.broadcast(plan.select("dim", "cell", "grp").distinct()), ["dim", "cell"]), folders="grp", rows_a_file=a_file)
        free_finished(spark)
        tiles = _pairs(blocks, sorted(set(group.values())))
        found = cut_lineage(tiles.mapInArrow(_tiles(kind, threshold), "a long, b long, n long"))
        drop_written(blocks)

    counts = found.filter("b is null").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
    component = connected_components(found.filter("b is not null")).withColumnRenamed("node", "rep")
    known = (distinct.join(counts, "rep", "left").join(component, "rep", "left")
             .select("dim", "key", (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("n_links"),
                     F.coalesce("component", "rep").alias("component_id")))
    alone = F.col("vec_id").isNull()
    return (rows.join(known, ["dim", "key"], "left")
            .select("vec_id", F.when(alone, F.lit(0)).otherwise(F.coalesce("n_links", F.lit(0))).cast("long").alias("n_links"),
                    F.when(~alone, F.coalesce("component_id", "vec_id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))))


def op7_int8_neardup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
