"""N-gram Jaccard self-join (5): rare-first prefixes with length, positional and suffix filters.

1. One pass gives each document's set size and fingerprint, and the shingles that are frequent in some block; the most
   frequent of them (a bounded list) go last in the global order, the others stand in hash order before them.
2. Documents with equal sets are one node. Each node's prefix shingles are shuffled once; those of one node go.
3. Hub rounds: in each remaining bucket, nodes are compared with a hub. Links merge nodes, and a bucket all of whose
   nodes are merged is done, so a large group of near copies costs its size and not its square.
4. What is left is compared exhaustively across components: the nodes outside a bucket's largest component
   with all. No link between components can be missed. Where the hubs linked many, they meet a part of the others first:
   a node that has many links to a large group finds one there and is not compared with all of it.

Pairs pass the length, positional and (in the exhaustive round) suffix filters in the join, are made distinct, and are
verified once on the texts. Shingles are 64-bit hashes of the word sequences.
"""

from __future__ import annotations

import hashlib
import math
from collections import OrderedDict

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from godown.llm.components import connected_components, free_finished
from godown.llm.pretok import text_batches
from godown.session import cut_lineage, drop_written

WORDS = 5
#: Similarity as a fraction: linked when DEN * intersection >= NUM * union.
NUM, DEN = 3, 4
#: Shingles counted together in a task, least count there to be listed, and bound of the broadcast list.
BLOCK_SHINGLES, LOCAL_COUNT, FREQUENT = 4_000_000, 4, 200_000
#: Rows of one prefix shingle that one bucket should hold at most; more frequent ones are salted.
BUCKET_ROWS = 50_000
#: Hub rounds before the exhaustive one, links of the last of them after which it has two steps, share that meets in the first, partners a node takes in each but the first, shingles looked back at, shingles of the
#: sets that a verifying task holds, bits of a signature (at least; and in the join). None of them changes the result.
HUB_ROUNDS, MANY_LINKS, FIRST_SHARE, PARTNERS, LOOKED_BACK, HELD_SHINGLES, SIGNATURE_BITS = 2, 1_000, 16, 4, 4, 4_000_000, 256
#: Rows of a bucket from which it takes part in the first of two exhaustive steps.
FIRST_ROWS = 128
#: Bits of a test of ids at most.
FILTER_BITS = 1 << 26
#: Classes of size between a set and the largest that may be linked with it.
SIZE_STEPS = 4
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                         0xA0761D6478BD642F], np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_BYTE = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
#: Bytes of a word beyond which a library hashes it.
LONG_WORD = 64
_BASE = 0xD1342543DE82EF95  # odd, so it has an inverse


class Shingles:
    """Distinct shingles of texts, each a sorted array of 64-bit hashes.

    All words of a batch are hashed at once: a word's hash is the sum of its mixed bytes times powers of a base, a
    difference of running sums that is shifted to the word's start by the base's inverse, and then mixed. Long words, few in
    any text, have a library's hash.
    """

    def __init__(self):
        self.power = self.inverse = np.ones(1, np.uint64)

    def _hashes(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Start and hash of every word of a byte string that ends in white space."""
        raw = np.frombuffer(data, np.uint8)
        if len(self.power) < len(raw):
            for name, base in (("power", _BASE), ("inverse", pow(_BASE, -1, 1 << 64))):
                steps = np.full(len(raw), base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))
        space = _SPACE[raw]
        edge = np.flatnonzero(np.diff(space, prepend=True))
        start, end = edge[::2], edge[1::2]
        running = np.cumsum(_BYTE[raw] * self.power[:len(raw)])
        h = (running[end - 1] - running[start] + _BYTE[raw[start]] * self.power[start]) * self.inverse[start]
        h = _mixed(h + (end - start).astype(np.uint64))
        # Powers of two have many zero bits at their ends, by which long words of a regular build could be equal.
        for k in np.flatnonzero(end - start > LONG_WORD).tolist():
            h[k] = int.from_bytes(hashlib.blake2b(data[start[k]:end[k]], digest_size=8).digest(), "big")
        return start, h

    @staticmethod
    def _windows(h: np.ndarray, width: int) -> np.ndarray:
        n = len(h) - width + 1
        out = np.full(n, width, np.uint64)
        for k in range(width):
            out += h[k:k + n] * _MULTIPLIERS[k]
            out ^= out >> np.uint64(29)
        out *= np.uint64(0xBF58476D1CE4E5B9)
        out ^= out >> np.uint64(32)
        return out

    def sets(self, texts: list[str | None]) -> list[np.ndarray]:
        parts = [t.encode().lower() if t else b"" for t in texts]
        place, h = self._hashes(b" ".join([*parts, b""]) or b" ")
        ends = np.searchsorted(place, np.cumsum([len(p) + 1 for p in parts])).tolist()
        windows = self._windows(h, WORDS) if len(h) >= WORDS else np.zeros(0, np.uint64)
        out, start = [], 0
        for end in ends:
            if end - start >= WORDS:
                s = np.sort(windows[start:end - WORDS + 1])
                keep = np.empty(len(s), bool)
                keep[0] = True
                np.not_equal(s[1:], s[:-1], out=keep[1:])
                out.append(s[keep])
            else:
                out.append(self._windows(h[start:end], end - start) if end > start else np.zeros(0, np.uint64))
            start = end
        return out

    def __call__(self, text: str | None) -> np.ndarray:
        return self.sets([text])[0]


def fingerprint(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def signature(shingles: np.ndarray) -> bytes:
    """Parity of the shingles in each of as many classes as there are shingles (a power of two, SIGNATURE_BITS at least).
    Two signatures of one length differ in no more bits than the sets differ in shingles."""
    bits = max(SIGNATURE_BITS, 1 << max(0, len(shingles) - 1).bit_length())
    odd = np.bincount((shingles & np.uint64(bits - 1)).astype(np.intp), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def folded(sig: np.ndarray, size: int) -> np.ndarray:
    """A signature's bytes with fewer classes: a class is the sum of those that are equal in their low bits."""
    return np.bitwise_xor.reduce(sig.reshape(-1, size), axis=0)


def close(x: np.ndarray, y: np.ndarray, n: int) -> bool:
    """Whether sets of ``n`` shingles together may be linked, by their signatures."""
    size = min(len(x), len(y))
    differ = int(np.bitwise_count(folded(x, size) ^ folded(y, size)).sum())
    return differ <= n - 2 * ((NUM * n + NUM + DEN - 1) // (NUM + DEN))


def _close(batches):
    """(a, b) of the pairs of rows (a, b, na, nb, sig_a, sig_b) that may be linked."""
    for batch in batches:
        sigs = [[np.frombuffer(s, np.uint8) for s in batch.column(k).to_pylist()] for k in (4, 5)]
        n = (batch.column(2).to_numpy() + batch.column(3).to_numpy()).tolist()
        yield batch.select(["a", "b"]).filter(pa.array([close(x, y, k) for x, y, k in zip(*sigs, n, strict=True)], pa.bool_()))


def probe_prefix(n):
    """Prefix of a set within which it meets every smaller or equal linked set's index prefix."""
    return n - (NUM * n + DEN - 1) // DEN + 1


def index_prefix(n):
    """Prefix needed against sets that are no smaller."""
    return n - (2 * NUM * n + NUM + DEN - 1) // (NUM + DEN) + 1


def suffix_overlap(x: np.ndarray, y: np.ndarray, depth: int = 3) -> int:
    """An upper bound of the overlap of two sorted arrays: split both at the larger one's middle, again and again."""
    if depth == 0 or not len(x) or not len(y):
        return min(len(x), len(y))
    if len(x) < len(y):
        x, y = y, x
    i = len(x) // 2
    j = int(np.searchsorted(y, x[i]))
    return suffix_overlap(x[:i], y[:j], depth - 1) + suffix_overlap(x[i:], y[j:], depth - 1)


def linked(x: np.ndarray, y: np.ndarray) -> bool:
    need = (NUM * (len(x) + len(y)) + NUM + DEN - 1) // (NUM + DEN)
    if not need or min(len(x), len(y)) < need or suffix_overlap(x, y) < need:
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return DEN * both >= NUM * (len(x) + len(y) - both)


def _facts(batches):
    """Rows (kind, id, n, fp, sig, far): a document with its set size, fingerprint and signature, short and whole (0), or a
    frequent shingle with its count (1)."""
    def counted(block):
        values, counts = np.unique(np.concatenate(block), return_counts=True)
        values, counts = values[counts >= LOCAL_COUNT], counts[counts >= LOCAL_COUNT]
        return pa.record_batch([pa.array(np.ones(len(values), np.int32)), pa.array(values.view(np.int64)),
                                pa.array(counts.astype(np.int64)), pa.nulls(len(values), pa.binary()),
                                pa.nulls(len(values), pa.list_(pa.int64())), pa.nulls(len(values), pa.binary())], names=names)

    names = ["kind", "id", "n", "fp", "sig", "far"]
    shingles, block, size = Shingles(), [], 0
    for b in batches:
        texts = b.column(1).to_pylist()
        for i, j in text_batches(texts, 1_000_000):
            sets = shingles.sets(texts[i:j])
            far = [signature(s) for s in sets]
            near = [folded(np.frombuffer(s, np.uint8), SIGNATURE_BITS // 8).view("<i8").tolist() for s in far]
            yield pa.record_batch([pa.array(np.zeros(len(sets), np.int32)), b.column(0).slice(i, j - i),
                                   pa.array([len(s) for s in sets], pa.int64()),
                                   pa.array([fingerprint(s) if len(s) else None for s in sets], pa.binary()),
                                   pa.array(near, pa.list_(pa.int64())), pa.array(far, pa.binary())], names=names)
            block += sets
            size += sum(map(len, sets))
            if size >= BLOCK_SHINGLES:
                yield counted(block)
                block, size = [], 0
    if block:
        yield counted(block)


def _frequent(facts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """At most FREQUENT shingles with their counts, the most frequent ones; sorted by hash."""
    counts = facts.filter("kind = 1").groupBy("id").agg(F.sum("n").alias("n"))
    counts = cut_lineage(counts)
    sizes = counts.groupBy(F.floor(F.log2("n") * 4).alias("level")).count().collect()  # some hundred rows at most
    least, total = None, 0
    for r in sorted(sizes, key=lambda r: -r["level"]):
        total += r["count"]
        if total > FREQUENT:
            break
        least = r["level"]
    if least is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    got = counts.filter(F.floor(F.log2("n") * 4) >= least).toArrow()
    ids = got["id"].to_numpy().view(np.uint64)
    order = np.argsort(ids)
    return ids[order], got["n"].to_numpy()[order]


def _prefixes(frequent):
    """Rows (token, salt, id, n, pos): the prefix shingles of each set that the task meets first."""
    def run(batches):
        ids, counts = frequent.value
        shingles, seen = Shingles(), set()
        for b in batches:
            doc_ids, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            for i, j in text_batches(texts, 1_000_000):
                out: list[list] = [[], [], [], [], []]
                for d, s in zip(doc_ids[i:j], shingles.sets(texts[i:j]), strict=True):
                    if not len(s) or d is None or (fp := fingerprint(s)) in seen:
                        continue
                    seen.add(fp)
                    p = probe_prefix(len(s))
                    at = np.searchsorted(ids, s)
                    at[at == len(ids)] = 0
                    known = np.flatnonzero(ids[at] == s) if len(ids) else at[:0]
                    first, salt = s[:p], np.zeros(p, np.int32)
                    if len(known) and known[0] < p:  # frequent shingles go last, the most frequent at the end
                        count = np.zeros(len(s), np.int64)
                        count[known] = counts[at[known]]
                        order = np.argsort(count, kind="stable")[:p]  # ties stay in hash order
                        first, salts = s[order], 1 + count[order] // BUCKET_ROWS
                        salt = np.where(salts > 1, int.from_bytes(fp[:4], "big") % salts + 1, 0)
                    for c, v in zip(out, (first.view(np.int64), salt, np.full(p, d), np.full(p, len(s)), np.arange(p)), strict=True):
                        c.append(v)
                if out[0]:
                    yield pa.record_batch([pa.array(np.concatenate(c).astype(k)) for c, k in
                                           zip(out, (np.int64, np.int32, np.int64, np.int64, np.int32), strict=True)],
                                          names=["token", "salt", "id", "n", "pos"])
    return run


def _pair_filters(na: Column, pa_: Column, nb: Column, pb: Column) -> Column:
    """Length, index prefix and positional filters for a shared prefix shingle, given sizes and positions."""
    need = F.floor((NUM * (na + nb) + NUM + DEN - 1) / (NUM + DEN))
    short, long, ps = F.least(na, nb), F.greatest(na, nb), F.when(na <= nb, pa_).otherwise(pb)
    ps = F.when(na == nb, F.least(pa_, pb)).otherwise(ps)
    index = short - F.floor((2 * NUM * short + NUM + DEN - 1) / (NUM + DEN)) + 1
    return (DEN * short >= NUM * long) & (ps < index) & (1 + F.least(na - pa_ - 1, nb - pb - 1) >= need)


def _verify(batches):
    shingles, sets, held = Shingles(), OrderedDict(), 0

    def of(node: int, column: pa.Array, k: int) -> np.ndarray:
        nonlocal held
        text = column[k].as_py()
        key = node, len(text), hash(text)
        if key not in sets:
            sets[key] = shingles(text)
            held += len(sets[key])
            while held > HELD_SHINGLES and len(sets) > 2:
                held -= len(sets.popitem(last=False)[1])
        sets.move_to_end(key)
        return sets[key]

    for b in batches:
        ids = zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)
        same = [linked(of(x, b.column(2), k), of(y, b.column(3), k)) for k, (x, y) in enumerate(ids)]
        yield pa.record_batch([b.column(0), b.column(1), pa.array(same, pa.bool_())], names=["a", "b", "linked"])


def _checked(pairs: DataFrame, texts: DataFrame, sigs: DataFrame, component: DataFrame, before: DataFrame | None) -> DataFrame:
    """(a, b, linked) of the distinct pairs across components that were not verified before; written. Texts move only for pairs
    whose whole signatures leave them open."""
    c = component.select(F.col("node").alias("id"), F.col("component").alias("c"))
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    pairs = (pairs.join(c.withColumnsRenamed({"id": "a", "c": "ca"}), "a", "left").join(c.withColumnsRenamed({"id": "b", "c": "cb"}), "b", "left")
             .filter(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b"))
    if before is not None:
        pairs = pairs.join(before.select("a", "b"), ["a", "b"], "left_anti")
    pairs = pairs.join(sigs.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("far").alias("sig_a")), "a").join(
        sigs.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("far").alias("sig_b")), "b")
    pairs = pairs.select("a", "b", "na", "nb", "sig_a", "sig_b").mapInArrow(_close, "a long, b long").distinct()
    both = (pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
            .join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b"))
    out = both.select("a", "b", "text_a", "text_b").mapInArrow(_verify, "a long, b long, linked boolean")
    return cut_lineage(out.groupBy("a", "b").agg(F.max("linked").alias("linked")))


def _maybe_in(ids: DataFrame):
    """A test whether an id (not null) may be one of ``ids`` (distinct, written): it has a bit for every remainder, so rows are told apart where they
    lie. It never denies an id that is there; it holds FILTER_BITS at most, beyond which it only lets more through."""
    spark = ids.sparkSession
    bits = min(FILTER_BITS, 8 * ids.count() + 64) | 1
    at = ids.select(F.pmod("id", F.lit(bits).cast("long")).alias("p"))
    got = at.groupBy(F.shiftright("p", 6).alias("w")).agg(F.expr("bit_or(shiftleft(1L, CAST(p % 64 AS INT)))").alias("b")).toArrow()
    words = np.zeros(bits // 64 + 1, np.int64)
    words[got["w"].to_numpy()] = got["b"].to_numpy()
    sent = spark.sparkContext.broadcast(words.view(np.uint64))

    def may(x: pd.Series) -> pd.Series:
        p = np.mod(x.to_numpy(np.int64), bits)
        return pd.Series((sent.value[p >> 6] >> (p & 63).astype(np.uint64)) & np.uint64(1) == 1)

    test = F.pandas_udf(may, "boolean")
    return lambda column: test(F.coalesce(column, F.lit(0).cast("long")))


def _may_meet(rows: DataFrame, comp: str) -> DataFrame:
    """Rows with a row of another component in their bucket whose size and place leave a link open; and all rows of salted
    shingles, whose partners may lie in other parts.

    Sizes that may be linked are at most SIZE_STEPS classes apart, so a window over classes tells whether there is one: as many
    frames a bucket as it has classes, and not one a row. The smaller set of a pair has the shingle in its index prefix.
    """
    classes = F.floor(F.log(F.col("n").cast("double")) * (SIZE_STEPS / (math.log(DEN / NUM) + 1e-6))).cast("int")
    bucket = Window.partitionBy("token", "salt").orderBy("_class")
    index = F.col("pos") < F.col("n") - F.floor((2 * NUM * F.col("n") + NUM + DEN - 1) / (NUM + DEN)) + 1
    mine, short = F.col(comp), F.when(F.col("_index"), F.col(comp))
    smaller, larger = bucket.rangeBetween(-SIZE_STEPS, 0), bucket.rangeBetween(0, SIZE_STEPS)
    # dealt by bucket before classes are added, which then do not move
    meets = rows.repartition("token", "salt").withColumns({"_class": classes, "_index": index}).withColumns({
        "_s0": F.min(short).over(smaller), "_s1": F.max(short).over(smaller), "_l0": F.min(mine).over(larger), "_l1": F.max(mine).over(larger)})
    return meets.filter((F.col("salt") > 0) | (F.col("_s0") < mine) | (F.col("_s1") > mine) | F.col("_index") & (
        (F.col("_l0") < mine) | (F.col("_l1") > mine))).drop("_class", "_index", "_s0", "_s1", "_l0", "_l1")


def _with_hubs(rows: DataFrame, seed: int, comp: str = "comp") -> DataFrame:
    """Rows that may meet one of another component in their bucket, each with a hub of its bucket and the bucket's number of such
    rows; one exchange. ``comp`` is the column of a node's component.

    With seed 0 a bucket's hub is its node with the least hash, so the buckets of one group share theirs; with others every
    bucket has a hub of its own, and nodes that the group's hub missed are soon caught by others. A bucket is a shingle, or
    one of the salts of a frequent one; such a part is kept even if all its rows are of one component.
    """
    own = [F.lit(seed)] if not seed else [F.lit(seed), F.col("token")]
    bucket = Window.partitionBy("token", "salt")
    me = F.struct(F.xxhash64("id", *own).alias("h"), "id", "n", "pos", F.col(comp).alias("comp"))
    return _may_meet(rows, comp).withColumns({"hub": F.min(me).over(bucket), "bucket": F.count("*").over(bucket)}).withColumn("comp", F.col(comp))


def _with_components(rows: DataFrame, component: DataFrame) -> DataFrame:
    c = component.select(F.col("node").alias("id"), F.col("component").alias("c"))
    return rows.drop("comp").join(c, "id", "left").withColumn("comp", F.coalesce("c", "id")).drop("c")


def _hub_pairs(live: DataFrame, seed: int) -> DataFrame:
    """Rows with their hub, in all rounds but the first at most PARTNERS a node; and the hubs of a salted shingle with
    one of them."""
    salted = live.filter("salt > 0").select("token", "hub").distinct()
    tops = salted.groupBy("token").agg(F.min("hub").alias("top"))
    rows = live.select("token", "id", "n", "pos", "comp", "hub").unionByName(
        salted.join(tops, "token").select("token", "hub.id", "hub.n", "hub.pos", "hub.comp", F.col("top").alias("hub")))
    rows = rows.filter((F.col("comp") != F.col("hub.comp")) & _pair_filters(
        F.col("n"), F.col("pos"), F.col("hub.n"), F.col("hub.pos")))
    if seed:
        rows = rows.groupBy("id", F.pmod("token", F.lit(PARTNERS)).alias("slot")).agg(F.min_by("hub", "hub.h").alias("hub"))
    return rows.select(F.col("id").alias("a"), F.col("hub.id").alias("b"))


def _all_pairs(rows: DataFrame, sigs: DataFrame, share: int = 1) -> DataFrame:
    """Pairs across components of a shingle: the rows outside its largest component with all rows. The suffix filter is by
    signatures: a pair whose signatures differ in more bits than linked sets may differ in shingles is no pair.

    A pair is given at the first shingle that its prefixes share, and where it shares none of the LOOKED_BACK shingles
    before it in both; so near copies come up a few times and not once for every shingle. Rows are dealt by id, which
    gives them those shingles and their signature, and by shingle, where the pairs meet; nothing else moves. A salted
    shingle may have any number of rows: its sums are pre-aggregated, and its rows go through a join that Spark splits. With a
    ``share`` the rows outside meet only one of so many nodes.
    """
    before = Window.partitionBy("id").orderBy("pos").rowsBetween(-LOOKED_BACK, -1)
    rows = rows.withColumn("back", F.collect_list("token").over(before)).join(sigs.select("id", F.col("n").alias("of"), "sig"), "id")
    rows = rows.filter("n = of").select("token", "salt", "id", "n", "pos", "comp", "back", "sig")
    token = Window.partitionBy("token")
    alone = (rows.filter("salt = 0").withColumn("lo", F.min("comp").over(token)).withColumn("hi", F.max("comp").over(token)).filter("lo < hi")
             .withColumn("k", F.count("*").over(Window.partitionBy("token", "comp")))
             .withColumn("major", F.max(F.struct("k", "comp")).over(token)["comp"]).drop("lo", "hi", "k"))
    salted = rows.filter("salt > 0")
    sizes = salted.groupBy("token", "comp").count().groupBy("token").agg(
        F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.max(F.struct("count", "comp"))["comp"].alias("major")).filter("lo < hi")
    return _meeting(alone, share).unionByName(_meeting(salted.join(sizes.select("token", "major"), "token"), share))


def _meeting(rows: DataFrame, share: int) -> DataFrame:
    """(a, b) of the rows (token, id, n, pos, comp, major, back, sig) that meet at a shingle and pass the filters."""
    x, y = rows.filter("comp != major").alias("x"), rows.filter(F.pmod(F.xxhash64("id"), F.lit(share)) == 0).alias("y")
    once = (F.col("y.comp") == F.col("y.major")) | (F.col("x.id") < F.col("y.id"))
    differ = sum((F.bit_count(F.col("x.sig")[k].bitwiseXOR(F.col("y.sig")[k])) for k in range(1, SIGNATURE_BITS // 64)),
                 F.bit_count(F.col("x.sig")[0].bitwiseXOR(F.col("y.sig")[0])))
    n = F.col("x.n") + F.col("y.n")
    near = differ <= n - 2 * F.floor((NUM * n + NUM + DEN - 1) / (NUM + DEN))
    return x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.comp") != F.col("y.comp")) & once & _pair_filters(
        F.col("x.n"), F.col("x.pos"), F.col("y.n"), F.col("y.pos")) & near & ~F.arrays_overlap("x.back", "y.back")).select(
        F.col("x.id").alias("a"), F.col("y.id").alias("b"))


def _merged(component: DataFrame, links: DataFrame) -> DataFrame:
    """(node, component) after further links: the components they join are merged."""
    c = component.select("node", "component")
    ends = (links.join(c.select(F.col("node").alias("a"), F.col("component").alias("ca")), "a", "left")
            .join(c.select(F.col("node").alias("b"), F.col("component").alias("cb")), "b", "left")
            .select("a", "b", F.coalesce("ca", "a").alias("ca"), F.coalesce("cb", "b").alias("cb")))
    ends = cut_lineage(ends)
    top = connected_components(ends.select(F.col("ca").alias("a"), F.col("cb").alias("b")))
    nodes = c.unionByName(ends.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("ca").alias("component")),
                                                        F.struct(F.col("b").alias("node"), F.col("cb").alias("component")))).alias("x"))
                          .select("x.node", "x.component")).distinct()
    return cut_lineage(nodes.join(top.select(F.col("node").alias("component"), F.col("component").alias("further")), "component", "left")
                       .select("node", F.coalesce("further", "component").alias("component")))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id of every row: documents linked by a Jaccard similarity of 0.75 or more of
    their distinct 5-word shingles, directly or through others, share the smallest doc_id among them.

    A text of fewer than five words is one shingle; a null or blank text has none and links with nothing. A row with a
    null id is returned with a null component and links with nothing. Repeated rows each give a row. An id that
    stands for several texts is linked by any of them. An empty table gives none. Only the two columns are read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    facts = cut_lineage(rows.mapInArrow(_facts, "kind int, id long, n long, fp binary, sig array<long>, far binary"))
    frequent = spark.sparkContext.broadcast(_frequent(facts))
    prefixes = rows.mapInArrow(_prefixes(frequent), "token long, salt int, id long, n long, pos int")
    # Every document is its own component at first, so a bucket of two documents is kept.
    live = cut_lineage(_with_hubs(prefixes, 0, "id"))
    free_finished(spark)
    # Dealt by id once and kept there; every round's joins find the texts in place. Lost parts are read again.
    dealt = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Texts of documents that may meet no other stay where they are.
    held = cut_lineage(live.select("id").distinct())
    texts = (rows.filter(F.col("id").isNotNull() & _maybe_in(held)(F.col("id"))).join(held, "id", "left_semi")
             .repartition(dealt, "id").persist(StorageLevel.MEMORY_AND_DISK))
    free_finished(spark)

    sets = facts.filter("kind = 0 and id is not null and n > 0")
    sigs = cut_lineage(sets.select("id", "n", "sig", "far").join(held, "id", "left_semi").distinct())
    first = sets.groupBy("fp").agg(F.min("id").alias("rep"))
    # Several texts under one id: all of its sets are one node, so equal sets are links like any other.
    equal = sets.select("id", "fp").distinct().join(first, "fp").filter("id != rep").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    component, done, links = connected_components(equal), None, 0
    for step in range(HUB_ROUNDS + 2):
        if step == HUB_ROUNDS and links < MANY_LINKS:
            continue
        if step:
            old, rows_left = live, _with_components(live.select("token", "salt", "id", "n", "pos", "bucket"), component)
            if step < HUB_ROUNDS:
                live = cut_lineage(_with_hubs(rows_left.drop("bucket"), step))
                drop_written(old)
                free_finished(spark)
        if step < HUB_ROUNDS:
            pairs = _hub_pairs(live, step)
        elif step == HUB_ROUNDS:  # a small bucket has no large group
            pairs = _all_pairs(rows_left.filter((F.col("bucket") >= FIRST_ROWS) | (F.col("salt") > 0)), sigs, FIRST_SHARE)
        else:
            pairs = _all_pairs(rows_left, sigs)
        new = _checked(pairs, texts, sigs, component, done)
        done = new if done is None else done.unionByName(new)
        component = _merged(component, new.filter("linked"))
        free_finished(spark)
        if step == HUB_ROUNDS - 1:
            links = new.filter("linked").count()
    texts.unpersist()
    drop_written(live)
    return (facts.filter("kind = 0").join(component.withColumnRenamed("node", "id"), "id", "left")
            .select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
                    F.coalesce("component", "id").alias("component_id")))


def first_of_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: of each component the document with the smallest id, once, and every row with a
    null id. Of several rows under that id the one whose text has the least hash stays.
    """
    # Rows move only if their id goes or stands more than once; all others stay where they are.
    of = cut_lineage(jaccard_components(docs, id_col, text_col).filter("doc_id is not null").groupBy(F.col("doc_id").alias("_id")).agg(
        F.count("*").alias("_n"), F.min("component_id").alias("_component")))
    special = cut_lineage(of.filter("_n > 1 or _id != _component").select(F.col("_id").alias("id"), (F.col("_id") == F.col("_component")).alias("stays")))
    may = _maybe_in(special)
    id_ = F.col(id_col).cast("long")
    whole = docs.filter(id_.isNotNull()).select(id_.alias("i"), F.xxhash64(F.col(text_col)).alias("h"),
                                                F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("r"))  # no name of theirs can clash
    meant = whole.filter(may(F.col("i"))).join(special.withColumnRenamed("id", "_id"), F.col("i") == F.col("_id"), "left").filter("stays is null or stays")
    once = meant.withColumn("k", F.row_number().over(Window.partitionBy("i").orderBy("h"))).filter("k = 1")
    return (whole.filter(~may(F.col("i"))).select("r.*").unionByName(once.select("r.*")).unionByName(docs.filter(docs[id_col].isNull())))


def op5_ngram_jaccard(spark, sf_dir: str) -> DataFrame:
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
