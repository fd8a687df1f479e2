"""Similarity joins (5, 7) and components against brute force."""

import random
import re

import numpy as np
import pytest

from godown.llm import components, int8_neardup, ngram_jaccard


def union_find(nodes, links):
    parent = {n: n for n in nodes}

    def find(a):
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a
    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rnd = random.Random(2)
    links = [(k, k + 1) for k in range(60)] + [(200, 200 + k) for k in range(1, 40)]
    links += [(rnd.randint(300, 400), rnd.randint(300, 400)) for _ in range(70)]
    df = spark.createDataFrame([*links, (None, 3), (5, 5), (0, 1)], "a long, b long")
    got = {r.node: r.component for r in components.connected_components(df).collect()}
    nodes = {n for a, b in links if a != b for n in (a, b)}
    assert got == union_find(nodes, [x for x in links if x[0] != x[1]])
    assert components.connected_components(df.filter("false")).collect() == []


def test_links_that_are_stars_need_no_step(spark, monkeypatch):
    steps = []
    monkeypatch.setattr(components, "_small_star", lambda links, step=components._small_star: steps.append(1) or step(links))
    links = [(1, 2), (3, 1), (1, 2), (2, 1), (7, 9), (5, 5), (None, 4)]
    got = components.connected_components(spark.createDataFrame(links, "a long, b long"))
    assert {tuple(r) for r in got.collect()} == {(1, 1), (2, 1), (3, 1), (7, 7), (9, 7)} and not steps
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).collect() == [] and not steps
    chain = components.connected_components(spark.createDataFrame([(9, 4), (4, 2), (9, 3)], "a long, b long"))
    assert {tuple(r) for r in chain.collect()} == {(2, 2), (3, 2), (4, 2), (9, 2)} and steps


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    n = max(1, len(words) - 4)
    return {tuple(words[i:i + 5]) for i in range(n)} if words else set()


def brute_jaccard(rows):
    sets = [(d, shingles(t)) for d, t, *_ in rows]
    ids = {d for d, _ in sets if d is not None}
    links = [(a, b) for i, (a, x) in enumerate(sets) for b, y in sets[:i]
             if None not in (a, b) and a != b and x and y and 100 * len(x & y) >= 75 * len(x | y)]
    return sets, union_find(ids, links)


def test_jaccard_components(docs, rows, no_docs):
    sets, want = brute_jaccard(rows)
    got = sorted(map(tuple, ngram_jaccard.jaccard_components(docs).collect()), key=str)
    assert got == sorted([(d, len(s), want.get(d)) for d, s in sets], key=str)
    assert len(set(want.values())) < len(want) - 5
    kept = ngram_jaccard.first_of_components(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.filter("doc_id is not null").select("doc_id").collect()) == sorted(d for d in want if want[d] == d)
    assert kept.filter("doc_id is null").count() == sum(d is None for d, *_ in rows)
    assert ngram_jaccard.jaccard_components(no_docs).collect() == []


def test_jaccard_of_dense_groups(spark, monkeypatch):
    """Chains and clusters of near copies around the threshold, with salted and listed shingles."""
    monkeypatch.setattr(ngram_jaccard, "BUCKET_ROWS", 5)
    monkeypatch.setattr(ngram_jaccard, "LOCAL_COUNT", 2)
    rnd = random.Random(4)
    rows, base = [], [f"w{k}" for k in range(400)]
    for g in range(6):
        words = [rnd.choice(base) for _ in range(rnd.randint(8, 60))]
        for k in range(25):
            rows.append((len(rows), " ".join(words)))
            if g % 2:
                words = list(words)  # a chain: each copy differs from the one before
            own = words if g % 2 else list(words)
            own[rnd.randrange(len(own))] = f"x{len(rows)}"
            if not g % 2:
                rows[-1] = (rows[-1][0], " ".join(own))
    rnd.shuffle(rows)
    sets, want = brute_jaccard(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_jaccard.jaccard_components(df).collect()}
    assert got == {d: (len(s), want[d]) for d, s in sets}


def test_filters_never_lose_a_pair():
    rnd = np.random.default_rng(3)
    for _ in range(400):
        x = np.unique(rnd.integers(0, 60, rnd.integers(1, 50)).astype(np.uint64))
        y = np.unique(np.concatenate([x[rnd.random(len(x)) < 0.9], rnd.integers(0, 60, rnd.integers(0, 6)).astype(np.uint64)]))
        both = len(np.intersect1d(x, y))
        want = len(y) > 0 and 100 * both >= 75 * (len(x) + len(y) - both)
        assert ngram_jaccard.suffix_overlap(x, y) >= both
        assert ngram_jaccard.linked(x, y) == want
        if want:
            a, b = (x, y) if len(x) <= len(y) else (y, x)
            assert set(a[:ngram_jaccard.index_prefix(len(a))]) & set(b[:ngram_jaccard.probe_prefix(len(b))])


def vectors(rnd, n=300, dim=24):
    centre = rnd.normal(size=(6, dim))
    x = centre[rnd.integers(0, 6, n)] + rnd.normal(size=(n, dim)) * rnd.choice([0.1, 0.25, 0.35], (n, 1))
    rows = [(k, [float(np.float32(v)) for v in x[k]], 0) for k in range(n)]
    rows += [(1000 + k, rows[3][1], 1) for k in range(40)] + [rows[3], rows[4]]
    rows += [(2000, None, 0), (2001, [], 0), (2002, [0.0] * dim, 0), (2003, [None] + [1.0] * (dim - 1), 0),
             (2004, [float("nan")] + [1.0] * (dim - 1), 0), (2005, [float("inf")] * dim, 0), (2006, [1.0, 2.0], 0), (2007, [2.0, 4.0], 0),
             (None, rows[3][1], 0), (None, None, 0)]
    return rows


def test_very_large_and_small_components(spark):
    rows = [(1, [1e-150, 1e-150]), (2, [1e-150, 1e-150]), (3, [1e200, 1e200]), (4, [2e200, 2e200]), (5, [5e-324, 0.0]), (6, [0.0, 3e-310]),
            (7, [1.7e308, -1.7e308]), (8, [-1e-300, 1e-300]), (9, [0.0, -0.0]), (10, [3.0, 3.0])]
    got = int8_neardup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == {
        1: (4, 1), 2: (4, 1), 3: (4, 1), 4: (4, 1), 5: (0, 5), 6: (0, 6), 7: (0, 7), 8: (0, 8), 9: (0, 9), 10: (4, 1)}


def test_long_words_of_a_regular_build_differ():
    """Thue-Morse words have equal polynomial hashes modulo a power of two."""
    a, b = "a", "b"
    for _ in range(12):
        a, b = a + b, b + a
    got = ngram_jaccard.Shingles().sets([f"w x {a} y z", f"w x {b} y z", a, b, a + " " + b])
    assert len({tuple(s.tolist()) for s in got}) == 5


def brute_vectors(rows, t=0.95):
    ok = [(k, r[0], np.array(r[1], np.float64)) for k, r in enumerate(rows) if r[0] is not None and r[1] and None not in r[1]
          and np.isfinite(r[1]).all() and any(r[1])]
    links, count = [], dict.fromkeys(range(len(rows)), 0)
    for i, a, x in ok:
        for j, b, y in ok:
            if i != j and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= t:
                count[i] += 1
                if a != b:
                    links.append((a, b))
    return count, union_find({r[0] for r in rows if r[0] is not None}, links)


@pytest.mark.parametrize("block", [2048, 20])
def test_near_duplicates(spark, block):
    from pyspark.sql import functions as F
    rows = vectors(np.random.default_rng(block))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumns(
        {c: F.lit("own") for c in ("rep", "raw", "cell", "dim", "m", "home", "n", "component")})
    count, comp = brute_vectors(rows)
    got = sorted(map(tuple, int8_neardup.near_duplicates(df.repartition(3), block=block).collect()), key=str)
    assert got == sorted([(r[0], count[k], comp.get(r[0]), comp.get(r[0], -1) == r[0]) for k, r in enumerate(rows)], key=str)
    assert int8_neardup.near_duplicates(df.filter("false")).collect() == []


def test_tiles_are_exact_at_the_threshold():
    rnd = np.random.default_rng(9)
    x = rnd.normal(size=(400, 16))
    x[200:] = x[:200] + rnd.normal(size=(200, 16)) * 0.3
    unit = x / np.sqrt((x * x).sum(axis=1))[:, None]
    for t in (0.9, 0.95, 0.99):
        i, j = int8_neardup.tile_links(x, x, t, True)
        a, b = np.nonzero(np.triu(unit @ unit.T >= t, 1))
        assert set(zip(i.tolist(), j.tolist(), strict=True)) == set(zip(a.tolist(), b.tolist(), strict=True))


def test_a_part_of_a_large_group_is_met_first(spark, monkeypatch):
    """Copies of one text around the threshold: the exhaustive round has two steps, and its result is that of one."""
    monkeypatch.setattr(ngram_jaccard, "MANY_LINKS", 1)
    rnd, shares, whole = random.Random(8), [], ngram_jaccard._all_pairs
    monkeypatch.setattr(ngram_jaccard, "_all_pairs", lambda rows, sigs, share=1: shares.append(share) or whole(rows, sigs, share))
    base, rows = [f"w{k}" for k in range(120)], []
    for k in range(80):
        words = list(base)
        for i in rnd.sample(range(120), rnd.randint(1, 4)):
            words[i] = f"x{k}.{i}"
        rows.append((k, " ".join(words)))
    sets, want = brute_jaccard(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in
           ngram_jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {d: (len(s), want[d]) for d, s in sets} and shares == [ngram_jaccard.FIRST_SHARE, 1]


def test_a_share_of_a_bucket_is_a_part_of_its_pairs(spark):
    """One node outside a component of 320, which all share a shingle."""
    rows = spark.createDataFrame([(1, 0, i, 100, 0, int(i < 320)) for i in range(321)], "token long, salt int, id long, n long, pos int, comp long")
    sigs = spark.createDataFrame([(i, 100, [0, 0, 0, 0]) for i in range(321)], "id long, n long, sig array<long>")
    part, every = ({tuple(r) for r in ngram_jaccard._all_pairs(rows, sigs, share).collect()} for share in (16, 1))
    assert every == {(320, i) for i in range(320)} and part < every and 4 <= len(part) <= 60


def test_rows_without_a_possible_partner_are_dropped_and_no_other(spark):
    """A row stays exactly as long as the filters of a pair could hold for it, up to the width of a class; copies always stay."""
    rnd = random.Random(11)
    rows = [(t, 0, i, n, rnd.randrange(ngram_jaccard.probe_prefix(n)), i) for t in range(60) for i in range(t % 9 + 1)
            for n in [int(10 ** rnd.uniform(0, 4)) + 1]]
    rows += [(99, 0, 100, 30, 0, 100), (99, 0, 101, 30, 0, 101), (98, 0, 102, 30, 0, 102), (98, 0, 103, 300, 0, 103), (97, 2, 104, 5, 0, 104)]
    df = spark.createDataFrame(rows, "token long, salt int, id long, n long, pos int, comp long")
    got = {tuple(r) for r in ngram_jaccard._may_meet(df, "comp").collect()}
    x, y = df.alias("x"), df.alias("y")
    col = ngram_jaccard.F.col
    pairs = x.join(y, (col("x.token") == col("y.token")) & (col("x.comp") != col("y.comp")) & ngram_jaccard._pair_filters(
        col("x.n"), col("x.pos"), col("y.n"), col("y.pos"))).select("x.*").distinct()
    assert {tuple(r) for r in pairs.collect()} <= got < set(rows)
    assert {r[2] for r in got if r[0] >= 97} == {100, 101, 104}


def test_ids_that_are_there_pass_the_test_of_ids(spark, monkeypatch):
    ids = [0, 5, -7, 2**62, -2**63, 64, 128]
    for bits in (1 << 26, 8):
        monkeypatch.setattr(ngram_jaccard, "FILTER_BITS", bits)
        may = ngram_jaccard._maybe_in(spark.createDataFrame([(i,) for i in ids], "id long"))
        assert spark.createDataFrame([(i,) for i in [*ids, None]], "id long").filter(may(ngram_jaccard.F.col("id"))).count() >= len(ids)
    monkeypatch.setattr(ngram_jaccard, "FILTER_BITS", 1 << 26)
    may = ngram_jaccard._maybe_in(spark.createDataFrame([(i,) for i in ids], "id long"))
    assert spark.range(200).filter(may(ngram_jaccard.F.col("id"))).count() < 60


def test_first_of_components_keeps_one_row_an_id_and_every_row_without(spark):
    long = " ".join(f"w{k}" for k in range(40))
    rows = [(1, long, "a"), (2, long, "b"), (3, "x " + long, "c"), (4, "other words than those that stand above", "d"), (4, "second text of one id", "e"),
            (5, None, "f"), (None, long, "g"), (None, "n", "h"), (6, "", "i"), (6, "", "j")]
    got = ngram_jaccard.first_of_components(spark.createDataFrame(rows, "doc_id int, text string, r string"))
    assert got.schema.simpleString() == "struct<doc_id:int,text:string,r:string>"
    assert sorted(str(r.doc_id) for r in got.collect()) == ["1", "4", "5", "6", "None", "None"]
