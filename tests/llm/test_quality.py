"""Quality rules (2): counts against plain Python, estimates and verdicts against NumPy."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from godown.llm import mcd_quality as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    seen = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if seen[tuple(words[i:i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))


def failed(c):
    return c[0] < 50 or 100 * c[4] > 50 * c[0]


def vector(text, c):
    n_lines = len([x for x in (text or "").split("\n") if WORD.search(x)])
    raw = (math.log(max(c[1], 1) / max(c[0], 1)) if c[0] else 0.0, math.sqrt(c[2] / max(c[1], 1)), math.sqrt(c[3] / max(n_lines, 1)),
           math.sqrt(c[4] / max(c[0], 1)))
    return np.array(raw)


@pytest.fixture(scope="module")
def prose(rows):
    """The corpus, and a large group with junk in it: symbols in one, very long words in the other."""
    from llm.awkward import text
    rnd = random.Random(21)
    more = [(1000 + k, text(rnd, rnd.randint(80, 400)), "fr", f"big{k % 2}") for k in range(260)]
    more += [(2000 + k, " | ".join(text(rnd, 120).split()), "fr", "big0") for k in range(12)]
    more += [(2100 + k, " ".join(w * 6 + str(i) for i, w in enumerate(text(rnd, 120).split())), "fr", "big1") for k in range(12)]
    return rows + more


@pytest.fixture(scope="module")
def table(spark, prose):
    from llm.awkward import EXTRA
    from pyspark.sql import functions as F
    df = spark.createDataFrame(prose, "doc_id long, text string, lang string, source string")
    return df.withColumns({c: F.lit(f"own {c}") for c in EXTRA}).repartition(3)


def brute_distances(rows):
    """Distances by the least determinant of 41 starts on whole arrays, each run until it stands still, with exact nearest shares."""
    groups = defaultdict(list)
    for k, (_, t, lang, source) in enumerate(rows):
        if not failed(counts(t)):
            groups[lang, source].append(k)
    pools = defaultdict(list)
    for key, members in groups.items():
        pools[key if len(members) >= Q.MIN_GROUP else (key[0],)] += members
    rest = [k for key, members in pools.items() if len(members) < Q.MIN_GROUP for k in members]
    pools = {key: m for key, m in pools.items() if len(m) >= Q.MIN_GROUP} | {(): rest}
    floor, out = np.array(Q.FLOORS), {}
    for members in pools.values():
        if not members:
            continue
        x = np.stack([vector(rows[k][1], counts(rows[k][1])) for k in members])
        q1, q2, q3 = (np.quantile(x, q, axis=0, method="inverted_cdf") for q in (0.25, 0.5, 0.75))
        ranges, best = np.maximum((q3 - q1) / 1.349, floor), None
        drawn = [x[k] for k in np.random.default_rng(1).integers(0, len(x), 20)]
        for mean, scale in [(q2, ranges), *((m, s) for m in drawn for s in (ranges, floor))]:
            cov = np.diag(scale ** 2)
            for _ in range(50):
                d = np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)
                near = x[np.argsort(d, kind="stable")[:math.ceil(Q.SHARE * len(x))]]
                mean, cov = near.mean(axis=0), np.cov(near.T, bias=True) + np.diag(floor ** 2)
            if best is None or np.linalg.det(cov) < best[0]:
                best = np.linalg.det(cov), mean, cov
        _, mean, cov = best
        d = np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)
        out |= dict(zip(members, d / max(1.0, np.median(d) / Q.CHI2_MEDIAN), strict=True))
    return out


def test_counts_and_verdicts(table, prose):
    got = defaultdict(list)
    for r in Q.quality(table).collect():
        got[r.doc_id].append(r)
    distance = brute_distances(prose)
    assert sum(map(len, got.values())) == len(prose)
    rejected = 0
    for k, (d, t, _, _) in enumerate(prose):
        c = counts(t)
        r = next(r for r in got[d] if (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == c)
        assert r.base_failed == failed(c)
        if failed(c):
            assert not r.kept and r.distance is None
            continue
        assert r.distance == pytest.approx(distance[k], rel=0.25, abs=0.3)  # nearest shares end at whole bins
        if not 0.7 * Q.CUTOFF < distance[k] < 1.4 * Q.CUTOFF:
            assert r.kept == (distance[k] <= Q.CUTOFF)
        rejected += not r.kept
    assert rejected >= 20
    assert all(r.kept for d, rs in got.items() if d is not None and 1000 <= d < 2000 for r in rs)
    assert not any(r.kept for d, rs in got.items() if d is not None and 2000 <= d < 2112 for r in rs)


def test_filter_keeps_rows_whole(table):
    kept = Q.quality_filter(table)
    assert kept.columns == table.columns
    want = Counter(r.doc_id for r in Q.quality(table).filter("kept").collect())
    assert Counter(r.doc_id for r in kept.select("doc_id").collect()) == want


def test_empty_table_and_native_plan(table, capsys):
    assert Q.quality(table.filter("false")).collect() == []
    assert Q.quality_filter(table.filter("false")).collect() == []
    Q.quality(table).explain()
    Q.statistics(table).explain()
    assert not re.search("Python|Pandas|Arrow", capsys.readouterr().out)


def test_each_statistic_rejects_alone(spark):
    """In a group where nobody else repeats anything: a listing in varying order, and a text said half over again."""
    from llm.awkward import text
    rnd = random.Random(5)
    rows = [(k, text(rnd, rnd.randint(80, 400)), "en", "a") for k in range(150)]
    items = text(rnd, 40).split() * 5
    rnd.shuffle(items)
    words = text(rnd, 380).split()
    rows += [(200, "\n".join(items), "en", "a"), (201, " ".join(words + words[:118]), "en", "a"),
             (202, " ".join(x + " |" * (k % 8 == 0) for k, x in enumerate(words)), "en", "a"), (203, " ".join(x * 2 for x in words), "en", "a")]
    at = {r[0]: counts(r[1]) for r in rows}
    assert at[200][3] > 0.75 * 200 and at[201][3] == 0 and 0.45 < at[201][4] / at[201][0] < 0.5
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in Q.quality(df).collect()}
    assert not any(r.base_failed for r in got.values())
    assert {d for d, r in got.items() if not r.kept} == {200, 201, 202, 203}


@pytest.mark.parametrize("share", [0.2, 0.4])
def test_much_junk_of_one_kind(spark, share):
    """Symbols in every word, or words of six times the length, in up to two fifths of a group: all of it goes, nothing else."""
    from llm.awkward import text
    rnd = random.Random(9)
    n, rows = 300, []
    for source, junk in (("a", lambda t: " | ".join(t.split())), ("b", lambda t: " ".join(w * 6 for w in t.split()))):
        for k in range(n):
            t = text(rnd, rnd.randint(80, 300))
            rows.append((len(rows), junk(t) if k < share * n else t, "en", source))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)
    got = {r.doc_id: r for r in Q.quality(df).collect()}
    assert not any(r.base_failed for r in got.values())
    assert {d for d, r in got.items() if not r.kept} == {d for d in got if d % n < share * n}


def test_least_determinant_of_all_starts(spark):
    """Two clouds, the tighter one with three fifths of the rows: no start that ends in the wide one may win."""
    rnd = np.random.default_rng(2)
    tight, wide = rnd.normal(0.3, 0.01, (180, 4)), rnd.normal(0.6, 0.2, (120, 4))
    rows = [("g", *(int(v * Q.UNIT) for v in r)) for r in np.concatenate([tight, wide])]
    df = spark.createDataFrame(rows, "grp string, " + ", ".join(f"{d} long" for d in Q.DIMS)).repartition(4)
    r = Q._estimate(df, Q.SHARE).collect()
    assert len(r) == 1 and all(abs(r[0][f"m{k}"] / Q.UNIT - 0.3) < 0.01 for k in range(4))
    again = Q._estimate(df.repartition(7), Q.SHARE).collect()
    assert again == r
