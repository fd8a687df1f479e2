"""Filter audit (11), license scan (12) and vector codes (13) against brute force."""

import hashlib
import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
import pytest

from godown.llm import filter_audit, gnat_codes, license_scan, pieces
from llm.awkward import EXTRA


# ------------------------------------------------------------------------------------------ 11
def failing(text, smaller):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {f for f, bad in (("A", len(words) < 100), ("B", 100 * len(set(words)) < 80 * len(words)),
                             ("C", 100 * len(re.findall("[A-Z]", text)) > 10 * len(text)), ("D", bool(re.search(r"[#$%&*|]", text))),
                             ("E", smaller)) if bad}


def brute_audit(rows, labels):
    good, toxic = ({d for d, *x in labels if d is not None and x[k] == 1} for k in (0, 1))
    out, shapley = {}, Counter()
    fails = [failing(t, d is not None and any(e is not None and e < d and (u or "") == (t or "") for e, u, *_ in rows)) for d, t, *_ in rows]
    for order in permutations("ABCDE"):
        left = set(range(len(rows)))
        for s, f in enumerate(order, 1):
            gone = {k for k in left if f in fails[k]}
            for part in {r[2] or "" for r in rows}:
                own = {k for k, r in enumerate(rows) if (r[2] or "") == part}
                out[part, "".join(order), s] = (len((left - gone) & own), len(gone & own), len({k for k in own - left if f in fails[k]}),
                                                sum(fails[k] == {f} for k in own), sum(rows[k][0] in good for k in gone & own),
                                                sum(rows[k][0] in toxic for k in gone & own))
                shapley[part, f] += len(gone & own)
            left -= gone
    return {(p, o, s): (*v, shapley[p, o[s - 1]]) for (p, o, s), v in out.items()}


def test_filter_audit(spark, docs, rows, no_docs):
    labels = [(k, k % 2, k % 3 == 0) for k in range(0, 20)] + [(100, 1, 1), (100, 0, None), (101, None, 1), (None, 1, 1), (406, 1, None), (9999, 1, 1)]
    lab = spark.createDataFrame([(d, q, None if t is None else int(t)) for d, q, t in labels], "doc_id long, quality int, toxic int")
    got = filter_audit.filter_audit(docs, lab).collect()
    want = brute_audit(rows, labels)
    assert {tuple(r[:3]): tuple(r[3:]) for r in got} == want and len(got) == len(want) == 600 * len({p for p, *_ in want})
    assert sum(v[2] for v in want.values()) > 0 and any(v[3] for v in want.values())
    assert filter_audit.filter_audit(no_docs, lab).collect() == []
    none = filter_audit.filter_audit(docs, lab.filter("false")).agg({"good_lost": "sum", "toxic_lost": "sum"}).first()
    assert tuple(none) == (0, 0)


def test_min_plus_product():
    orders, places = filter_audit.positions(4)
    masks = np.arange(16)
    step = filter_audit.removal_steps(masks, places)
    for m in masks:
        for o, order in enumerate(orders):
            assert step[m, o] == next((s for s, f in enumerate(order) if m >> f & 1), 4)


@pytest.mark.parametrize("size", [1, 3, 7, 1 << 20])
def test_pieces(size):
    rnd = random.Random(size)
    for _ in range(60):
        raw = bytes(rnd.choice(b"ab \n\x0b.") for _ in range(rnd.randint(0, 40)))
        table = bytes(32 if c == 46 else c for c in range(256))
        assert [w for ws in pieces.word_pieces(raw, table, size) for w in ws] == raw.replace(b".", b" ").split()


# ------------------------------------------------------------------------------------------ 12
def brute_places(text, phrases):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return len(words), sorted((k, p) for p in phrases for k in range(len(words)) if words[k:k + p.count(" ") + 1] == p.split(" "))


PHRASES = [*license_scan.BASE, *license_scan.NOTICES, license_scan.TAG]


def licence_texts():
    rnd = random.Random(12)
    words = [w for p in PHRASES for w in p.split(" ")] + ["é", "Word", "x1", "GNU", "Cc", "BY"]
    out = [" ".join(rnd.choice(PHRASES).upper() if rnd.random() < 0.2 else rnd.choice(words) for _ in range(rnd.randint(1, 60))) for _ in range(60)]
    out = [re.sub(" ", lambda m: rnd.choice([" ", "\n", "--", ". ", "\t"]), t) for t in out]
    return [*out, "cc by cc by cc-by", "ccbyé cc byé cc by", "cc byİ", "CC\x7fBY", "", None, " \n", "mit license " * 20_000, "ÀCC BY"]


@pytest.mark.parametrize("size", [5, 40, 1 << 20])
def test_places(size):
    for t in licence_texts():
        t = t if size > 40 or t is None else t[:3000]
        n, got = license_scan.places((t or "").encode().lower(), size)
        assert (n, sorted(got)) == brute_places(t, PHRASES)


def test_license_scan(spark, docs, rows, no_docs):
    from pyspark.sql import functions as F
    texts = licence_texts()
    df = spark.createDataFrame([*enumerate(texts), (None, "cc by"), (3, texts[3])], "doc_id long, text string").withColumns(
        {c: F.lit("own") for c in EXTRA})
    for frame, given in ((df.repartition(3), [*enumerate(texts), (None, "cc by"), (3, texts[3])]), (docs, [r[:2] for r in rows])):
        got = sorted((tuple(r[:6]) for r in license_scan.license_scan(frame).collect()), key=str)
        want = []
        for d, t in given:
            n, found = brute_places(t, license_scan.BASE)
            at = [k for k, _ in found]
            want.append((d, n, len(at), min(at, default=None), max(at, default=None), ",".join(sorted({license_scan.BASE[p] for _, p in found}))))
        assert got == sorted(want, key=str)
    assert license_scan.license_scan(no_docs).collect() == []


def test_expressions():
    def read(t):
        return license_scan.parse_expression(t.lower().encode())
    assert read("MIT OR Apache-2.0 AND BSD-3-Clause") == "mit apache-2.0 bsd-3-clause and or".split()
    assert read("(MIT OR Apache-2.0) AND BSD-3-Clause") == "mit apache-2.0 or bsd-3-clause and".split()
    assert read("GPL-2.0+ WITH Classpath-exception-2.0 OR MIT\nAND ISC") == "gpl-2.0+ classpath-exception-2.0 with mit or".split()
    assert read(" (MIT) */") == read("mit. This is") == read("MIT OR") == read("((MIT AND (") == read("MIT )") == ["mit"]
    assert read("") == read("OR MIT") == read(") MIT") == read("\nMIT") == []
    assert read("(" * 5000 + "a" + ")" * 5000) == ["a"]
    # Against Python's own grammar, by truth tables
    rnd = random.Random(1)
    for _ in range(200):
        t = rnd.choice("abc")
        for _ in range(rnd.randint(0, 6)):
            t = rnd.choice([f"({t})", f"{t} or {rnd.choice('abc')}", f"{rnd.choice('abc')} and {t}", f"({t} and {rnd.choice('abc')})"])
        for bits in range(8):
            values = dict(zip("abc", (bool(bits & 1), bool(bits & 2), bool(bits & 4)), strict=True))
            stack = []
            for x in read(t):
                if x in values:
                    stack.append(values[x])
                else:
                    y, z = stack.pop(), stack.pop()
                    stack.append((y or z) if x == "or" else (y and z))
            assert stack == [eval(t, {}, values)]


def test_evaluation():
    value = license_scan.evaluate
    assert value(["gpl-3.0-only", "mit", "or"]) == (0.9, {"gpl", "mit"}) and value(["gpl-3.0-only", "mit", "and"])[0] == 0.4
    assert value(["gpl-2.0+", "classpath-exception-2.0", "with"]) == (0.6, {"gpl"}) and value(["licenseref-own"]) == (0.2, {"licenseref-own"})
    got = license_scan.scan("Code\n// SPDX-License-Identifier: GPL-2.0-or-later OR (MIT AND CC-BY-4.0)\nspdx license identifier: ISC\nAll rights reserved. MIT License")
    assert (got["labels"], got["base_labels"], got["score"]) == ("all-rights-reserved,cc-by,gpl,mit", "cc-by,mit", 0.9)
    assert got["expressions"] == ["gpl-2.0-or-later mit cc-by-4.0 and or"]
    assert license_scan.scan("Licensed under CC BY-NC 4.0.")["labels"] == "cc-by,cc-by-nc" and license_scan.scan("plain")["score"] == 0
    assert license_scan.scan("all rights reserved")["score"] == 0


# ------------------------------------------------------------------------------------------ 13
def brute_codes(rows, entries=256):
    kept = [(d, v, y) for d, v, y in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    width = -(-max((len(v) for _, v, _ in kept), default=0) // 4) * 4
    x = np.array([[int(np.floor(1024 * c)) for c in v] + [0] * (width - len(v)) for _, v, _ in kept], np.int64).reshape(len(kept), 4, width // 4)
    order = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, np.array([int(np.floor(1024 * c)) for c in kept[k][1]], "<i4").tobytes()))
    books = x[order[:entries]].transpose(1, 0, 2).copy()
    for step in range(5):
        d = ((x[:, :, None, :] - books[None]) ** 2).sum(axis=3)
        code = d.argmin(axis=2)
        for p in range(4 if step < 4 else 0):
            for e in set(code[:, p].tolist()):
                books[p, e] = x[code[:, p] == e, p].sum(axis=0) // (code[:, p] == e).sum()
    error = d.min(axis=2).sum(axis=1)
    by_label = Counter()
    for (_, _, y), e in zip(kept, error.tolist(), strict=True):
        by_label[y] += e
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    return sorted(((d, bytes(c.astype(np.uint8)).hex(), e, by_label[y], digest) for (d, _, y), c, e in zip(kept, code, error.tolist(), strict=True)), key=str)


@pytest.mark.parametrize("n, entries", [(700, 256), (60, 256), (400, 20)])
def test_codes(spark, n, entries):
    from pyspark.sql import functions as F
    rnd = np.random.default_rng(n)
    x = np.round(rnd.normal(size=(n, 12)) * 0.02, 2).astype(np.float32)  # few distinct values: many ties
    rows = [(int(k), [float(c) for c in x[k]], int(k % 5) if k % 7 else None) for k in rnd.permutation(n)]
    rows += [(n, None, 1), (n + 1, [None] + [0.5] * 11, 1), (n + 2, [float("nan")] * 12, 2), (n + 3, [float("-inf")] + [0.0] * 11, 2), (n + 4, [], None),
             (n + 5, [0.5, -0.25, 1.0], 3), (None, rows[0][1], 2), rows[1], (2, [0.75] * 12, 9), (2, [-0.75] * 11, 9)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumns(
        {c: F.lit("own") for c in ("q", "l", "part", "entry", "place", "x", "n", "v", "dim", "code", "error", "total")})
    got = gnat_codes.compress(df.repartition(3), entries=entries)
    assert sorted(map(tuple, got.collect()), key=str) == brute_codes(rows, entries)
    assert gnat_codes.compress(df.filter("false")).collect() == []


@pytest.mark.parametrize("k, w, most", [(256, 16, 1000), (256, 2, 6), (40, 3, 5), (1, 4, 9), (64, 4, 1 << 28), (300, 1, 40), (30, 0, 3)])
def test_gnat_is_exact(k, w, most):
    rnd = np.random.default_rng(k)
    entries = rnd.integers(-most, most, (k, w))
    if k > 1:
        entries[k // 2:] = entries[:k - k // 2] if k % 3 == 0 else entries[k // 2:]
    queries = np.concatenate([rnd.integers(-most, most, (400, w)), entries, entries + rnd.integers(-1, 2, entries.shape)])
    tree = gnat_codes.Gnat(entries)
    index, d = tree.nearest(queries)
    every = ((queries[:, None, :] - entries[None]) ** 2).sum(axis=2)
    assert (index == every.argmin(axis=1)).all() and (d == every.min(axis=1)).all()
    if k > 200:
        assert tree.compared < 0.7 * every.size


def test_too_large_components_are_an_error(spark):
    df = spark.createDataFrame([(1, [1e30, 0.0], 0)], "vec_id long, embedding array<double>, label int")
    with pytest.raises(Exception, match="too large"):
        gnat_codes.compress(df).collect()
