"""Token operators (1, 6, 9, 10) against the libraries themselves, id by id."""

import hashlib
import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import tokenizers

from godown.llm import bfd_pack, byte_bpe, ordered_pack, pretok, token_counts

JSON, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    t = tokenizers.Tokenizer.from_file(JSON)
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def ranks():
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=pretok.read_ranks(RANKS), special_tokens={})
    return lambda text: enc.encode_ordinary(text or "")


def odd_texts(n: int = 4000) -> list[str]:
    rnd = random.Random(3)
    pools = [(32, 127), (9, 14), (0xA0, 0x250), (0x370, 0x600), (0x4E00, 0x4E50), (0x1F300, 0x1F650), (0, 0x3000),
             (0x10000, 0x20000), (0xE000, 0x110000), (0x2000, 0x2070)]
    parts = ["<|endoftext|>", " <|endoftext|> ", "  ", "'s", "'LL", "\n\n ", " the", ", ", ". ", ".\n", " a,b", "\x1e"]
    return ["".join(rnd.choice(parts) if rnd.random() < 0.3 else chr(rnd.randrange(*rnd.choice(pools)))
                    for _ in range(rnd.randint(0, 30))) for _ in range(n)]


def test_ids_of_odd_texts_are_the_libraries(library, ranks):
    texts = odd_texts()
    assert [x.tolist() for x in pretok.words_for(JSON).encode(texts)] == [library(t) for t in texts]
    assert [x.tolist() for x in pretok.words_for(RANKS).encode(texts)] == [ranks(t) for t in texts]
    one = pretok.ranks_for(JSON)
    assert [one(t).tolist() for t in texts] == [library(t) for t in texts]


def test_cache_may_start_anew(monkeypatch, library):
    monkeypatch.setattr(pretok, "CACHE_CHUNKS", 50)
    words = pretok.Words(pretok.tokenizer_json(JSON))
    texts = odd_texts(300)
    for k in range(0, 300, 10):
        assert [x.tolist() for x in words.encode(texts[k:k + 10])] == [library(t) for t in texts[k:k + 10]]


def test_pretokens_add_up(library):
    split = pretok.Splitter(pretok.special_tokens(JSON))
    for t in odd_texts(1500):
        words = split.split(t)
        assert "".join(words) == t
        assert [i for w in words for i in library(w)] == library(t)
        assert [w for c in split.chunks(t) for w in split.split(c)] == words


def test_token_counts(docs, no_docs, rows, library):
    got = token_counts.token_counts(docs, limit=200).collect()
    want = [(d, len((t or "").encode()), n := len(library(t)), n > 200) for d, t, *_ in rows]
    assert Counter(map(tuple, got)) == Counter(want)
    assert token_counts.token_counts(no_docs).collect() == []


def test_token_counts_across_blocks(docs, rows, library, monkeypatch):
    monkeypatch.setattr(token_counts, "BLOCK_DOCS", 5)
    batch = [([r[0] for r in rows], [r[1] for r in rows])]
    splitter, known = pretok.Splitter(pretok.special_tokens(JSON)), token_counts.known_words(JSON)
    blocks = [b for ids, texts in batch for b in token_counts._block(ids, texts, 0, splitter, known)]
    assert sum(b.num_rows for b in blocks) > 100
    words = [w for b in blocks for w in b.column(0).to_pylist()]
    assert sum(w == "\x000\0" for w in words) == 1 and all(w not in known for w in words)


@pytest.mark.parametrize("rows_a_batch", ["1", "10000", "200000"])
def test_token_counts_of_any_batch(spark, library, rows_a_batch):
    """More documents in one Arrow batch than a block numbers."""
    n = 70_000 if rows_a_batch == "200000" else 300
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows_a_batch)
    try:
        df = spark.range(n).selectExpr("id as doc_id", "concat('zqxjkw', ' vbnmqq', id % 3) as text").coalesce(1)
        got = token_counts.token_counts(df).groupBy("n_tokens").count().collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    want = {len(library(f"zqxjkw vbnmqq{k}")) for k in range(3)}
    assert {r.n_tokens for r in got} == want and sum(r["count"] for r in got) == n


def test_encode_and_decode(docs, no_docs, rows, ranks):
    enc = byte_bpe.encode(docs)
    table = byte_bpe.token_bytes(RANKS)
    by_ids = defaultdict(list)
    for r in enc.collect():
        by_ids[r.doc_id].append(r)
    for d, t, *_ in rows:
        t = t or ""
        ids = ranks(t)
        r = next(r for r in by_ids[d] if r.ids == ids)
        at = 0
        for i, a, z in zip(ids, r.starts, r.ends, strict=True):
            assert len(t[:a].encode()) <= at and len(t[:z].encode()) >= at + len(table[i])
            assert len(t[:a + 1].encode()) > at and len(t[:z - 1].encode()) < at + len(table[i])
            at += len(table[i])
        assert "".join(byte_bpe.token_texts(ids, table)) == t
        assert r.n_split_tokens == sum(a < z for a, z in zip(r.starts[1:], r.ends[:-1], strict=True))
    assert any(r.n_split_tokens for rs in by_ids.values() for r in rs)
    back = Counter((r.doc_id, bytes(r.decoded)) for r in byte_bpe.decode(enc).collect())
    assert back == Counter((d, (t or "").encode()) for d, t, *_ in rows)
    assert byte_bpe.decode(byte_bpe.encode(no_docs)).collect() == []


def test_decode_keeps_parts_of_characters(spark):
    ids = pretok.words_for(RANKS).encode(["\U0001f600"])[0].tolist()
    assert len(ids) > 1
    df = spark.createDataFrame([(1, ids[:1]), (2, ids[1:]), (3, None), (4, [])], "doc_id long, ids array<int>")
    got = {r.doc_id: bytes(r.decoded) for r in byte_bpe.decode(df).collect()}
    assert got[1] + got[2] == "\U0001f600".encode() and got[3] == got[4] == b""
    texts = byte_bpe.token_texts(ids, byte_bpe.token_bytes(RANKS))
    assert texts[:-1] == [""] * (len(ids) - 1) and texts[-1] == "\U0001f600"


def check_pieces(pieces, rows, library, end_id, capacity):
    """Every id lies in one piece, sequences have no gaps, and the CRCs are those of the ids. Returns sequences."""
    want = Counter()
    for d, t, *_ in rows:
        want[d, tuple(library(t) + [end_id])] += 1
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    for d in {d for d, _ in want}:
        copies = [ids for (x, ids), n in want.items() if x == d for _ in range(n)]
        total = Counter()
        for ids in copies:
            total[len(ids)] += len(ids)
        have = Counter()
        for p in by_doc[d]:
            have[p.doc_tokens] += p.length
            assert any(p.doc_tokens == len(ids) and p.ids_crc32 == zlib.crc32(np.array(ids[p.start:p.start + p.length], "<u4").tobytes())
                       for ids in copies)
        assert have == total
    for s in by_sequence.values():
        s.sort(key=lambda p: p.offset)
        assert [p.offset for p in s] == [0, *itertools.accumulate(p.length for p in s)][:-1]
        assert sum(p.length for p in s) <= capacity
    return by_sequence


def test_best_fit_decreasing_against_a_scan():
    rnd = random.Random(5)
    for _ in range(30):
        capacity = rnd.choice([7, 64, 100])
        sizes = [rnd.randint(1, capacity) for _ in range(rnd.randint(0, 120))]
        free: list[int] = []
        for n in sorted(sizes, reverse=True):
            fits = [f for f in free if f >= n and n < capacity]
            if fits:
                free[free.index(min(fits))] -= n
            else:
                free.append(capacity - n)
        got = bfd_pack.best_fit_decreasing(sizes, capacity)
        assert sorted(k for s in got for k in s) == list(range(len(sizes)))
        assert sorted(capacity - sum(sizes[k] for k in s) for s in got) == sorted(free)


def test_bfd_pack(docs, no_docs, rows, library, tmp_path):
    written = bfd_pack.write_packed(bfd_pack.pack_bfd(docs, capacity=256, block_tokens=20_000), str(tmp_path / "packed"))
    pieces = bfd_pack.unpack(written).collect()
    assert all(p.position_reset for p in pieces)
    sequences = check_pieces(pieces, rows, library, 50256, 256)
    fill = sum(p.length for p in pieces) / (256 * len(sequences))
    assert fill > 0.97
    for r in written.limit(5).collect():
        ids = np.frombuffer(r.input_ids, "<u2")
        assert len(ids) == 256 and (ids[r.n_tokens:] == 50256).all() and r.cu_seqlens[-1] == r.n_tokens
    assert bfd_pack.pack_bfd(no_docs).collect() == []


def brute_windows(position, penalty, capacity):
    best = [0] + [None] * (len(position) - 1)
    for j in range(1, len(position)):
        for i in range(j):
            n = position[j] - position[i]
            if n <= capacity:
                pad = 0 if n & (n - 1) == 0 else capacity - n
                cost = best[i] + pad + penalty[j] + ordered_pack.WINDOW_COST
                best[j] = cost if best[j] is None else min(best[j], cost)
    return best[-1]


def test_windows_cost_least():
    rnd = random.Random(11)
    for _ in range(200):
        capacity = rnd.choice([16, 32, 50])
        position = np.concatenate([[0], np.cumsum([rnd.randint(1, capacity if rnd.random() < 0.2 else 9) for _ in range(rnd.randint(1, 60))])])
        penalty = np.array([rnd.choice([0, 16, 256]) for _ in position])
        cuts = ordered_pack.cut_windows(position, penalty, capacity)
        cost = 0
        for i, j in itertools.pairwise(cuts):
            n = position[j] - position[i]
            assert n <= capacity
            cost += (0 if n & (n - 1) == 0 else capacity - n) + penalty[j] + ordered_pack.WINDOW_COST
        assert cost == brute_windows(position.tolist(), penalty.tolist(), capacity)


def test_ordered_pack(docs, no_docs, rows, library):
    from pyspark.sql import functions as F
    got = ordered_pack.pack_ordered(docs, capacity=256, block_tokens=8_000).withColumn("ids_crc32", F.crc32("ids")).collect()
    sequences = check_pieces(got, rows, library, 1, 256)
    size = [sum(p.length for p in s) for s in sequences.values()]
    padding = sum(256 - n for n in size if n & (n - 1))
    assert padding < 0.08 * sum(size)
    read = [r.doc_id for r in docs.select("doc_id").collect()]  # pieces follow the order of the rows
    order = [p.doc_id for p in sorted(got, key=lambda p: (p.sequence_id, p.offset))]
    assert [d for d, _ in itertools.groupby(order)] == [d for d, _ in itertools.groupby(read)]
    assert ordered_pack.pack_ordered(no_docs).collect() == []


def test_digest_columns_are_those_of_the_text(spark, ranks):
    import duckdb
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in byte_bpe.op6_byte_bpe(spark, sf).collect()}
    for d, t in duckdb.sql(f"select doc_id, text from '{sf}/documents.parquet'").fetchall():
        ids = ranks(t)
        assert got[d].n_tokens == len(ids) and got[d].n_chars == len(t or "")
        assert got[d].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[d].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def test_very_long_white_space_runs(spark, library):
    """Texts on which tiktoken's regex engine gives up have the ids of the tokenizers library, and cost no other row."""
    from pyspark.sql import functions as F
    prose = "Some words stand here, and end. " * 20
    rows = [(0, prose, "en", "s"), *[(k + 1, prose + c * 2_000_000 + prose, "en", "s") for k, c in enumerate(" \n")],
            (3, "<|endoftext|>" + " " * 1_100_000, "en", "s")]
    one = pretok.ranks_for(JSON)
    for _, t, *_ in rows:
        assert np.array_equal(one(t), library(t))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").coalesce(1)
    want = {d: ids for d, t, *_ in rows for ids in [library(t)]}
    packed = bfd_pack.unpack(bfd_pack.pack_bfd(docs))
    ordered = ordered_pack.pack_ordered(docs).withColumn("ids_crc32", F.crc32("ids"))
    for pieces, end_id in ((packed, 50256), (ordered, 1)):
        got = defaultdict(int)
        for p in pieces.collect():
            ids = [*want[p.doc_id], end_id]
            assert p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(np.array(ids[p.start:p.start + p.length], "<u4").tobytes())
            got[p.doc_id] += p.length
        assert got == {d: len(ids) + 1 for d, ids in want.items()}
