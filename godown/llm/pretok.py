"""Byte-level BPE ids, one library call per distinct piece of text.

The libraries do the splitting, the byte mapping and the merges; what is kept here per worker is their answer for
each distinct piece, so the rest of the corpus costs one dictionary lookup a word.
"""

from __future__ import annotations

import base64
import json
import os
import re
import sys
import unicodedata
from array import array
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex

PATTERN = public_tokenizers.PATTERN
#: Distinct chunks kept per worker; beyond it the cache starts anew (a bound on memory, not on results).
CACHE_CHUNKS = 500_000


@lru_cache(1)
def _unassigned() -> re.Pattern:
    ranges, start = [], None
    for c in range(0x80, sys.maxunicode + 2):
        gone = c <= sys.maxunicode and unicodedata.category(chr(c)) == "Cn"
        if gone and start is None:
            start = c
        elif not gone and start is not None:
            ranges.append(f"\\U{start:08x}-\\U{c - 1:08x}")
            start = None
    return re.compile("[" + "".join(ranges) + "]")


def byte_chars() -> list[str]:
    """The printable character that stands for each byte in byte-level BPE files.

    Printable Latin-1 bytes stand for themselves; the others take code points from 256 on, in order.
    """
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return [chr(b) if b in set(own) else chr(256 + rest.index(b)) for b in range(256)]


def tokenizer_json(path: str) -> str:
    """A tokenizers JSON for a vocabulary file: .json as it is, .tiktoken ranks with their merges worked out.

    Rank files hold no merges; the merge that makes a token is the last pair left when the token's own bytes
    are merged by the lower ranks alone, which is the only pair that can ever make it. Tokens that no merge
    makes are still found whole (``ignore_merges``), as the rank library looks a whole pre-token up first.
    """
    if path.endswith(".json"):
        with open(path, encoding="utf-8") as f:
            return f.read()
    ranks = read_ranks(path)
    chars = byte_chars()
    mapped = {t: "".join(chars[b] for b in t) for t in ranks}
    merges = []
    for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
        if len(token) > 1 and (pair := _last_pair(ranks, token, rank)):
            merges.append([mapped[pair[0]], mapped[pair[1]]])
    return json.dumps({
        "version": "1.0", "truncation": None, "padding": None, "added_tokens": [], "normalizer": None,
        "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": False, "use_regex": True},
        "post_processor": None, "decoder": None,
        "model": {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None,
                  "end_of_word_suffix": None, "fuse_unk": False, "byte_fallback": False, "ignore_merges": True,
                  "vocab": {mapped[t]: r for t, r in ranks.items()}, "merges": merges}})


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def _last_pair(ranks: dict[bytes, int], token: bytes, rank: int) -> tuple[bytes, bytes] | None:
    parts = [token[i:i + 1] for i in range(len(token))]
    while len(parts) > 2:
        best, at = rank, -1
        for i in range(len(parts) - 1):
            r = ranks.get(parts[i] + parts[i + 1], rank)
            if r < best:
                best, at = r, i
        if at < 0:
            return None
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return (parts[0], parts[1]) if len(parts) == 2 else None


def special_tokens(path: str) -> dict[str, int]:
    """Strings that the library's default encodes to one id wherever they stand in a text."""
    if not path.endswith(".json"):
        return {}
    with open(path, encoding="utf-8") as f:
        return {x["content"]: x["id"] for x in json.load(f)["added_tokens"]}


#: A chunk is a space and what follows up to the next space or line end. Where every space and line end is followed
#: by a visible character, cuts before them always fall between pre-tokens, so a chunk has the same pre-tokens and ids
#: wherever it stands. So do cuts between a Latin letter and a stop or comma that ends a chunk. Texts that hold a special
#: string are not cut into chunks, as white space before it is taken together.
ODD = re.compile(r"[ \n](?:\s|\Z)").search
CHUNKS = re.compile(r"\n| ?[^ \n]+").findall
_CUT = "\x1e"
_ARROW_ODD = r"[ \n](?:[\s\x0b\x1c-\x1f\x{85}\p{Z}]|\z)|" + _CUT
_ARROW_STOP = r"([A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{ff}])([.,][ \n])"


class Words:
    """Ids by the tokenizers library with one library call per distinct chunk; build it once per Python worker.

    Arrow cuts and numbers the chunks of a batch; texts that chunks cannot cut go to the library whole.
    """

    def __init__(self, spec: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(spec)
        specials = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self._odd = "|".join([_ARROW_ODD, *specials])
        self.cache: dict[str, bytes] = {"": b""}
        self.again: set[str] = set()

    def _library(self, parts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for i in range(0, len(parts), 4096)
                for e in self.tokenizer.encode_batch_fast(parts[i:i + 4096], add_special_tokens=False)]

    def _ids(self, chunks: list[str]) -> list[bytes]:
        """Ids of distinct chunks, from the cache or the library. When it is full, what was met again is kept."""
        cache = self.cache
        missing = [c for c in chunks if c not in cache]
        got = dict(zip(missing, self._library(missing), strict=True))
        out = [cache[c] if c in cache else got[c] for c in chunks]
        self.again.update(c for c in chunks if c in cache)
        if len(cache) + len(got) > CACHE_CHUNKS:
            keep = self.again if len(self.again) < CACHE_CHUNKS // 2 else ()
            self.cache, self.again = {"": b""} | {c: cache[c] for c in keep}, set()
        self.cache.update(got)
        return out

    def encode_array(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids): the ids of all texts one after the other; null counts as empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        odd = pc.match_substring_regex(texts, self._odd)
        plain = pc.if_else(odd, "", texts)
        cut = pc.replace_substring_regex(plain, _ARROW_STOP, f"\\1{_CUT}\\2")
        cut = pc.replace_substring(pc.replace_substring(cut, " ", f"{_CUT} "), "\n", f"{_CUT}\n{_CUT}")
        lists = pc.split_pattern(cut, _CUT)
        chunks = lists.flatten().dictionary_encode()
        each = self._ids(chunks.dictionary.to_pylist())
        flat = np.frombuffer(b"".join(each), np.uint32)
        size = np.fromiter(map(len, each), np.int32, len(each)) // 4
        start = np.cumsum(size, dtype=np.int32) - size
        number = chunks.indices.to_numpy()
        length = size[number]
        ends = np.concatenate([[0], np.cumsum(length, dtype=np.int32)])
        at = np.repeat(start[number] - ends[:-1], length)
        at += np.arange(ends[-1], dtype=np.int32)
        ids = flat[at]
        offsets = ends[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
        at = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        if len(at):
            whole = [np.frombuffer(x, np.uint32) for x in self._library([texts[int(k)].as_py() for k in at])]
            ids = np.insert(ids, np.repeat(offsets[at], [len(x) for x in whole]), np.concatenate(whole))
            more = np.zeros(len(offsets), np.int64)
            more[at + 1] = [len(x) for x in whole]
            offsets = offsets + np.cumsum(more)
        return offsets, ids

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text as an unsigned 32-bit array."""
        offsets, ids = self.encode_array(pa.array(texts, pa.large_string()))
        return np.split(ids, offsets[1:-1]) if texts else []


class Splitter:
    """The pre-tokens of a text as the library's pattern cuts them, special strings as themselves.

    ``regex`` knows newer Unicode tables than the library. Characters that this Python calls unassigned are
    the only ones on which they can differ; texts that hold one are split by the library itself.
    """

    def __init__(self, specials: dict[str, int]):
        from tokenizers import Regex, pre_tokenizers
        self.specials = specials
        self._special = re.compile("(" + "|".join(map(re.escape, specials)) + ")") if specials else None
        self._fast = regex.compile(PATTERN).findall
        self._slow = pre_tokenizers.Split(Regex(PATTERN), "isolated")

    def _segment(self, text: str) -> list[str]:
        if len(text) != len(text.encode("latin-1", "ignore")) and _unassigned().search(text):
            return [w for w, _ in self._slow.pre_tokenize_str(text)]
        return self._fast(text)

    def chunks(self, text: str) -> list[str]:
        """Pieces that ``split`` cuts further, each in the same way wherever it stands."""
        odd = ODD(text) or self._special is not None and self._special.search(text)
        return self.split(text) if odd else CHUNKS(text)

    def split(self, text: str) -> list[str]:
        if self._special is None or not self._special.search(text):
            return self._segment(text)
        out: list[str] = []
        for k, part in enumerate(self._special.split(text)):
            if k % 2:
                out.append(part)
            elif part:
                out += self._segment(part)
        return out


def rank_encoder(path: str):
    """A text -> unsigned 32-bit ids function by the tiktoken library, several times as fast as tokenizers.

    For a .json file this holds only where merges are listed in the order of the ids they make (checked), as
    then merging by rank and by list are the same; special strings keep the ids that tokenizers gives them.
    Other files go through ``Words``, and so do texts on which tiktoken gives up: its regex engine raises an error
    at about a million white-space characters in a row.
    """
    import tiktoken
    specials: dict[str, int] = {}
    if path.endswith(".json"):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        specials = {x["content"]: x["id"] for x in spec["added_tokens"]}
        vocab, pre = spec["model"]["vocab"], spec["pre_tokenizer"]
        made = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in spec["model"]["merges"]]
        plain = (spec["normalizer"] is None and pre == {"type": "ByteLevel", "add_prefix_space": False,
                                                         "trim_offsets": True, "use_regex": True}
                 and not any(x[k] for x in spec["added_tokens"] for k in ("lstrip", "rstrip", "single_word")))
        if not plain or made != sorted(made):
            encode = words_for(path).encode
            return lambda text: encode([text])[0]
        byte_of = {c: b for b, c in enumerate(byte_chars())}
        ranks = {bytes(byte_of[c] for c in t): i for t, i in vocab.items() if t not in specials}
    else:
        ranks = read_ranks(path)
    enc = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=specials)
    allowed = set(specials)

    def encode_one(text: str) -> np.ndarray:
        try:
            ids = enc.encode_to_numpy(text, allowed_special=allowed, disallowed_special=())
        except ValueError:
            ids = words_for(path).encode([text])[0]
        return ids.astype(np.uint32, copy=False)

    return encode_one


@lru_cache(4)
def ranks_for(path: str):
    """The worker's own ``rank_encoder``."""
    return rank_encoder(path)


@lru_cache(4)
def words_for(path: str) -> Words:
    """The worker's own ``Words`` for a vocabulary file, read where the worker runs."""
    return Words(tokenizer_json(path))


def text_batches(values: list, limit: int = 4_000_000):
    """Ranges of rows whose texts sum to about ``limit`` characters (one longer text alone)."""
    start, size = 0, 0
    for i, v in enumerate(values):
        n = len(v) if v else 0
        if i > start and size + n > limit:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(values):
        yield start, len(values)
