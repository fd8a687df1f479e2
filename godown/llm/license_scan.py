"""License scans (12): an Aho-Corasick automaton finds notice phrases and identifier tags, whose expressions are evaluated.

The words of a text (lower-cased, by the contract's word class) are joined by single blanks and pass the automaton once, so
a phrase is found whatever signs stand between its words. Where the words of an identifier tag are found, the expression
after it is read from the text itself and brought into postfix order by a shunting yard, with precedence with, and, or.

An expression's openness is evaluated on that order: `or` leaves the choice (the larger), `and` binds to both (the smaller),
`with` an exception lifts a licence to that of a weak copyleft at least. All statements of a document hold together.
"""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from godown.llm.pieces import PIECE, word_pieces

#: The phrases and labels that are counted as base places.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: Further notices and their labels.
NOTICES = {
    "gnu lesser general public license": "lgpl", "gnu library general public license": "lgpl", "gnu affero general public license": "agpl",
    "mozilla public license": "mpl", "eclipse public license": "epl", "boost software license": "bsl", "isc license": "isc",
    "bsd license": "bsd", "redistribution and use in source and binary forms": "bsd",
    "permission is hereby granted free of charge": "mit", "cc by nc": "cc-by-nc", "cc by nc sa": "cc-by-nc-sa", "cc by nc nd": "cc-by-nc-nd",
    "cc by nd": "cc-by-nd", "cc by sa": "cc-by-sa", "cc0": "cc0", "public domain": "public-domain", "all rights reserved": "all-rights-reserved"}
TAG = "spdx license identifier"
#: How freely a text may be used, by label; other labels count as UNKNOWN.
OPENNESS = {"public-domain": 1.0, "cc0": 1.0, "unlicense": 1.0, "mit": 0.9, "bsd": 0.9, "isc": 0.9, "bsl": 0.9, "apache": 0.9, "cc-by": 0.9,
            "mpl": 0.6, "epl": 0.6, "lgpl": 0.6, "cc-by-sa": 0.5, "gpl": 0.4, "agpl": 0.3, "cc-by-nd": 0.2, "cc-by-nc": 0.1, "cc-by-nc-sa": 0.1,
            "cc-by-nc-nd": 0.1, "all-rights-reserved": 0.0}
UNKNOWN, EXCEPTION = 0.2, 0.6
_PRECEDENCE = {"or": 1, "and": 2, "with": 3}
_SEPARATORS = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_TOKEN = re.compile(rb"[ \t]*([()]|[a-z0-9][a-z0-9.+:\-]*)")
_TAG_SIGNS = re.compile(rb"spdx-license-identifier[ \t]*:")
_VERSION = re.compile(r"-v?\d.*$|\+$")


def parse_expression(line: bytes, start: int = 0) -> list[str]:
    """The expression that begins at ``start``, in postfix order (shunting yard).

    It is read as far as it is one: a word where an operator should stand ends it, an operator without a right side is
    left out, an open bracket closes at the end. Nothing readable gives an empty list.
    """
    out: list[str] = []
    waiting: list[str] = []
    operand = True
    while m := _TOKEN.match(line, start):
        token = m[1].decode().rstrip(".")
        if operand:
            if token == "(":
                waiting.append(token)
            elif token == ")" or token in _PRECEDENCE or not token:
                break
            else:
                out.append(token)
                operand = False
        elif token in _PRECEDENCE:
            while waiting and waiting[-1] != "(" and _PRECEDENCE[waiting[-1]] >= _PRECEDENCE[token]:
                out.append(waiting.pop())
            waiting.append(token)
            operand = True
        elif token == ")" and "(" in waiting:
            while (top := waiting.pop()) != "(":
                out.append(top)
        else:
            break
        start = m.end()
    while operand and waiting and waiting.pop() == "(":
        pass
    return out + [t for t in reversed(waiting) if t != "("]


def label(identifier: str) -> str:
    """A licence's family: the identifier up to its version."""
    return _VERSION.sub("", identifier) or identifier


def evaluate(postfix: list[str]) -> tuple[float, set[str]]:
    """Openness of an expression, and the labels of its licences (exceptions are none)."""
    values: list[tuple[float, set[str]]] = []
    for t in postfix:
        if t not in _PRECEDENCE:
            values.append((OPENNESS.get(label(t), UNKNOWN), {label(t)}))
            continue
        (x, names), (y, more) = values[-2:]
        del values[-2:]
        values.append((max(x, EXCEPTION), names) if t == "with" else ((max if t == "or" else min)(x, y), names | more))
    return values[0]


@lru_cache(1)
def automaton() -> tuple[ahocorasick.Automaton, int]:
    """The automaton of all phrases between blanks, and the most words of one."""
    a = ahocorasick.Automaton()
    phrases = [*BASE, *NOTICES, TAG]
    for p in phrases:
        a.add_word(f" {p} ", p)
    a.make_automaton()
    return a, max(p.count(" ") + 1 for p in phrases)


def places(raw: bytes, size: int = PIECE) -> tuple[int, list[tuple[int, str]]]:
    """Number of words of a lower-cased text, and (first word, phrase) of all places of phrases."""
    found, longest = automaton()
    n, out = 0, []
    before: list[bytes] = []
    for words in word_pieces(raw, _SEPARATORS, size):
        first, carried = n - len(before), len(before)  # words of the piece before come again: a phrase may go on
        joined = (b" " + b" ".join(before + words) + b" ").decode("latin-1")
        word = at = 0
        for end, phrase in sorted((end, p) for end, p in found.iter(joined)) if words else ():
            start = end - len(phrase) - 1
            word += joined.count(" ", at, start) if start >= at else -joined.count(" ", start, at)
            at = start
            if word + phrase.count(" ") >= carried:  # else it was found before
                out.append((first + word, phrase))
        n += len(words)
        before = (before + words)[1 - longest:]
    return n, out


def scan(text: str | None, size: int = PIECE) -> dict:
    """All that the query returns of one text."""
    raw = (text or "").encode().lower()  # of bytes, that is A-Z alone
    n, found = places(raw, size)
    base = [(w, BASE[p]) for w, p in found if p in BASE]
    base_labels, expressions = {x for _, x in base}, []
    labels = base_labels | {NOTICES[p] for _, p in found if p in NOTICES}
    opens = [OPENNESS[x] for x in labels if x != "all-rights-reserved"]
    tags = {w for w, p in found if p == TAG}
    for k, m in enumerate(_WORD.finditer(raw) if tags else ()):
        if k in tags and (sign := _TAG_SIGNS.match(raw, m.start())) and (postfix := parse_expression(raw, sign.end())):
            value, names = evaluate(postfix)
            expressions.append(" ".join(postfix))
            opens.append(value)
            labels |= names
    return {"n_words": n, "n_base": len(base), "first_word": min((w for w, _ in base), default=None),
            "last_word": max((w for w, _ in base), default=None), "base_labels": ",".join(sorted(base_labels)),
            "labels": ",".join(sorted(labels)), "score": min(opens, default=0.0), "expressions": expressions}


_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
                     ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
                     ("expressions", pa.list_(pa.string()))])


def _scan(batches):
    for b in batches:
        rows = [{"doc_id": d} | scan(t.as_py()) for d, t in zip(b.column(0).to_pylist(), b.column(1), strict=True)]
        yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score and expressions (postfix), a row a row of ``docs``.

    ``score`` is the openness of all that a document states, by phrase or tag: 0 (none stated, or nothing allowed) to 1. "All
    rights reserved" alone gives 0 and next to a licence says nothing. A null or empty text has no words and no labels; a null
    id stays null; repeated rows each give a row; phrases that overlap each count; an empty table gives none. Only the two
    columns are read. No row moves between tasks.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_scan, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
                                  "labels string, score double, expressions array<string>")


def op12_license_scan(spark, sf_dir: str) -> DataFrame:
    return license_scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
