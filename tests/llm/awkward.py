"""Test documents with every awkward case."""

import random

#: Names that the operators use inside; as extra columns of an input they must not clash.
EXTRA = ["id", "word", "row", "base", "grp", "token", "n", "pos", "comp", "rep", "bin", "d2", "a", "b", "ll", "q", "post",
         "_row", "_key", "_kept", "_rank_in_component", "i", "h", "r", "k", "parts", "linked", "scale", "m0", "vec", "raw", "dim", "cell", "record", "turn_", "hash", "host"]


def sentence(rnd: random.Random, n: int, stem: str = "wo") -> str:
    words = [stem + "".join(rnd.choice("aeioubcdfglmnrst") for _ in range(rnd.randint(1, 7))) for _ in range(n)]
    return " ".join(words).capitalize() + "."


def text(rnd: random.Random, n: int) -> str:
    out = []
    while n > 0:
        k = min(n, rnd.randint(5, 15))
        out.append(sentence(rnd, k))
        n -= k
    return "\n".join(" ".join(out[i:i + 6]) for i in range(0, len(out), 6))


def corpus() -> list[tuple]:
    """(doc_id, text, lang, source): ordinary texts, copies, near copies, and every awkward case."""
    rnd = random.Random(7)
    rows = [(k, text(rnd, rnd.randint(60, 300)), "en", f"src{k % 2}") for k in range(40)]
    rows += [(100 + k, rows[k][1], "en", "src0") for k in range(3)]  # equal texts
    for k in range(6):  # near copies of one text
        words = rows[5][1].split(" ")
        words[20 + 3 * k] = "changed"
        rows.append((200 + k, " ".join(words), "en", "src1"))
    rows.append((300, rows[7][1] + " " + text(rnd, 20), "en", "src1"))
    rows += [rows[0], rows[9]]  # repeated rows
    rows += [(400, None, "en", "src0"), (401, "", None, "src0"), (402, " \n\t ", "de", None), (403, "Four words are here", "en", "src0"),
             (404, "four WORDS are here", "en", "src1"), (405, "one", None, None), (None, rows[3][1], "en", "src0"), (None, None, None, None),
             (406, "x" * 30_000, "en", "src0"), (407, text(rnd, 12_000), "en", "src0"), (408, "é 中文 \U0001f600 <|endoftext|> ß͸ don't  stop\r\n\n", "fr", "src0"),
             (409, " a  b  \n c\x1ed. e, f.", "es", "src0"), (410, "## $$ %% " * 60, "en", "src0"), (411, "again and again " * 70, "en", "src0")]
    return rows
