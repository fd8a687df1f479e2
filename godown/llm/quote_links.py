"""Quotation linking (8): nested quotes parsed, hashed, joined to the messages they quote, and taken out.

Lines that begin with '>' are quotes; the number of '>' is the level. A passage is a run of lines of one level. Passages,
and what messages say themselves, are normalised (case, white space) and hashed whole, by paragraph and by line. A quoted
hash is joined to the latest earlier message of the conversation that says it, by a running window over (conversation,
hash), so a line that is said any number of times costs a row each and no pairs. The source of a passage is the message
that most of its characters are found in. A passage without a source in its conversation is looked up, whole, in all others,
by minima over the hash. What has a source is taken out of the text; what has none stays. A message replies to the source of
its outermost linked quote; threads are followed to their first message by pointer doubling. No conversation is gathered
into one row or task.
"""

from __future__ import annotations

import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from godown.operators.prefix import ordered_prefix_sums
from godown.session import cut_lineage

_QUOTE = re.compile(r"^\s{0,3}((?:>\s?)+)(.*)$")
#: Lines that introduce a quote ("On ... X wrote:") in the corpus languages.
_INTRODUCES = re.compile(r"(?i)(wrote|writes|schrieb|schreibt|a écrit|écrit|escribió|escribe)\b[^:]{0,80}:\s*$")
#: Whole passages count this many times their characters, so an exact quote beats scattered lines.
WHOLE = 4
#: Characters of a normalised passage from which it is looked up in other conversations; shorter ones are said anywhere.
LEAST_AFAR = 20


def normalise(text: str) -> str:
    return " ".join(text.casefold().split())


def _hash(text: str) -> int:
    return int.from_bytes(xxhash.xxh3_64_digest(text.encode()), "big", signed=True)


def segments(text: str | None) -> tuple[list[tuple[int | None, str]], list[tuple[int, list[str]]]]:
    """The text in parts, each the message's own (None) or of a quoted passage with the line that introduces it; and the
    passages as (level, lines) in order. The parts joined by line ends are the text."""
    parts: list[tuple[int | None, list[str]]] = []
    passages: list[tuple[int, list[str]]] = []
    for line in (text or "").split("\n"):
        m = _QUOTE.match(line)
        if not m:
            if not parts or parts[-1][0] is not None:
                parts.append((None, []))
            parts[-1][1].append(line)
            continue
        level = m[1].count(">")
        if parts and parts[-1][0] is not None and passages[-1][0] == level:
            passages[-1][1].append(m[2])
            parts[-1][1].append(line)
            continue
        intro: list[str] = []
        if parts and parts[-1][0] is None:
            own = parts[-1][1]
            said = next((k for k in range(len(own) - 1, -1, -1) if own[k].strip()), None)
            if said is not None and len(own) - said <= 2 and _INTRODUCES.search(own[said]):
                intro = own[said:]
                del own[said:]
                if not own:
                    parts.pop()
        passages.append((level, [m[2]]))
        parts.append((len(passages) - 1, [*intro, line]))
    return [(k, "\n".join(lines)) for k, lines in parts], passages


def without(parts: list[tuple[int | None, str]], linked) -> str:
    """The text without the passages in ``linked``; as it is if none is."""
    kept = "\n".join(t for k, t in parts if k not in linked)
    return re.sub(r"\n{3,}", "\n\n", kept).strip("\n") if any(k in linked for k, _ in parts) else kept


def parse(text: str | None) -> tuple[str, list[tuple[int, list[str]]]]:
    """What the message says itself, and its quoted passages as (level, lines) in order."""
    parts, passages = segments(text)
    return without(parts, set(range(len(passages)))), passages


def units(lines: list[str]) -> dict[str, int]:
    """Normalised whole, paragraphs and lines of a text, each with its weight."""
    out = {p: len(p) for line in lines if (p := normalise(line))}
    out |= {p: len(p) for para in re.split(r"\n\s*\n", "\n".join(lines)) if (p := normalise(para))}
    if whole := normalise("\n".join(lines)):
        out[whole] = WHOLE * len(whole)
    return out


UNIT = pa.list_(pa.struct([("passage", pa.int32()), ("level", pa.int32()), ("hash", pa.int64()), ("weight", pa.int64()), ("far", pa.bool_())]))
PART = pa.list_(pa.struct([("passage", pa.int32()), ("text", pa.string())]))


def _parsed(batches):
    for b in batches:
        texts, quotes, said = [], [], []
        for t in b.column(b.num_columns - 1):
            parts, passages = segments(t.as_py())
            texts.append([{"passage": k, "text": x} for k, x in parts])
            quotes.append([{"passage": k, "level": level, "hash": _hash(u), "weight": w, "far": w >= WHOLE * max(LEAST_AFAR, len(u))}
                           for k, (level, lines) in enumerate(passages) for u, w in units(lines).items()])
            own = without(parts, set(range(len(passages))))
            said.append([_hash(u) for u in units(own.split("\n"))])
        yield pa.record_batch([*b.columns[:-1], pa.array(texts, PART), pa.array(quotes, UNIT),
                               pa.array(said, pa.list_(pa.int64()))], names=[*b.schema.names[:-1], "parts", "quotes", "own"])


def _sources(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, passage, level, source): the earlier message each passage was taken from, where there is one."""
    asked = messages.select("conv_id", "turn", F.explode("quotes").alias("x")).select(
        "conv_id", "turn", F.col("x.passage").alias("passage"), F.col("x.level").alias("level"), F.col("x.hash").alias("hash"),
        F.col("x.weight").alias("weight"), F.lit(None).cast("long").alias("said"))
    # Only hashes that are quoted somewhere can be sources.
    said = (messages.select("conv_id", "turn", F.explode("own").alias("hash"))
            .join(asked.select("conv_id", "hash").distinct(), ["conv_id", "hash"], "left_semi").distinct()
            .select("conv_id", "turn", F.lit(None).cast("int").alias("passage"), F.lit(None).cast("int").alias("level"), "hash",
                    F.lit(None).cast("long").alias("weight"), F.col("turn").alias("said")))
    earlier = Window.partitionBy("conv_id", "hash").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    found = asked.unionByName(said).withColumn("source", F.last("said", True).over(earlier)).filter(
        "passage is not null and source is not null")
    each = found.groupBy("conv_id", "turn", "passage", "level", "source").agg(F.sum("weight").alias("w"))
    return each.groupBy("conv_id", "turn", "passage", "level").agg(F.max(F.struct("w", "source")).alias("m")).select(
        "conv_id", "turn", "passage", "level", F.col("m.source").alias("source"))


def _far_sources(messages: DataFrame, near: DataFrame) -> DataFrame:
    """(conv_id, turn, passage, far_conv, far_turn): of passages without a source in ``near``, the least message of another
    conversation that says the whole passage. Minima only: a passage said by any number of messages is two rows."""
    asked = (messages.select("conv_id", "turn", F.explode("quotes").alias("x")).filter("x.far")
             .select("conv_id", "turn", F.col("x.passage").alias("passage"), F.col("x.hash").alias("hash")).distinct()
             .join(near.select("conv_id", "turn", "passage"), ["conv_id", "turn", "passage"], "left_anti"))
    said = (messages.select("conv_id", "turn", F.explode("own").alias("hash")).join(asked.select("hash").distinct(), "hash", "left_semi")
            .groupBy("hash", "conv_id").agg(F.min("turn").alias("turn")))
    least = said.groupBy("hash").agg(F.min(F.struct("conv_id", "turn")).alias("least"))
    other = (said.join(least, "hash").filter(F.col("conv_id") != F.col("least.conv_id"))
             .groupBy("hash").agg(F.min(F.struct("conv_id", "turn")).alias("other")))
    source = F.when(F.col("least.conv_id") != F.col("conv_id"), F.col("least")).otherwise(F.col("other"))
    return (asked.join(least.join(other, "hash", "left"), "hash").withColumn("source", source).filter("source is not null")
            .select("conv_id", "turn", "passage", F.col("source.conv_id").alias("far_conv"), F.col("source.turn").alias("far_turn")))


def _roots(parents: DataFrame) -> DataFrame:
    """(conv_id, turn, root): first message of the thread, by doubling the pointers until none moves."""
    now = cut_lineage(parents.select("conv_id", "turn", F.col("parent").alias("root")))
    while True:
        up = now.select("conv_id", F.col("turn").alias("root"), F.col("root").alias("further"))
        step = cut_lineage(now.join(up, ["conv_id", "root"], "left")
                           .select("conv_id", "turn", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        now = step.drop("moved")
        if not step.filter("moved").limit(1).count():
            return now


def link_quotes(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text") -> DataFrame:
    """One row per message: conv_id, turn, role, said (the text without the quotes that have a source and the lines that
    introduce them), parent (turn that it replies to, null if it quotes nothing known of its conversation), root (first turn of
    its thread), position (place in the conversation by thread and turn, from 1), n_quotes, n_linked, max_level, far_conv and
    far_turn (the message of another conversation that its first passage without a source here was taken from, where
    there is one) and chat (the formatted message).

    A text without linked quotes is returned as it is; null is empty. Messages with a null conversation or turn link with
    nothing; their conversation null is ordered like any other, null turns last. Of repeated rows each is returned; they share
    links. Quotes of later messages or of none that is known stay in the text and link nothing. Other columns are not read.
    """
    rows = messages.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                           F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text"))
    rows = cut_lineage(rows.mapInArrow(_parsed, "conv_id long, turn long, role string, parts array<struct<passage: int, text: string>>, "
                                       "quotes array<struct<passage: int, level: int, hash: long, weight: long, far: boolean>>, own array<long>"))
    usable = rows.filter("conv_id is not null and turn is not null")
    sources = cut_lineage(_sources(usable))
    parents = cut_lineage(sources.groupBy("conv_id", "turn").agg(F.min(F.struct("level", F.col("passage"), "source")).alias("m"))
                          .select("conv_id", "turn", F.col("m.source").alias("parent")))
    found = sources.select("conv_id", "turn", "passage", F.lit(None).cast("long").alias("far_conv"), F.lit(None).cast("long").alias("far_turn"))
    links = found.unionByName(_far_sources(usable, sources)).groupBy("conv_id", "turn").agg(
        F.collect_set("passage").alias("linked"),  # passages of one message
        F.min(F.when(F.col("far_conv").isNotNull(), F.struct("passage", "far_conv", "far_turn"))).alias("far"))
    known = links.join(parents.join(_roots(parents), ["conv_id", "turn"]), ["conv_id", "turn"], "left")
    level = F.array_max(F.transform("quotes", lambda x: x["level"]))
    stays = F.filter("parts", lambda x: x["passage"].isNull() | ~F.array_contains("linked", x["passage"]))
    kept = F.regexp_replace(F.array_join(F.transform(stays, lambda x: x["text"]), "\n"), "\n{3,}", "\n\n")
    said = F.when(F.col("linked").isNull(), F.array_join(F.transform("parts", lambda x: x["text"]), "\n")).otherwise(
        F.regexp_replace(kept, r"\A\n+|\n+\z", ""))
    out = (rows.join(known, ["conv_id", "turn"], "left")
           .select("conv_id", "turn", "role", said.alias("said"), "parent", F.coalesce("root", "turn").alias("root"),
                   F.size(F.array_distinct(F.transform("quotes", lambda x: x["passage"]))).cast("long").alias("n_quotes"),
                   F.coalesce(F.size("linked"), F.lit(0)).cast("long").alias("n_linked"), F.coalesce(level, F.lit(0)).cast("long").alias("max_level"),
                   F.col("far.far_conv").alias("far_conv"), F.col("far.far_turn").alias("far_turn")))
    order = [F.col("conv_id").asc_nulls_last(), F.col("root").asc_nulls_last(), F.col("turn").asc_nulls_last(),
             F.col("role").asc_nulls_last(), F.xxhash64("said").asc()]
    placed = cut_lineage(ordered_prefix_sums(out, order, {"place": F.lit(1)}))
    first = placed.groupBy("conv_id").agg(F.min("place").alias("first")).withColumnRenamed("conv_id", "_conv")
    chat = F.concat(F.lit("<|"), F.coalesce("role", F.lit("unknown")), F.lit("|>\n"), F.trim("said"), F.lit("\n"))
    return (placed.join(first, F.col("conv_id").eqNullSafe(F.col("_conv")))
            .select("conv_id", "turn", "role", "said", "parent", "root", (F.col("place") - F.col("first") + 1).cast("long").alias("position"),
                    "n_quotes", "n_linked", "max_level", "far_conv", "far_turn", chat.alias("chat")))


def op8_quote_links(spark, sf_dir: str) -> DataFrame:
    return link_quotes(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
