"""Robust multivariate quality rules (2): minimum-covariance-determinant estimates per language and source.

DataFrame functions only. Each text becomes a vector of four transformed statistics. Per group the estimate is the
covariance of least determinant over the ``share`` nearest rows, sought from several starts: the medians and quartile
ranges (from fixed-width histograms), and rows drawn by hash, each with those ranges and with the least scales. A
concentration step takes distances, the rows up to the ``share`` nearest, and their mean and covariance; after two steps
the best starts go on until no determinant falls any more, and the least one stays. A step is one grouped aggregation by
(group, start, distance bin) for all groups and starts, so a group of any size is pre-aggregated before the shuffle and no row
is moved to its group. Statistics are kept as scaled whole numbers, which makes every sum exact and the verdict
independent of the order of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from godown.session import cut_lineage

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: The transformed statistics: log mean word length, and square roots of the share of symbols in word characters,
#: of repeated lines and of words in repeated windows.
DIMS = ("t_length", "t_symbols", "t_lines", "t_repeats")
#: Least scale of each statistic, added to the estimated covariance: log word length varies by some hundredths between
#: ordinary texts, prose holds next to no symbols, and a refrain or a repeated heading is no fault. Without it a group
#: whose nearer rows are all 0 in one statistic would have a singular estimate and reject any row that is not. The
#: distance is at most the sum of (deviation / floor)^2, so each floor has to let its statistic pass ``CUTOFF`` alone:
#: where nobody else repeats anything, from 74 % repeated lines or 42 % words in repeated windows on.
FLOORS = (0.08, 0.032, 0.20, 0.15)
#: Whole-number units per 1.0 of a statistic, and histogram bins per floor.
UNIT, FINE = 100_000, 8
MIN_GROUP = 100
#: Share of a group's rows whose covariance is least; junk of up to nearly the rest cannot carry the estimate.
SHARE = 0.55
#: Rows drawn as starts, steps of all starts, starts that go on, and at most so many further steps while the logarithm of a
#: determinant falls by more than the last figure.
DRAWN, FIRST_STEPS, GO_ON, MOST_STEPS, FALL = 3, 2, 2, 20, 1e-3
#: Squared distance beyond which a vector is rejected (chi-square with 4 degrees of freedom, quantile 0.999).
CUTOFF = 18.467
CHI2_MEDIAN = 3.3567
#: Distance bins: 32 to a unit of the logarithm of 1 + squared distance.
BINS = 32


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once a row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeat_words(words: Column) -> Column:
    """Words that lie in a 3-word window which the text holds twice or more. Windows are equal by 64-bit hash."""
    def covered(windows: Column) -> Column:
        ranked = F.sort_array(F.transform(windows, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        twice = _let(ranked, lambda s: F.filter(s, lambda p, i: F.coalesce(
            (F.get(s, i + 1)["h"] == p["h"]), F.lit(False)) | F.coalesce(F.get(s, i - 1)["h"] == p["h"], F.lit(False))))
        places = F.sort_array(F.transform(twice, lambda p: p["i"]))
        return _let(places, lambda s: F.aggregate(
            F.transform(s, lambda p, i: F.least(F.lit(3), F.get(s, i + 1) - p)), F.lit(0), lambda a, x: a + x))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    windows = _let(hashes, lambda h: F.transform(
        F.slice(h, 1, F.greatest(F.size(h) - 2, F.lit(0))),
        lambda x, i: F.xxhash64(x, F.get(h, i + 1), F.get(h, i + 2))))
    return _let(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(covered(w)))


def statistics(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
               prefix: str = "") -> DataFrame:
    """All columns of ``docs`` and the counts, transformed statistics and group key, named with ``prefix``."""
    p = prefix
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    words = F.regexp_extract_all(F.col(f"{p}text"), F.lit(WORD), F.lit(0))
    lines = F.filter(F.split(F.col(f"{p}text"), "\n"), lambda x: x.rlike(WORD))
    out = (docs.withColumn(f"{p}text", text)
           .withColumn(f"{p}words", words).withColumn(f"{p}lines", lines)
           .withColumns({
               f"{p}n_words": F.size(f"{p}words").cast("long"),
               f"{p}word_chars": F.length(F.translate(f"{p}text", SPACES, "")).cast("long"),
               f"{p}n_symbols": (F.length(f"{p}text") - F.length(F.translate(f"{p}text", SYMBOLS, ""))).cast("long"),
               f"{p}n_lines": F.size(f"{p}lines").cast("long"),
               f"{p}n_dup_lines": (F.size(f"{p}lines") - F.size(F.array_distinct(f"{p}lines"))).cast("long"),
               f"{p}n_repeat_words": _repeat_words(F.col(f"{p}words")).cast("long")})
           .drop(f"{p}text", f"{p}words", f"{p}lines"))
    n, c = F.col(f"{p}n_words"), lambda k: F.col(f"{p}{k}")
    whole = lambda x: F.round(x * UNIT).cast("long")
    ok = n > 0
    share = lambda a, b: F.sqrt(c(a) / F.greatest(b, F.lit(1)))
    return (out.withColumn(f"{p}base_failed", (n < MIN_WORDS) | (100 * c("n_repeat_words") > MAX_REPEAT_PERCENT * n))
            .withColumns({
                f"{p}t_length": whole(F.when(ok, F.log(F.greatest(c("word_chars"), F.lit(1)) / F.greatest(n, F.lit(1)))).otherwise(0.0)),
                f"{p}t_symbols": whole(share("n_symbols", c("word_chars"))),
                f"{p}t_lines": whole(share("n_dup_lines", c("n_lines"))),
                f"{p}t_repeats": whole(share("n_repeat_words", n)),
                f"{p}lang_key": F.coalesce(F.col(lang_col).cast("string"), F.lit("\x00")),
                f"{p}source_key": F.coalesce(F.col(source_col).cast("string"), F.lit("\x00"))}))


def _assign(rows: DataFrame, groups: DataFrame, prefix: str = "") -> DataFrame:
    """Add ``grp``: the row's language and source, or the pool of its language's or of all small groups."""
    keys = [f"{prefix}lang_key", f"{prefix}source_key"]
    g = groups.select(F.col("lang_key").alias(keys[0]), F.col("source_key").alias(keys[1]), F.col("grp").alias(f"{prefix}grp"))
    return rows.join(g, keys, "left")


def _groups(stats: DataFrame, min_group: int) -> DataFrame:
    """Every language and source with the group whose estimate serves it."""
    n = stats.groupBy("lang_key", "source_key").agg(F.sum(F.when(F.col("base_failed"), 0).otherwise(1)).alias("n"))
    small = F.col("n") < min_group
    pool = n.filter(small).groupBy("lang_key").agg(F.sum("n").alias("pooled"))
    return n.join(pool, "lang_key", "left").select(
        "lang_key", "source_key",
        F.when(~small, F.concat_ws("\x01", F.lit("s"), "lang_key", "source_key"))
        .when(F.col("pooled") >= min_group, F.concat_ws("\x01", F.lit("l"), "lang_key")).otherwise(F.lit("all")).alias("grp"))


def _start(rows: DataFrame) -> DataFrame:
    """Per group and start: a centre (the medians, or a row drawn by hash) and scales (quartile ranges from histograms of
    fixed bin width, or the floors)."""
    width = [int(f * UNIT / FINE) for f in FLOORS]
    bins = rows.select("grp", F.explode(F.array(*[
        F.struct(F.lit(k).alias("dim"), F.floor(F.col(d) / width[k]).alias("bin")) for k, d in enumerate(DIMS)])).alias("b"))
    counts = bins.groupBy("grp", "b.dim", "b.bin").count()
    w = Window.partitionBy("grp", "dim")
    cum = counts.select("grp", "dim", "bin", F.sum("count").over(w.orderBy("bin")).alias("upto"),
                        F.sum("count").over(w).alias("n"))
    quantile = lambda q: F.min(F.when(F.col("upto") >= q * F.col("n"), F.col("bin")))
    q = cum.groupBy("grp", "dim").agg(quantile(0.25).alias("q1"), quantile(0.5).alias("q2"), quantile(0.75).alias("q3"))
    each = []
    for k in range(len(DIMS)):
        here = F.col("dim") == k
        scale = F.greatest((F.col("q3") - F.col("q1")) * width[k] / 1.349, F.lit(FLOORS[k] * UNIT))
        each += [F.max(F.when(here, (F.col("q2") + 0.5) * width[k])).alias(f"m{k}"), F.max(F.when(here, scale)).alias(f"l{k}{k}")]
    drawn = rows.groupBy("grp").agg(*[F.min_by(F.struct(*DIMS), F.xxhash64(F.lit(k), *DIMS)).alias(f"drawn{k}") for k in range(DRAWN)])

    def start(no: int, row: str | None, ranges: bool) -> Column:
        p = range(len(DIMS))
        centre = [(F.col(f"{row}.{d}") if row else F.col(f"m{i}")).cast("double").alias(f"m{i}") for i, d in enumerate(DIMS)]
        scale = [(F.col(f"l{i}{i}") if ranges else F.lit(FLOORS[i] * UNIT)).cast("double").alias(f"l{i}{i}") for i in p]
        zero = [F.lit(0.0).alias(f"l{i}{j}") for i in p for j in range(i)]
        return F.struct(F.lit(no).alias("start"), *centre, *scale, *zero)

    starts = [start(0, None, True)] + [start(1 + 2 * k + r, f"drawn{k}", bool(r)) for k in range(DRAWN) for r in (0, 1)]
    return q.groupBy("grp").agg(*each).join(drawn, "grp").select("grp", F.explode(F.array(*starts)).alias("s")).select("grp", "s.*")


def _distance(prefix: str = "") -> Column:
    """Squared Mahalanobis distance by forward substitution in the group's Cholesky factor (columns m*, l**)."""
    z: list[Column] = []
    for i, d in enumerate(DIMS):
        r = F.col(f"{prefix}{d}") - F.col(f"m{i}")
        for j in range(i):
            r = r - F.col(f"l{i}{j}") * z[j]
        z.append(r / F.col(f"l{i}{i}"))
    return sum((x * x for x in z[1:]), z[0] * z[0])


def _binned(rows: DataFrame, params: DataFrame) -> DataFrame:
    return rows.join(params, "grp").withColumn("d2", _distance()).withColumn(
        "bin", F.least(F.floor(F.log1p("d2") * BINS), F.lit(4000)))


def _step(rows: DataFrame, params: DataFrame, share: float) -> DataFrame:
    """One concentration step of every group and start: mean and covariance of the rows up to the ``share`` nearest (whole
    bins), and the logarithm of the determinant."""
    p = range(len(DIMS))
    exact = lambda c: F.sum(c.cast("decimal(20,0)"))
    sums = {f"s{i}": exact(F.col(DIMS[i])) for i in p} | {
        f"s{i}{j}": exact(F.col(DIMS[i]) * F.col(DIMS[j])) for i in p for j in p if j <= i}
    by_bin = _binned(rows, params).groupBy("grp", "start", "bin").agg(F.count("*").alias("n"), *[c.alias(k) for k, c in sums.items()])
    w = Window.partitionBy("grp", "start")
    near = by_bin.select("*", F.sum("n").over(w.orderBy("bin")).alias("upto"), F.sum("n").over(w).alias("total")).filter(
        F.col("upto") - F.col("n") < F.ceil(share * F.col("total")))
    t = near.groupBy("grp", "start").agg(F.sum("n").alias("n"), *[F.sum(k).cast("double").alias(k) for k in sums])
    t = t.select("grp", "start", "n", *[(F.col(f"s{i}") / F.col("n")).alias(f"m{i}") for i in p], *[F.col(k) for k in sums if len(k) == 3])
    cov = {(i, j): F.col(f"s{i}{j}") / F.col("n") - F.col(f"m{i}") * F.col(f"m{j}") + F.lit((FLOORS[i] * UNIT) ** 2 if i == j else 0.0)
           for i in p for j in p if j <= i}
    t = t.select("grp", "start", *[f"m{i}" for i in p], *[c.alias(f"c{i}{j}") for (i, j), c in cov.items()])
    for i in p:  # Cholesky, one column after the other
        for j in range(i + 1):
            r = F.col(f"c{i}{j}")
            for k in range(j):
                r = r - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            t = t.withColumn(f"l{i}{j}", F.sqrt(F.greatest(r, F.lit(1.0))) if i == j else r / F.col(f"l{j}{j}"))
    logdet = sum((2 * F.log(f"l{i}{i}") for i in p), F.lit(0.0))
    return t.withColumn("logdet", logdet).drop(*[f"c{i}{j}" for i, j in cov])


def _least(params: DataFrame, n: int) -> DataFrame:
    """The ``n`` starts of each group with the least determinants."""
    w = Window.partitionBy("grp").orderBy("logdet", "start")  # a row a start
    return params.withColumn("_no", F.row_number().over(w)).filter(F.col("_no") <= n).drop("_no")


def _estimate(rows: DataFrame, share: float) -> DataFrame:
    """Centre and Cholesky factor of the least determinant found, a row a group (with ``logdet``)."""
    params = cut_lineage(_start(rows))
    for _ in range(FIRST_STEPS):
        params = cut_lineage(_step(rows, params, share))
    params = cut_lineage(_least(params, GO_ON))
    for _ in range(MOST_STEPS):
        # whole bins can let a determinant rise; then the lesser one stays, and its next step is the same again
        both = params.unionByName(_step(rows, params, share).withColumn("start", -1 - F.col("start")))
        names = [c for c in params.columns if c not in ("grp", "start")]
        pair = both.groupBy("grp", F.greatest("start", -1 - F.col("start")).alias("no")).agg(
            F.min_by(F.struct(*names), "logdet").alias("s"), F.max(F.when(F.col("start") >= 0, F.col("logdet"))).alias("was"))
        step = cut_lineage(pair.select("grp", F.col("no").alias("start"), "s.*", "was"))
        fall = step.agg(F.max(F.col("was") - F.col("logdet"))).first()[0]
        params = step.drop("was")
        if fall is None or fall <= FALL:
            break
    return _least(params, 1)


def fit(stats: DataFrame, share: float = SHARE, min_group: int = MIN_GROUP) -> tuple[DataFrame, DataFrame]:
    """(groups, parameters) of the rows that pass the base rules; small written tables, one row a group.

    A language and source with fewer than ``min_group`` such rows shares the estimate of its language's small
    sources, or of all the small ones. Scales are widened where a group's median distance exceeds that of a normal law.
    """
    groups = cut_lineage(_groups(stats, min_group))
    rows = _assign(stats.filter(~F.col("base_failed")).select("lang_key", "source_key", *DIMS), groups)
    params = cut_lineage(_estimate(rows, share).drop("start", "logdet"))
    counts = _binned(rows, params).groupBy("grp", "bin").count()
    w = Window.partitionBy("grp")
    cum = counts.select("grp", "bin", F.sum("count").over(w.orderBy("bin")).alias("upto"), F.sum("count").over(w).alias("n"))
    middle = cum.groupBy("grp").agg(F.min(F.when(F.col("upto") * 2 >= F.col("n"), F.col("bin"))).alias("bin"))
    scale = F.greatest(F.expm1((F.col("bin") + 0.5) / BINS) / CHI2_MEDIAN, F.lit(1.0)).alias("scale")
    return groups, cut_lineage(params.join(middle.select("grp", scale), "grp"))


def judge(stats: DataFrame, groups: DataFrame, params: DataFrame, prefix: str = "", cutoff: float = CUTOFF) -> DataFrame:
    """Add ``distance`` (squared, null where the base rules fail) and ``kept``, named with ``prefix``."""
    g = params.withColumnRenamed("grp", f"{prefix}grp")
    failed = F.col(f"{prefix}base_failed")
    out = _assign(stats, groups, prefix).join(g, f"{prefix}grp", "left")
    d = F.when(~failed, _distance(prefix) / F.col("scale"))
    return out.withColumn(f"{prefix}distance", d).withColumn(
        f"{prefix}kept", ~failed & F.coalesce(F.col(f"{prefix}distance") <= cutoff, F.lit(True)))


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
            source_col: str = "source", share: float = SHARE, min_group: int = MIN_GROUP, cutoff: float = CUTOFF) -> DataFrame:
    """One row per input row: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    kept and distance.

    A null or empty text has no words and fails the base rules. Null languages and sources are groups like any
    other. Rows that tie in distance get the same verdict, repeated rows each give a row, an empty table none.
    Only the four named columns are read.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("doc_text"), F.col(lang_col).alias("doc_lang"),
                       F.col(source_col).alias("doc_source"))
    stats = cut_lineage(statistics(rows, "doc_text", "doc_lang", "doc_source").drop("doc_text", "doc_lang", "doc_source"))
    return judge(stats, *fit(stats, share, min_group=min_group), cutoff=cutoff).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance")


def quality_filter(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """The rows of ``docs`` that ``quality`` keeps, with their own columns.

    Statistics are computed again for the verdict, in place of a join of texts to verdicts.
    """
    p = "_quality_"
    few = ["lang_key", "source_key", "base_failed", *DIMS]
    stats = statistics(docs.select(F.col(text_col).alias("doc_text"), F.col(lang_col).alias("doc_lang"),
                                   F.col(source_col).alias("doc_source")), "doc_text", "doc_lang", "doc_source")
    groups, params = fit(cut_lineage(stats.select(*few)))
    renamed = params.select(*[F.col(c) for c in params.columns])
    full = statistics(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(f"`{text_col}`").alias(f"{p}t"),
                                  F.col(f"`{lang_col}`").alias(f"{p}l"), F.col(f"`{source_col}`").alias(f"{p}s")),
                      f"{p}t", f"{p}l", f"{p}s", p)
    return judge(full, groups, renamed, p).filter(f"{p}kept").select("_row.*")


def op2_mcd_quality(spark, sf_dir: str) -> DataFrame:
    return quality(spark.read.parquet(f"{sf_dir}/documents.parquet"))
