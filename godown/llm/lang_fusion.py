"""Language identification by Bayesian evidence fusion (3).

log posterior(language) = log host prior + log P(declared markup language | language) + log P(address suffix | language)
+ text log likelihood. The text model (byte trigrams of lower-cased letters) is fitted on a bounded sample of labelled
rows. Everything else comes from all rows by grouped aggregation of their text posteriors: what is declared and which suffix
goes with which language, and host priors that are smoothed towards the host's domain, and that towards the whole.
A row's own share is taken out of its host's and domain's counts. Sums are of whole numbers, so they do not depend on
the order of rows. One more class, undetermined, has a uniform text model.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from godown.session import cut_lineage

LANGUAGES = ("de", "en", "es", "fr")
UNDETERMINED = "und"
#: Labelled rows at most on which the text model is fitted: those with the least hash of their id.
SAMPLE_ROWS = 4000
BUCKETS = 1 << 16
ALPHA = 0.5  # added to every trigram and evidence count
#: Trigrams overlap: each counts as a part of an observation, and a text as so many at most.
TEMPER, MOST_TRIGRAMS = 0.3, 1000
#: Rows' worth of weight that a domain's prior has in its hosts', and the whole's in a domain's.
STRENGTH = 5.0
LEAST_CONFIDENCE = 0.6
#: A text posterior counts as so many units.
UNIT = 1_000_000

_MARKUP = re.compile(r"(?is)<!--.*?-->|<(script|style|template|noscript)\b.*?</\1\s*>|<[^>]*>")
_LETTERS = bytes(c if chr(c).isalpha() and c < 128 or c >= 128 else 32 for c in range(256))
_MIX = np.uint32(0x9E3779B1)


def page_text(markup: str) -> str:
    """Text of a page: markup, comments and scripts removed, entities decoded."""
    return html.unescape(_MARKUP.sub(" ", markup))


def trigrams(text: str | None) -> np.ndarray:
    """Bucket numbers of the byte trigrams of a text; runs of anything but letters are one space."""
    raw = b" ".join((text or "").lower().encode().translate(_LETTERS).split())
    if not raw:
        return np.zeros(0, np.uint32)
    b = np.frombuffer(b" " + raw + b" ", np.uint8).astype(np.uint32)
    return ((b[:-2] << 16 | b[1:-1] << 8 | b[2:]) * _MIX) >> np.uint32(16)


def _counts(batches):
    totals: dict[str, np.ndarray] = {}
    for b in batches:
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            own = totals.setdefault(lang, np.zeros(BUCKETS, np.int64))
            own += np.bincount(trigrams(text), minlength=BUCKETS)
    for lang, own in totals.items():
        at = np.flatnonzero(own)
        yield pa.record_batch([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(own[at])],
                              names=["lang", "bucket", "n"])


def fit_text(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             languages: tuple[str, ...] = LANGUAGES, sample_rows: int = SAMPLE_ROWS) -> np.ndarray:
    """Log probabilities, one row a language and a last one for undetermined, of every bucket.

    Fitted on at most ``sample_rows`` whole rows of the given languages; what comes to the driver is a count per
    language and bucket. Without any labelled row all languages are alike, so none can win and every row is rejected.
    """
    rows = labelled.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).cast("string").alias("text"))
    rows = rows.filter(F.col("lang").isin(*languages) & F.col("id").isNotNull())
    some = rows.select("id").orderBy(F.xxhash64("id"), "id").limit(sample_rows).distinct()
    got = (rows.join(some, "id", "left_semi").select("lang", "text").mapInArrow(_counts, "lang string, bucket int, n long")
           .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow())
    counts = np.zeros((len(languages), BUCKETS))
    number = {x: k for k, x in enumerate(languages)}
    for lang, bucket, n in zip(*(got[c].to_pylist() for c in ("lang", "bucket", "n")), strict=True):
        counts[number[lang], bucket] = n
    p = (counts + ALPHA) / (counts.sum(axis=1, keepdims=True) + ALPHA * BUCKETS)
    return np.vstack([np.log(p), np.full((1, BUCKETS), -np.log(BUCKETS))])


def text_evidence(text: str | None, model: np.ndarray) -> np.ndarray:
    """Tempered log likelihood of each class; 0 for a text without letters."""
    t = trigrams(text)
    if not len(t):
        return np.zeros(len(model))
    return model[:, t].sum(axis=1) * (TEMPER * min(1.0, MOST_TRIGRAMS / len(t)))


def _score(model, markup: bool):
    def run(batches):
        for b in batches:
            out = []
            for text in b.column(0).to_pylist():
                out.append(text_evidence(page_text(text) if markup and text else text, model.value))
            ll = np.array(out).reshape(len(out), -1)
            p = np.exp(ll - ll.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            silent = np.array([not x.any() for x in out])
            p[silent] = 0  # no text: no say in what goes with which language
            flat = lambda x, t: pa.ListArray.from_arrays(
                pa.array(np.arange(len(out) + 1, dtype=np.int32) * ll.shape[1]), pa.array(x.ravel(), t))
            yield pa.record_batch([*b.columns[1:], flat(ll, pa.float64()), flat(np.rint(p * UNIT).astype(np.int64), pa.int64())],
                                  names=[*b.schema.names[1:], "ll", "q"])
    return run


def host_of(url: Column) -> Column:
    """Lower-case host name of an address without port and user, '' where there is none."""
    host = F.regexp_extract(F.lower(F.coalesce(url, F.lit(""))), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1)
    return F.regexp_replace(host, r"\.+$", "")


def declared_language(markup: Column) -> Column:
    """Primary language that the markup declares: lang or xml:lang of html, else a content-language; '' if none."""
    tag = F.regexp_extract(markup, r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?\s*([a-zA-Z]{2,3})\b", 1)
    meta = F.regexp_extract(markup, r"(?is)<meta\b[^>]*?content-language[^>]*?content\s*=\s*[\"']?\s*([a-zA-Z]{2,3})\b", 1)
    return F.lower(F.coalesce(F.when(tag != "", tag).otherwise(meta), F.lit("")))


def _totals(scored: DataFrame, key: str, n: int, name: str) -> DataFrame:
    """One array of class totals per key value."""
    return scored.groupBy(key).agg(F.array(*[F.sum(F.col("q")[k]) for k in range(n)]).alias(name))


def _total(name: str, n: int) -> Column:
    return sum((F.col(name)[k] for k in range(1, n)), F.col(name)[0])


def fuse(scored: DataFrame, languages: tuple[str, ...]) -> DataFrame:
    """Add lang and confidence to rows of declared, suffix, domain, host, ll (log likelihoods) and q (text posteriors)."""
    classes = [*languages, UNDETERMINED]
    n = len(classes)
    whole = scored.agg(F.array(*[F.coalesce(F.sum(F.col("q")[k]), F.lit(0)) for k in range(n)]).alias("all_q"))
    parts = {k: cut_lineage(_totals(scored, k, n, f"{k}_q")) for k in ("declared", "suffix")}
    out = scored.crossJoin(F.broadcast(whole))  # one row
    for k, t in parts.items():
        values = t.agg(F.count("*").alias(f"{k}_values"))
        out = out.join(t, k).crossJoin(F.broadcast(values))
    hosts = scored.groupBy("domain", "host").agg(F.array(*[F.sum(F.col("q")[k]) for k in range(n)]).alias("host_q"))
    out = out.join(_totals(scored, "domain", n, "domain_q"), "domain").join(hosts, ["domain", "host"])
    rest = {k: _total(k, n) - _total("q", n) for k in ("host_q", "domain_q")}
    posts = []
    for c in range(n):
        q = {k: F.col(k)[c] - F.col("q")[c] for k in ("host_q", "domain_q")}
        p_all = (F.col("all_q")[c] + ALPHA * UNIT) / (_total("all_q", n) + ALPHA * UNIT * n)
        p_domain = (q["domain_q"] + STRENGTH * UNIT * p_all) / (rest["domain_q"] + STRENGTH * UNIT)
        p_host = (q["host_q"] + STRENGTH * UNIT * p_domain) / (rest["host_q"] + STRENGTH * UNIT)
        post = F.log(p_host) + F.col("ll")[c]
        for k in parts:
            post = post + F.log((F.col(f"{k}_q")[c] + ALPHA * UNIT) / (F.col("all_q")[c] + ALPHA * UNIT * F.col(f"{k}_values")))
        posts.append(post)
    out = out.withColumn("post", F.array(*posts)).withColumn("best", F.array_max("post"))
    total = sum((F.exp(F.col("post")[k] - F.col("best")) for k in range(1, n)), F.exp(F.col("post")[0] - F.col("best")))
    lang = F.array(*[F.lit(c) for c in classes])[F.array_position("post", F.col("best")).cast("int") - 1]
    return out.withColumn("lang", lang).withColumn("confidence", F.lit(1.0) / total)


def identify(rows: DataFrame, model: np.ndarray, keep: list[str], text: str, declared: Column, suffix: Column, domain: Column,
             host: Column, markup: bool, languages: tuple[str, ...] = LANGUAGES,
             least_confidence: float = LEAST_CONFIDENCE) -> DataFrame:
    """``keep``, lang, confidence, declared, has_text and rejected, one row per input row.

    Null evidence counts as the value ''. A row is rejected where it has no letters, the undetermined class wins or the
    winner's posterior is under ``least_confidence``. Ties go to the first language. Repeated rows get the same verdict.
    """
    shared = rows.sparkSession.sparkContext.broadcast(model)
    blank = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    some = rows.select(F.col(text).cast("string").alias("_words"), *[F.col(c) for c in keep], blank(declared).alias("declared"),
                       blank(suffix).alias("suffix"), blank(domain).alias("domain"), blank(host).alias("host"))
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in some.drop("_words").schema)
    scored = cut_lineage(some.mapInArrow(_score(shared, markup), f"{types}, ll array<double>, q array<long>"))
    out = fuse(scored, languages).withColumn("has_text", F.exists("ll", lambda x: x != 0))
    bad = ~F.col("has_text") | (F.col("lang") == UNDETERMINED) | (F.col("confidence") < least_confidence)
    return out.select(*keep, "lang", "confidence", "declared", "has_text", bad.alias("rejected"))


def identify_pages(pages: DataFrame, labelled: DataFrame, languages: tuple[str, ...] = LANGUAGES,
                   sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """page_id, lang, confidence, declared, has_text, rejected of raw pages (page_id, url, html).

    A null page has no text and declares nothing; a null address has the host ''. Other columns are not read.
    """
    model = fit_text(labelled, languages=languages, sample_rows=sample_rows)
    host = host_of(F.col("url"))
    rows = pages.select("page_id", "html", declared_language(F.coalesce("html", F.lit(""))).alias("_declared"), host.alias("_host"))
    suffix = F.regexp_extract("_host", r"\.([a-z0-9-]+)$", 1)
    domain = F.regexp_extract("_host", r"([^.]+\.[^.]+)$", 1)
    return identify(rows, model, ["page_id"], "html", F.col("_declared"), suffix, domain, F.col("_host"), True, languages)


def keep_identified(docs: DataFrame, languages: tuple[str, ...] = LANGUAGES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, lang, source, ...) that language identification does not reject.

    The column lang is what is declared, and the source is the host. The verdict depends on text, lang and source
    alone, so rejected rows are recognised by their id and a hash of these.
    """
    model = fit_text(docs, languages=languages, sample_rows=sample_rows)
    key = F.xxhash64(docs["text"], docs["lang"], docs["source"])
    none = F.lit("")
    rows = docs.select("doc_id", docs["text"].alias("_text"), docs["lang"].alias("_lang"), docs["source"].alias("_source"), key.alias("_key"))
    got = identify(rows, model, ["doc_id", "_key"], "_text", F.col("_lang"), none, none, F.col("_source"), False, languages)
    gone = cut_lineage(got.filter("rejected").select(F.col("doc_id").alias("_gone_id"), F.col("_key").alias("_gone_key")).distinct())
    return docs.join(gone, key.eqNullSafe(gone["_gone_key"]) & docs["doc_id"].eqNullSafe(gone["_gone_id"]), "left_anti")


def op3_language_fusion(spark, sf_dir: str) -> DataFrame:
    return identify_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"), spark.read.parquet(f"{sf_dir}/documents.parquet"))
