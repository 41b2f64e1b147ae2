"""Language identification by Bayesian fusion of evidence.

For each language the log-probability is the sum of

- the text's likelihood: letter trigrams, hashed, under counts of texts declared to be in that
  language, tempered since neighbouring trigrams are not independent;
- the declared markup language and the address suffix: how often documents whose text
  alone points to a language carry that declaration or suffix;
- the host's prior: counts of the same kind, smoothed towards the parent domain's, these
  towards those of all documents.

All but the trigram counts come from one grouped aggregation over all documents. Languages are the
values declared by at least ``LEAST`` documents of the whole table (in small tables by ``SHARE`` of them),
however rare among the others. Trigrams are counted on about ``sample`` documents of each language, drawn row by
row with a fixed seed. One more class, ``und``, stands for any
other language: every trigram is equally likely in it. :func:`of_pages` derives declaration, suffix, parent domain
and host of web pages.

A document is kept if it has a letter, and its best class is a language with a posterior
of at least ``floor``. Null or empty texts are evidence for nothing: their language is what
the rest says, and they are not kept. A null declaration, suffix or host adds nothing of its
own (null hosts form one group). Ties go to the language first in alphabetical order.
Repeated rows get equal results. Without any declared language all is ``und``.
"""

from __future__ import annotations

from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mainspool.llm.common import append, materialise, per_worker, without

BUCKETS = 1 << 15
#: Documents of each language whose trigrams are counted, about.
SAMPLE = 2500
#: Documents that make a declared value a language; in tables where that is more, a share of all declared ones.
LEAST, SHARE = 50, 0.005
TEMPER = 0.3
FLOOR = 0.6
UNKNOWN = "und"

#: Rows of evidence that are sent to all tasks at most.
EVIDENCE_ROWS = 20_000

#: Pseudo-counts: a trigram's, a declaration's, and the weight of the parent's prior.
TRIGRAM, DECLARED, PARENT = 0.5, 1.0, 20.0


def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(1 << 16)])


def trigrams(text: str | None, letter: np.ndarray) -> np.ndarray:
    """Hashed letter trigrams of a whole text; other characters count as one blank each."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
    points[~letter[np.minimum(points, 0xFFFF)]] = 32
    points = np.concatenate([[32], points, [32]])
    middle = points[1:-1] != 32
    key = (points[:-2] * 0x9E3779B1 + points[1:-1] * 0x85EBCA77 + points[2:] * 0xC2B2AE3D) & 0xFFFFFFFF
    return (key >> 13 ^ key)[middle] & (BUCKETS - 1)


@dataclass
class Model:
    languages: list[str]  # the last is UNKNOWN
    table: np.ndarray  # log-likelihood, a row each


def declared_code(column: Column) -> Column:
    """The primary subtag of a declared language; null for none."""
    code = F.lower(F.regexp_extract(column, r"^\s*([A-Za-z]{2,3})(?:[-_].*)?\s*$", 1))
    return F.when(code != "", code)


def of_pages(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``pages`` with ``host``, ``parent`` (its last two labels), ``suffix`` (the last) and ``declared``, the
    language that the page's first html element names; null where there is none. Addresses of numbers have a host only."""
    pages = without(pages, ["host", "parent", "suffix", "declared"])
    host = F.lower(F.regexp_extract(F.col(f"`{url}`"), r"^\s*[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    named = pages.withColumn("host", F.when(host != "", F.regexp_replace(host, r"\.+$", "")))
    domain = F.when(F.col("host").rlike(r"[a-z]$"), F.col("host"))
    shown = F.regexp_extract(F.col(f"`{html}`"), r"(?is)<html(?:\s[^>]*?)?\slang\s*=\s*[\"']?\s*([a-z][a-z0-9_-]*)", 1)
    return named.select(
        "*",
        F.when(domain.contains("."), F.substring_index(domain, ".", -2)).alias("parent"),
        F.substring_index(domain, ".", -1).alias("suffix"),
        F.when(shown != "", shown).alias("declared"),
    )


def train(docs: DataFrame, declared: str = "lang", text: str = "text", sample: int = SAMPLE) -> Model:
    rows = docs.select(F.col(f"`{text}`").alias("t"), declared_code(F.col(f"`{declared}`")).alias("lang")).where("lang is not null and t is not null")
    counts = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}  # a row per code
    least = min(LEAST, SHARE * sum(counts.values()))
    languages = sorted(x for x, n in counts.items() if n >= least)
    shares = docs.sparkSession.createDataFrame([(x, min(1.0, sample / counts[x])) for x in languages], "of string, share double")
    drawn = rows.withColumn("r", F.rand(7))  # not by text: a hot text would come whole
    rows = drawn.join(F.broadcast(shares), (F.col("lang") == F.col("of")) & (F.col("r") < F.col("share"))).select("t", "lang")

    def count(batches):
        letter = per_worker("letters", _letters)
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for t, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = sums.setdefault(lang, np.zeros(BUCKETS, np.int64))
                found += np.bincount(trigrams(t, letter), minlength=BUCKETS)
        for lang, found in sums.items():
            place = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(place), pa.string()), pa.array(place.astype(np.int32)), pa.array(found[place])],
                names=["lang", "place", "n"],
            )

    partial = materialise(rows.mapInArrow(count, "lang string, place int, n bigint").groupBy("lang", "place").agg(F.sum("n").alias("n")))
    table = np.full((len(languages) + 1, BUCKETS), -np.log(BUCKETS))
    for k, lang in enumerate(languages):  # a row of the table each: at most BUCKETS counts
        found = partial.where(F.col("lang") == lang).select("place", "n").toArrow()
        n = np.full(BUCKETS, TRIGRAM)
        n[found.column("place").to_numpy()] += found.column("n").to_numpy()
        table[k] = np.log(n / n.sum())
    return Model([*languages, UNKNOWN], table)


def score(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``__text``, tempered log-likelihoods by class, and ``__letters``, a count."""
    sent = docs.sparkSession.sparkContext.broadcast(model.table.T.copy())
    key = crc32(model.table.tobytes())
    classes = len(model.languages)

    def run(texts: pa.Array) -> list[pa.Array]:
        letter = per_worker("letters", _letters)
        table = per_worker(("language table", key), lambda: sent.value)
        found = [trigrams(t, letter) for t in texts.to_pylist()]
        sums = np.array([np.bincount(f, minlength=BUCKETS) @ table if len(f) > BUCKETS else table[f].sum(axis=0) for f in found]).reshape(len(found), classes)
        offsets = pa.array(np.arange(0, len(found) * classes + 1, classes, dtype=np.int32))
        return [pa.ListArray.from_arrays(offsets, pa.array(TEMPER * sums.ravel())), pa.array(np.array([len(f) for f in found], np.int64))]

    return append(docs, "__text array<double>, __letters bigint", run, text, keep=keep)


def _logs(counts: list[Column], weight: float, parent: list[Column]) -> list[Column]:
    total = sum(counts[1:], counts[0]) + weight
    return [F.log((n + weight * p) / total) for n, p in zip(counts, parent)]


def evidence(scored: DataFrame, model: Model, keys: list[str], rows: DataFrame | None = None) -> DataFrame:
    """``keys`` (declared, suffix, parent, host) with ``__prior``, log evidence by class, for each
    of their combinations in ``rows``, by default in the scored rows."""
    k = len(model.languages)
    best = F.array_position("__text", F.array_max("__text")) - 1
    cube = materialise(scored.where("__letters > 0").groupBy(*keys, best.alias("__class")).agg(F.count("*").alias("__n")))
    declared, suffix, parent, host = keys
    sums = [F.sum(F.when(F.col("__class") == i, F.col("__n")).otherwise(0)).cast("double") for i in range(k)]

    def counted(name: str, *by: str) -> DataFrame:
        return cube.groupBy(*by).agg(F.array(*sums).alias(name))

    every = cube.agg(*sums).first()
    every = [float(n or 0) for n in every]
    total = sum(every)
    base = [(n + 1.0) / (total + k) for n in every]
    out = (scored if rows is None else rows).select(*keys).distinct()
    n_suffix, n_declared = (max(1, cube.select(c).distinct().count()) for c in (suffix, declared))
    for name, by in (("__d", [declared]), ("__s", [suffix]), ("__p", [suffix, parent]), ("__h", [suffix, parent, host])):
        other = counted(name, *by).select(*(F.col(c).alias(f"__{c}") for c in by), name)
        on = [out[c].eqNullSafe(other[f"__{c}"]) for c in by]
        out = out.join(other, on, "left").drop(*(f"__{c}" for c in by))
        out = out.withColumn(name, F.coalesce(name, F.array(*[F.lit(0.0)] * k)))
    at = lambda name, i: F.col(name)[i]
    shown = []
    from_parent = [(at("__p", i) + PARENT * base[i]) / (sum((at("__p", j) for j in range(1, k)), at("__p", 0)) + PARENT) for i in range(k)]
    prior = _logs([at("__h", i) for i in range(k)], PARENT, from_parent)
    for i in range(k):
        of_declared = F.when(F.col(declared).isNull(), 0.0).otherwise(F.log((at("__d", i) + DECLARED) / (every[i] + DECLARED * (n_declared + 1))))
        of_suffix = F.when(F.col(suffix).isNull(), 0.0).otherwise(F.log((at("__s", i) + DECLARED) / (every[i] + DECLARED * (n_suffix + 1))))
        shown.append(prior[i] + of_declared + of_suffix)
    return out.select(*keys, F.array(*shown).alias("__prior"))


def identify(docs: DataFrame, declared: str = "lang", host: str = "source", suffix: str | None = None, parent: str | None = None, text: str = "text", keep: list[str] | None = None, sample: int = SAMPLE, floor: float = FLOOR) -> DataFrame:
    """``docs`` with ``language``, ``posterior``, ``text_language`` and ``kept``."""
    model = train(docs, declared, text, sample)
    keep = list(docs.columns if keep is None else keep)
    keys = ["__declared", "__suffix", "__parent", "__host"]
    text_of = lambda c: F.lit(None).cast("string") if c is None else F.col(f"`{c}`").cast("string")
    own = docs.select(*(F.col(f"`{c}`") for c in dict.fromkeys([*keep, text])), declared_code(F.col(f"`{declared}`")).alias(keys[0]), text_of(suffix).alias(keys[1]), text_of(parent).alias(keys[2]), text_of(host).alias(keys[3]))
    said = materialise(evidence(score(own, model, text, keep=keys), model, keys, own))
    said = said.select(*(F.col(c).alias(f"{c}2") for c in keys), "__prior")
    if said.count() <= EVIDENCE_ROWS:  # else joined by shuffle
        said = F.broadcast(said)
    scored = without(score(own, model, text, keep=[*keep, *keys]), ["language", "posterior", "text_language", "kept"])
    keep = [c for c in keep if c.lower() not in {"language", "posterior", "text_language", "kept"}]
    joined = scored.join(said, [scored[c].eqNullSafe(said[f"{c}2"]) for c in keys], "left")
    names = F.array(*map(F.lit, model.languages))
    total = F.zip_with("__text", "__prior", lambda a, b: a + b)
    joined = joined.withColumn("__all", total).withColumn("__top", F.array_max("__all"))
    posterior = 1 / F.aggregate("__all", F.lit(0.0), lambda s, x: s + F.exp(x - F.col("__top")))
    language = F.element_at(names, F.array_position("__all", F.col("__top")).cast("int"))
    by_text = F.element_at(names, F.array_position("__text", F.array_max("__text")).cast("int"))
    return joined.select(
        *(F.col(f"`{c}`") for c in keep),
        language.alias("language"),
        posterior.alias("posterior"),
        by_text.alias("text_language"),
        ((F.col("__letters") > 0) & (language != UNKNOWN) & (posterior >= floor)).alias("kept"),
    )
