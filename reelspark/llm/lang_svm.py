"""Language identification by hierarchical discrimination.

A linear model first tells the language families apart; within the predicted family, linear support vector machines,
one for each pair of its languages, vote. Features are shares of hashed byte trigrams of the lower-cased text, so a
whole text is scored by looking up one weight per trigram and taking the mean."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import HASH_SPACE, materialize, remainder

BITS = 14
#: More languages than this are refused; it bounds the number of machines.
MOST_LANGUAGES = 200
#: Family of a language; one that is missing here is a family of its own.
FAMILIES = {
    **dict.fromkeys(("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "fy", "lb"), "germanic"),
    **dict.fromkeys(("fr", "es", "it", "pt", "ro", "ca", "gl", "oc"), "romance"),
    **dict.fromkeys(("ru", "uk", "be", "pl", "cs", "sk", "bg", "sr", "hr", "sl", "mk", "bs"), "slavic"),
    **dict.fromkeys(("fi", "et", "hu"), "uralic"), **dict.fromkeys(("tr", "az", "kk", "uz"), "turkic"),
    **dict.fromkeys(("hi", "ur", "bn", "mr", "ne", "fa"), "indo-iranian"), **dict.fromkeys(("ar", "he"), "semitic"),
}
OUT = "doc_id long, held_out boolean, lang_pred string, score double"
_LETTER = regex.compile(r"\p{L}")


@dataclass(frozen=True)
class LangParams:
    modulus: int = 5
    held_out: int = 0
    per_language: int = 1_000
    sample_rows: int = 20_000
    epochs: int = 30
    cost: float = 10.0


@dataclass(frozen=True)
class LangModel:
    """weights: one column per classifier, the last row is the bias. First a column per family (one against the rest),
    then one per pair of languages within a family."""

    families: list[str]
    members: dict[str, list[str]]
    pairs: list[tuple[str, str]]
    weights: np.ndarray


def codes(text: bytes) -> np.ndarray:
    """Buckets of the byte trigrams of a text."""
    a = np.frombuffer(text, dtype=np.uint8).astype(np.uint32)
    x = a[:-2] | a[1:-1] << np.uint32(8) | a[2:] << np.uint32(16)
    return (x * np.uint32(2654435761)) >> np.uint32(32 - BITS)


def histogram(text: bytes, piece: int = 1 << 20) -> np.ndarray:
    """How often each bucket occurs in a text; long texts go piece by piece."""
    out = np.zeros(1 << BITS, dtype=np.int64)
    padded = b" " + text + b" "
    for at in range(0, len(padded) - 2, piece):
        out += np.bincount(codes(padded[at : at + piece + 2]), minlength=1 << BITS)
    return out


def _lower(text: str | None) -> bytes:
    return (text or "").lower().encode("utf-8", "replace")


def _hinge(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, width: int, p: LangParams) -> np.ndarray:
    """Linear SVM (squared hinge) over sparse rows by dual coordinate descent. The last place is the bias; both classes
    weigh alike."""
    n = len(y)
    cost = np.where(y > 0, n / (2 * max((y > 0).sum(), 1)), n / (2 * max((y < 0).sum(), 1))) * p.cost
    w, a = np.zeros(width + 1), np.zeros(n)
    q = np.array([v @ v + 1 for _, v in rows]) + 1 / (2 * cost)
    order, active = np.random.default_rng(7), np.ones(n, dtype=bool)
    for _ in range(p.epochs):
        most = 0.0
        for i in order.permutation(np.flatnonzero(active)):
            k, v = rows[i]
            g = y[i] * (v @ w[k] + w[-1]) - 1 + a[i] / (2 * cost[i])
            step = max(a[i] - g / q[i], 0.0) - a[i]
            if step:
                most = max(most, abs(step))
                a[i] += step
                w[k] += step * y[i] * v
                w[-1] += step * y[i]
            elif a[i] == 0:
                active[i] = False  # well on its side: left alone until the others have settled
        if most < 1e-4:
            if active.all():
                break
            active[:] = True
    return w


def fit(rows: list[tuple[str, np.ndarray, np.ndarray]], p: LangParams = LangParams()) -> LangModel:
    """rows: language, buckets, their shares. Without rows the model knows no language and predicts ``und``."""
    langs = sorted({r[0] for r in rows})
    members: dict[str, list[str]] = {}
    for lang in langs:
        members.setdefault(FAMILIES.get(lang, lang), []).append(lang)
    families = sorted(members)
    pairs = [pair for f in families for pair in combinations(members[f], 2)]
    scale = float(np.sqrt(np.mean([v @ v for _, _, v in rows]))) if rows else 1.0
    x = [(k, v.astype(np.float64) / scale) for _, k, v in rows]
    lang = np.array([r[0] for r in rows])
    family = np.array([FAMILIES.get(v, v) for v in lang])
    weights = np.zeros(((1 << BITS) + 1, len(families) + len(pairs)))

    def put(column: int, chosen: np.ndarray, good: np.ndarray) -> None:
        at = np.flatnonzero(chosen)
        w = _hinge([x[i] for i in at], np.where(good[at], 1.0, -1.0), 1 << BITS, p)
        weights[:-1, column], weights[-1, column] = w[:-1] / scale, w[-1]

    if len(families) > 1:
        for j, f in enumerate(families[:1] if len(families) == 2 else families):
            put(j, np.ones(len(rows), dtype=bool), family == f)
        if len(families) == 2:  # one against the other is the same machine
            weights[:, 1] = -weights[:, 0]
    for j, (a, b) in enumerate(pairs, len(families)):
        put(j, (lang == a) | (lang == b), lang == a)
    return LangModel(families, members, pairs, weights)


def margins(texts: list[str | None], model: LangModel) -> np.ndarray:
    """Mean weight of the trigrams of each text plus the bias, for every classifier."""
    out = np.empty((len(texts), model.weights.shape[1]))
    w = np.ascontiguousarray(model.weights[:-1])
    for i, t in enumerate(texts):
        n = histogram(_lower(t))
        out[i] = n @ w / max(n.sum(), 1)
    return out + model.weights[-1]


def decide(texts: list[str | None], model: LangModel) -> tuple[list[str], list[float]]:
    """A learned language and how sure it is, by the narrowest margin on its way; ``und`` and 0 without a letter. Of families
    with equal margins the first wins; of languages with as many votes that of the larger sum of margins, then the last by
    name."""
    m = margins(texts, model)
    where = {pair: j for j, pair in enumerate(model.pairs, len(model.families))}
    names, scores = [], []
    for t, row in zip(texts, m):
        if not model.families or not t or not _LETTER.search(t):
            names.append("und")
            scores.append(0.0)
            continue
        heads = row[: len(model.families)]
        best = int(np.argmax(heads))
        sure = (heads[best] - np.delete(heads, best).max()) / 2 if len(heads) > 1 else np.inf
        family = model.members[model.families[best]]
        votes = {lang: [0, 0.0] for lang in family}
        for a, b in combinations(family, 2):
            v = row[where[a, b]]
            votes[a if v > 0 else b][0] += 1
            votes[a][1] += v
            votes[b][1] -= v
        won = max(family, key=lambda k: (*votes[k], k))
        if len(family) > 1:
            sure = min(sure, min(row[where[p]] * (1 if p[0] == won else -1) for p in combinations(family, 2) if won in p))
        names.append(won)
        scores.append(float(1 / (1 + np.exp(-np.clip(2 * sure, -50, 50)))))
    return names, scores


def _features(batches):
    for batch in batches:
        ks, vs = [], []
        for t in batch.column("_text").to_pylist():
            n = histogram(_lower(t))
            k = np.flatnonzero(n)
            ks.append(k.astype(np.uint16).tobytes())
            vs.append((n[k] / max(n.sum(), 1)).astype(np.float32).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("_lang"), pa.array(ks, pa.binary()), pa.array(vs, pa.binary())], ["id", "lang", "k", "v"])


def training_rows(docs: DataFrame, p: LangParams = LangParams()) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """(language, buckets, shares) of the learned documents, one for each sampled id and language: of several texts of one
    id that of the smallest features counts, so that repeated rows neither take the place of others nor exceed the bound."""
    usable = docs.select(F.col("doc_id").alias("_id"), F.col("lang").alias("_lang")).where("_id is not null and _lang is not null").where(remainder(F.col("_id"), p.modulus) != p.held_out)
    # one row for each language; only the fraction hangs on the estimate, with a margin of 20 %
    counts = usable.groupBy("_lang").agg(F.approx_count_distinct("_id", 0.02).alias("n"))
    counts = materialize(counts, "languages")
    if (n := counts.count()) > MOST_LANGUAGES:
        raise ValueError(f"{n} languages are too many; at most {MOST_LANGUAGES} can be learned")
    most = max(1, min(p.per_language, p.sample_rows // max(n, 1)))
    place = F.pmod(F.xxhash64("_id"), F.lit(HASH_SPACE))
    share = F.when(F.col("n") > most, 1.2 * most / F.col("n") + 1e-4).otherwise(1.0)
    few = usable.join(F.broadcast(counts), "_lang").where(place < F.lit(HASH_SPACE) * share).groupBy("_lang", "_id").agg(F.lit(1).alias("_one"))
    rank = F.row_number().over(Window.partitionBy("_lang").orderBy(place, "_id"))
    chosen = few.withColumn("_rank", rank).where(F.col("_rank") <= most).select("_id", "_lang")
    texts = docs.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text"), F.col("lang").alias("_lang")).where(F.col("_text").rlike(r"\p{L}"))
    read = texts.join(F.broadcast(chosen), ["_id", "_lang"]).select(F.col("_id").cast("string").alias("_id"), "_text", "_lang").mapInArrow(_features, "id string, lang string, k binary, v binary")
    rows = read.groupBy("id", "lang").agg(F.min(F.struct("k", "v")).alias("x")).collect()
    rows.sort(key=lambda r: (r["lang"], bytes(r["x"]["k"]), bytes(r["x"]["v"])))
    return [(r["lang"], np.frombuffer(r["x"]["k"], np.uint16).astype(np.int32), np.frombuffer(r["x"]["v"], np.float32)) for r in rows]


def train(docs: DataFrame, p: LangParams = LangParams()) -> LangModel:
    """Learns from documents that aren't held out, at most ``per_language`` of each language and ``sample_rows`` in all;
    null or letterless texts and null languages teach nothing. More than MOST_LANGUAGES languages are an error."""
    return fit(training_rows(docs, p), p)


def identify(docs: DataFrame, model: LangModel, p: LangParams = LangParams()) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score.

    Texts that are null, empty or without a letter are ``und`` with score 0. A null doc_id isn't held out; repeated
    rows get a row each; other columns of ``docs`` are ignored; an empty table gives an empty result."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # at most 2**BITS rows of weights

    def run(batches):
        for batch in batches:
            names, scores = decide(batch.column("_text").to_pylist(), shipped.value)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    held = F.coalesce(remainder(F.col("doc_id"), p.modulus) == p.held_out, F.lit(False))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held_out"), F.col("text").alias("_text")).mapInArrow(run, OUT)
