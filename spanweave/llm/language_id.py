"""Language identification by sparse multinomial logistic regression.

Features are TF-IDF weights of character n-grams (1 to 3 code points, lower case), hashed to FEATURES places. The weights are
trained by follow-the-regularised-leader with an elastic net, which leaves most of them zero; a temperature is then fitted on rows
put aside, so that scores are probabilities. Document frequencies come from every learning document; the classifier itself is fitted
on a bounded sample of them (about FIT_ROWS, the same quota for every language, chosen by a hash of doc_id).

Defined cases: a null text, or one without a letter, is `und` with score 0; null doc_ids are predicted but not learned from; rows without
lang aren't learned from; with nothing to learn from every row is `und`; repeated rows are predicted one by one; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanweave.llm.common import documents, fresh, slices

QUERY = "op6_language_id"
ORACLE_SQL = None  # a trained model is no SQL; tests measure held-out accuracy
FEATURES = 1 << 14
FIT_ROWS = 3000
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 2e-3, 1e-3
UNKNOWN = "und"

_PRIMES = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))


class Model(NamedTuple):
    languages: list[str]
    idf: np.ndarray  # of the features
    weights: np.ndarray  # features x languages
    bias: np.ndarray
    temperature: float


def _slots(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of texts, and the text each belongs to."""
    lowered = [t.lower() for t in texts]
    sizes = np.fromiter(map(len, lowered), np.int64, len(lowered))
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", errors="surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
    found, owners = [], []
    rolling = np.zeros(len(codes), np.uint32)
    for n in range(1, 4):
        size = max(0, len(codes) - n + 1)
        rolling = rolling[:size] * np.uint32(31) + codes[n - 1 :] * _PRIMES[n - 1]
        slot = (rolling ^ (rolling >> np.uint32(15))) * _PRIMES[0] >> np.uint32(32 - FEATURES.bit_length() + 1)
        whole = owner[:size] == owner[n - 1 :]  # not across two texts
        found.append(slot if whole.all() else slot[whole])
        owners.append(owner[:size] if whole.all() else owner[:size][whole])
    return np.concatenate(found), np.concatenate(owners)


def counts(texts: list[str]) -> np.ndarray:
    """How often each text has each feature, as a matrix."""
    slot, owner = _slots(texts)
    return np.bincount(owner.astype(np.int64) * FEATURES + slot, minlength=len(texts) * FEATURES).reshape(len(texts), FEATURES)


def vectors(matrix: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF rows of unit length, with damped counts."""
    x = np.sqrt(matrix.astype(np.float32))
    x *= idf
    norm = np.sqrt(np.einsum("ij,ij->i", x, x))
    x /= np.maximum(norm, 1e-12)[:, None]
    return x


def _groups(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of at most 32 texts and 500,000 characters, or one text."""
    for a, b in slices(texts, 500_000):
        for at in range(a, b, 32):
            yield at, min(b, at + 32)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, languages: list[str], aside: np.ndarray, idf: np.ndarray) -> Model:
    """FTRL over sparse rows (features, values), then the temperature from the rows put aside."""
    k = len(languages)
    z, n = np.zeros((FEATURES + 1, k)), np.zeros((FEATURES + 1, k))  # the last one is the bias

    def weights(zs: np.ndarray, ns: np.ndarray, l1: float = L1) -> np.ndarray:
        return np.where(np.abs(zs) <= l1, 0.0, (np.sign(zs) * l1 - zs) / ((BETA + np.sqrt(ns)) / ALPHA + L2))

    learn = np.flatnonzero(~aside)
    rng = np.random.default_rng(7)
    for _ in range(EPOCHS):
        for i in rng.permutation(learn):
            at, x = np.append(rows[i][0], FEATURES), np.append(rows[i][1], 1.0)
            zs, ns = z[at], n[at]
            w = weights(zs, ns)
            error = softmax(x @ w)
            error[labels[i]] -= 1
            g = x[:, None] * error
            sigma = (np.sqrt(ns + g * g) - np.sqrt(ns)) / ALPHA
            z[at], n[at] = zs + g - sigma * w, ns + g * g
    w = weights(z, n)
    scores = np.array([x @ w[at] + w[FEATURES] for at, x in (rows[i] for i in np.flatnonzero(aside))]).reshape(-1, k)
    truth = labels[aside]
    best, least = 1.0, np.inf
    for t in np.geomspace(0.05, 20, 120) if len(truth) else ():
        p = softmax(scores / t)[np.arange(len(truth)), truth]
        loss = -np.log(np.maximum(p, 1e-12)).mean()
        if loss < least:
            best, least = float(t), loss
    return Model(languages, idf, w[:FEATURES].astype(np.float32), w[FEATURES].astype(np.float32), best)


def has_letter(text: str) -> bool:
    head = text[:200]
    return any(map(str.isalpha, head)) or any(c.isalpha() or unicodedata.category(c)[0] == "L" for c in text[200:])


def predict(model: Model, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
    if not model.languages:
        return names, scores
    known = [i for i, t in enumerate(texts) if t is not None and has_letter(t)]
    own = [texts[i] for i in known]
    for a, b in _groups(own):
        p = softmax((vectors(counts(own[a:b]), model.idf) @ model.weights + model.bias) / model.temperature)
        for i, best, score in zip(known[a:b], p.argmax(axis=1).tolist(), p.max(axis=1).tolist(), strict=True):
            names[i], scores[i] = model.languages[best], min(1.0, float(score))
    return names, scores


def document_frequencies(docs: DataFrame) -> np.ndarray:
    """In how many texts each feature stands; the last number is that of texts. Summed by feature on the executors."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df, total = np.zeros(FEATURES, np.int64), 0
        for frame in frames:
            texts = frame["text"].tolist()
            total += len(texts)
            for a, b in _groups(texts):
                df += (counts(texts[a:b]) > 0).sum(axis=0)
        some = np.flatnonzero(df)
        yield pd.DataFrame({"feature": np.append(some, FEATURES), "n": np.append(df[some], total)})

    rows = docs.select("text").mapInPandas(run, "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    out = np.zeros(FEATURES + 1, np.int64)
    for r in rows.collect():  # at most FEATURES + 1 rows
        out[r.feature] = r.n
    return out


def train(docs: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """A model from (doc_id, text, lang) of labelled documents."""
    rows = docs.where("text IS NOT NULL AND lang IS NOT NULL AND doc_id IS NOT NULL")
    totals = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}  # a row for each language
    languages = sorted(totals)
    if not languages:
        return Model([], np.empty(0), np.empty(0), np.empty(0), 1.0)
    df = document_frequencies(rows)
    idf = (np.log((1 + df[-1]) / (1 + df[:-1])) + 1).astype(np.float32)
    quota = max(1, fit_rows // len(languages))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000))
    share = F.lit(0)
    for name, total in totals.items():
        share = F.when(F.col("lang") == name, int(min(1.0, quota / total) * 1_000_000) + 1).otherwise(share)
    chosen = rows.where(place < share).select("lang", "text", (F.pmod(F.hash("doc_id"), F.lit(5)) == 0).alias("aside"))

    def features(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = frame["text"].tolist()
            for a, b in _groups(texts):
                x = vectors(counts(texts[a:b]), idf)
                out = [(lang, aside, np.flatnonzero(v).astype(np.int32).tobytes(), v[v > 0].tobytes()) for lang, aside, v in zip(frame["lang"][a:b], frame["aside"][a:b], x, strict=True)]
                yield pd.DataFrame(out, columns=["lang", "aside", "at", "x"])

    def learn(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["lang", "at", "x"])
        data = [(np.frombuffer(at, np.int32), np.frombuffer(x, np.float32).astype(float)) for at, x in zip(frame["at"], frame["x"], strict=True)]
        labels = np.array([languages.index(lang) for lang in frame["lang"]])
        model = fit(data, labels, languages, frame["aside"].to_numpy(dtype=bool), idf)
        return pd.DataFrame({"weights": [model.weights.tobytes()], "bias": [model.bias.tobytes()], "temperature": [model.temperature]})

    # one task, for one bounded sample
    got = chosen.mapInPandas(features, "lang string, aside boolean, at binary, x binary").groupBy().applyInPandas(learn, "weights binary, bias binary, temperature double").first()
    weights = np.frombuffer(got.weights, np.float32).reshape(FEATURES, len(languages))
    return Model(languages, idf, weights, np.frombuffer(got.bias, np.float32), got.temperature)


def learning_rows(docs: DataFrame) -> DataFrame:
    """Documents that may be learned from: their crc32(doc_id as text) mod 3 isn't 1."""
    return docs.where(~_held_out())


def _held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame, model: Model, columns: list[str] | None = None) -> DataFrame:
    """The given columns of docs (doc_id) with lang_pred and score."""
    names = columns or ["doc_id"]
    holder = docs.sparkSession.sparkContext.broadcast(model)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            frame["_pred"], frame["_score"] = predict(holder.value, frame["_text"].tolist())
            yield frame.drop(columns="_text")

    source = docs.select(*names, F.col("text").alias("_text"))
    schema = docs.select(*names).schema.add("_pred", "string").add("_score", "double")
    return source.mapInPandas(run, schema)


def keep_identified(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """Documents whose language is told with such a score at least; learned from the documents' own lang.

    Null texts and those without a letter go; without any labelled document no language can be told, and all that have a letter stay.
    """
    model = train(learning_rows(docs))
    if not model.languages:
        return docs.where(F.col("text").rlike("\\p{L}"))
    (said_name,) = fresh(docs, "said")
    said = F.pandas_udf(lambda t: pd.DataFrame(dict(zip(("name", "score"), predict(model, [x if isinstance(x, str) else None for x in t]), strict=True))), "name string, score double")
    told = F.col(said_name)
    return docs.withColumn(said_name, said("text")).where((told["name"] != UNKNOWN) & (told["score"] >= least)).drop(said_name)


def query(spark, sf_dir):
    docs = documents(spark, sf_dir)
    rows = identify(docs, train(learning_rows(docs)))
    return rows.select("doc_id", _held_out().alias("held_out"), F.col("_pred").alias("lang_pred"), F.col("_score").alias("score"))
