"""Language identification by nearest centroids.

A text is the TF-IDF vector of its hashed byte trigrams (lowered, runs of other characters than letters as one
space), scaled to length 1. Each language has several centroids, clustered from its training texts; the nearest
by cosine names the language, and a text farther from it than the centroid's own radius is rejected.

The document frequencies cover all training documents. Only the clustering sees a bounded sample of them
(`SAMPLE` texts per language, by a hash of the id).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIMS = 1 << 13
SAMPLE, CLUSTERS, ROUNDS, SEED = 1500, 4, 12, 17
#: A text is rejected below this share of the cosine that all but REJECT_TAIL of a centroid's training texts reach.
REJECT_TAIL, REJECT_SHARE = 0.001, 0.5
FOLDS = 5
NOT_LETTERS = re.compile(r"[\W\d_]+")


def grams(text: str) -> np.ndarray | None:
    """How often each hashed trigram occurs; None without a letter (numerals such as `½` are none)."""
    letters = NOT_LETTERS.sub(" ", text.lower()).strip()
    if not any(map(str.isalpha, letters)):
        return None
    b = np.frombuffer(f" {letters} ".encode("utf-8", "ignore"), dtype=np.uint8).astype(np.uint32)
    codes = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
    return np.bincount((codes * np.uint32(2654435761)) >> np.uint32(19), minlength=DIMS).astype(np.float32)


def vector(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(counts) * idf
    n = np.linalg.norm(v)
    return v / n if n else v


def held_out(doc_id: Column) -> Column:
    """The fold that nothing is learned from: crc32 of the id as text is a multiple of FOLDS. A null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def document_frequencies(texts: DataFrame) -> np.ndarray:
    """How many texts each trigram occurs in: added up in each task, then over the tasks; DIMS rows reach the driver."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen, n = np.zeros(DIMS, np.int64), 0
        for batch in batches:
            for text in batch["text"]:
                if (g := grams(text)) is not None:
                    seen += g > 0
                    n += 1
        dims = np.flatnonzero(seen)
        yield pd.DataFrame({"dim": np.append(dims, DIMS), "n": np.append(seen[dims], n)})

    out = np.zeros(DIMS + 1, np.int64)
    for r in texts.select("text").mapInPandas(count, "dim int, n long").groupBy("dim").agg(F.sum("n").alias("n")).collect():
        out[r["dim"]] = r["n"]
    return out


def cluster(lang: str, vectors: np.ndarray) -> list[tuple[str, np.ndarray, float]]:
    """Spherical k-means: (language, centroid, the least cosine that is not rejected) of each cluster."""
    k = min(CLUSTERS, len(vectors))
    centres = vectors[np.random.default_rng(SEED).choice(len(vectors), k, replace=False)]
    for _ in range(ROUNDS):
        near = (vectors @ centres.T).argmax(1)
        sums = np.stack([vectors[near == j].sum(0) if (near == j).any() else centres[j] for j in range(k)])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
    cosines = vectors @ centres.T
    near = cosines.argmax(1)
    return [(lang, centres[j], float(np.quantile(cosines[near == j, j], REJECT_TAIL)) * REJECT_SHARE) for j in range(k) if (near == j).any()]


class Model:
    """Inverse document frequencies and centroids. Small whatever the corpus: DIMS floats for each cluster."""

    def __init__(self, idf: np.ndarray, parts: list[tuple[str, np.ndarray, float]]):
        self.idf, self.langs = idf, [p[0] for p in parts]
        self.centres = np.stack([p[1] for p in parts]).astype(np.float32) if parts else np.zeros((0, DIMS), np.float32)
        self.least = [p[2] for p in parts]

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        counts = grams(text) if text else None
        if counts is None or not self.langs:
            return "und", 0.0, True
        cosines = self.centres @ vector(counts, self.idf)
        j = int(cosines.argmax())
        return self.langs[j], float(min(1.0, max(0.0, cosines[j]))), bool(cosines[j] < self.least[j])


def train(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """From text and lang of the documents that have both and are not held out."""
    labelled = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id", "text", "lang")
    seen = document_frequencies(labelled)
    idf = (np.log((1 + seen[-1]) / (1 + seen[:-1])) + 1).astype(np.float32)
    # The sample: ids whose hash lies below sample / number of texts, for each language.
    share = {r["lang"]: min(1.0, sample / r["count"]) for r in labelled.groupBy("lang").count().collect()}
    if not share:
        return Model(idf, [])
    unit = F.conv(F.substring(F.md5(F.col("doc_id").cast("string")), 1, 8), 16, 10).cast("double") / float(1 << 32)
    limit = F.create_map(*[F.lit(x) for pair in share.items() for x in pair])[F.col("lang")]

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = [(lang, grams(text)) for lang, text in zip(batch["lang"], batch["text"], strict=True)]
            yield pd.DataFrame([(lang, vector(g, idf).astype(np.float16).tobytes()) for lang, g in made if g is not None], columns=["lang", "v"])

    chosen = labelled.where(unit < limit).mapInPandas(vectors, "lang string, v binary")

    def fit(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("v")
        parts = cluster(key[0], np.stack([np.frombuffer(v, np.float16) for v in rows["v"]]).astype(np.float32))
        return pd.DataFrame([(lang, c.astype(np.float32).tobytes(), least) for lang, c, least in parts], columns=["lang", "centre", "least"])

    found = chosen.groupBy("lang").applyInPandas(fit, "lang string, centre binary, least double").collect()  # CLUSTERS rows a language
    return Model(idf, sorted(((r["lang"], np.frombuffer(r["centre"], np.float32), r["least"]) for r in found), key=lambda p: (p[0], p[2])))


def identify(docs: DataFrame, model: Model, into: str = "language") -> DataFrame:
    """docs plus the column `into`: struct of lang_pred, score (cosine, 0 to 1) and rejected.

    A null text, or one without a letter, is `und` with score 0 and rejected, as is every text if nothing was
    learned. Ties go to the first language. Very long texts count whole; repeated rows each get the same result; an
    empty table gives no rows. Row by row, without a shuffle.
    """

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def language(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([model.predict(t) for t in texts], columns=["lang_pred", "score", "rejected"])

    return docs.withColumn(into, language("text"))


def report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, rejected."""
    docs = docs.select("doc_id", "text", "lang")
    return identify(docs, train(docs)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "language.lang_pred", "language.score", "language.rejected")

