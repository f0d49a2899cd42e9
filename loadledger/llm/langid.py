"""Language identification by nearest centroid.

A text becomes a vector of its letter n-grams (one to three characters, hashed to a fixed number of
places), weighted by TF-IDF and of length one. Each language has several centroids, from spherical
k-means over a sample of its labelled rows; a text gets the language of the centroid with the
largest cosine. A text whose cosine is less than ``SLACK`` times the least that a training row of
the language had is marked as rejected.

Only the fit uses a sample: about ``per_language`` labelled rows of each language, chosen by a hash
of the id, with whole texts. Prediction reads every whole text, and nothing else of a row. Vectors
are made, counted and clustered in Spark tasks; the driver gets the counts of the hashed places and
the centroids.

Defined results: a null text, or one without a letter, is ``und`` with score 0 and rejected; so is
every text if no row is labelled. Of equal cosines the first language by code point wins. A null id
is never held out and never learned from. Each row gives one row, an empty table none. Columns other
than those named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadledger.llm.registry import bound_batches, load, query
from loadledger.work import cut_lineage

UNKNOWN = "und"
#: Hashed places of a vector, as a power of two.
PLACES = 14
#: Labelled rows of a language to learn from, about.
PER_LANGUAGE = 500
CLUSTERS = 4
ROUNDS = 8
#: A text is rejected below this share of the least similarity seen in training.
SLACK = 0.3


@cache
def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def places(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The hashed n-grams of a text and how often each occurs; none if it has no letter."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[points]
    if not letter.any():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    # What is no letter becomes a space, and a run of them one; words get a space on either side.
    points = np.where(letter, points, np.uint32(32))
    gap = ~letter
    points = points[~(gap & np.concatenate(([True], gap[:-1])))]
    points = np.concatenate(([32], points, [32] if points[-1] != 32 else [])).astype(np.uint32)
    counts = np.zeros(1 << PLACES, np.int64)
    grams = points
    for size in (1, 2, 3):
        if size > 1:
            grams = grams[:-1] * np.uint32(0x01000193) + points[size - 1 :]
        hashed = (grams + np.uint32(size)) * np.uint32(0x9E3779B1)
        counts += np.bincount(hashed >> np.uint32(32 - PLACES), minlength=1 << PLACES)
    found = np.flatnonzero(counts)
    return found, counts[found]


def _weighted(found: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    weights = np.log1p(counts) * idf[found]
    return weights / np.linalg.norm(weights)


@dataclass
class Model:
    """Languages, IDF per place, centroids as columns with their language, and limits by language."""

    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray
    owner: np.ndarray
    limits: np.ndarray

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """The language, the cosine and whether the text is too far away."""
        found, counts = places(text)
        if not len(found) or not self.languages:
            return UNKNOWN, 0.0, True
        cosines = _weighted(found, counts, self.idf) @ self.centroids[found]
        best = int(np.argmax(cosines))
        score = float(min(1.0, max(0.0, cosines[best])))
        return self.languages[self.owner[best]], score, score < self.limits[self.owner[best]]


def cluster(vectors: np.ndarray, clusters: int = CLUSTERS, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Centroids of unit vectors by spherical k-means, and the least similarity of a row to its own."""
    centres = vectors[:1]
    while len(centres) < min(clusters, len(vectors)):
        far = int(np.argmin((vectors @ centres.T).max(axis=1)))
        centres = np.vstack([centres, vectors[far]])
    for _ in range(rounds):
        own = (vectors @ centres.T).argmax(axis=1)
        sums = np.stack([vectors[own == k].sum(axis=0) if (own == k).any() else c for k, c in enumerate(centres)])
        centres = sums / np.linalg.norm(sums, axis=1, keepdims=True)
    return centres, float((vectors @ centres.T).max(axis=1).min())


def fit(
    labelled: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    per_language: int = PER_LANGUAGE,
) -> Model:
    """Learn from a sample of the rows with a language."""
    bound_batches(labelled.sparkSession)
    rows = labelled.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
    ).where("lang IS NOT NULL AND text IS NOT NULL")
    # Written first: its size is then known, and the texts need not be dealt out by language for it.
    sizes = cut_lineage(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")))
    share = F.pmod(F.xxhash64("id"), F.lit(1 << 20)) / (1 << 20)
    chosen = rows.join(sizes, "lang").where(share < per_language / F.col("n"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [places(text.as_py()) for text in batch.column(1)]
            columns = [batch.column(0), pa.array([m[0].tolist() for m in made]), pa.array([m[1].tolist() for m in made])]
            shape = pa.schema([("lang", pa.string()), ("found", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))])
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, shape)], schema=shape)

    shape = "lang string, found array<bigint>, counts array<bigint>"
    vectors = chosen.select("lang", "text").mapInArrow(read, shape)
    vectors = cut_lineage(vectors.where("size(found) > 0"))
    documents = np.zeros(1 << PLACES)
    for place, n in vectors.select(F.explode("found").alias("p")).groupBy("p").count().collect():
        documents[place] = n
    idf = np.log((1 + vectors.count()) / (1 + documents)) + 1

    def centre(frame: pd.DataFrame) -> pd.DataFrame:
        dense = np.zeros((len(frame), 1 << PLACES), np.float32)
        frame = frame.assign(key=frame["found"].map(bytes_of)).sort_values("key", ignore_index=True)
        for row, (found, counts) in enumerate(zip(frame["found"], frame["counts"])):
            dense[row, np.asarray(found)] = _weighted(np.asarray(found), np.asarray(counts), idf)
        centres, least = cluster(dense)
        return pd.DataFrame({"lang": frame["lang"].iloc[0], "centre": list(centres), "least": least})

    def bytes_of(found: np.ndarray) -> bytes:
        return np.asarray(found, np.int64).tobytes()

    made = vectors.groupBy("lang").applyInPandas(centre, "lang string, centre array<float>, least double").collect()
    made.sort(key=lambda row: (row.lang.encode(), row.centre))
    languages = list(dict.fromkeys(row.lang for row in made))
    limits = {row.lang: row.least * SLACK for row in made}
    return Model(
        languages,
        idf,
        np.array([row.centre for row in made], np.float32).reshape(-1, 1 << PLACES).T.copy(),
        np.array([languages.index(row.lang) for row in made], np.int64),
        np.array([limits[lang] for lang in languages]),
    )


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``lang_pred``, ``score`` and ``rejected``."""
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [shared.value.predict(text.as_py()) for text in batch.column(1)]
            columns = [pa.array([m[k] for m in made], t) for k, t in enumerate((pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["id", "lang_pred", "score", "rejected"])

    found = rows.mapInArrow(work, f"id {kind}, lang_pred string, score double, rejected boolean")
    return found.withColumnRenamed("id", id_col)


def accepted(model: Model, spark: SparkSession, text: Column) -> Column:
    """Whether a text's language is known, as a condition on rows."""
    bound_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def known(texts: pd.Series) -> pd.Series:
        return pd.Series([not shared.value.predict(t)[2] for t in texts], dtype=bool)

    return known(text)


def held_out(id_col: str = "doc_id") -> Column:
    """The quarter of the ids that no model learns from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def learnable(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return docs.where(F.col(id_col).isNotNull() & ~held_out(id_col))


@query()
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents", "doc_id", "text", "lang")
    model = fit(learnable(docs))
    return predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")
