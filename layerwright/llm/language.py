"""Language identification by nearest centroid.

A text is a vector of the byte pairs and triples of its lower-cased letters, hashed into ``FEATURES`` places, weighted by
TF-IDF and scaled to length one.  Document frequencies cover all training documents.  Each language is described by a few
centroids, found by clustering a bounded sample of its documents; a text takes the language of the centroid with the
largest cosine.  It is rejected if that is further away than nearly all documents of the language were, by a margin.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import small_batches
from .words import slices, text_units, tidy, whole

FEATURES = 4096
CENTROIDS = 4
# Documents per language that the centroids are fitted on.
FIT_DOCUMENTS = 1500
# Bits of a mark that tell its range.
RANGE_BITS = 12
# The cosine that but such a part of the fitted documents reach, and the part of it that a text must still reach.
LOWEST = 0.002
MARGIN = 0.6
SLICE_BYTES, SLICE_ROWS = 1 << 20, 256
UNKNOWN = "und"
LETTER = r"\p{L}"
# Bytes that are not letters, of the first 128, become spaces.
LETTERS = np.array([b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)], np.uint8)


def gram_counts(texts: pa.Array) -> np.ndarray:
    """Number of each hashed byte pair and triple in each text; null texts have none."""
    padded = pc.binary_join_element_wise(" ", pc.utf8_lower(pc.fill_null(texts, "")), " ", "")
    data, bounds = text_units(padded)
    data = LETTERS[data].astype(np.uint32)
    rows = len(bounds) - 1
    owner = np.repeat(np.arange(rows, dtype=np.uint32) * np.uint32(FEATURES), np.diff(bounds))
    # Pairs that would reach into the next text, and those of spaces only, count for nothing.
    pair = data[:-1] << np.uint32(8) | data[1:]
    same = (owner[:-1] == owner[1:]) & (pair != 0x2020)
    slot = ((pair * np.uint32(2654435761)) >> np.uint32(20)) + owner[:-1]
    counts = np.bincount(slot[same], minlength=rows * FEATURES)
    triple = pair[:-1] << np.uint32(8) | data[2:]
    same = same[:-1] & (owner[:-2] == owner[2:])
    slot = (((triple ^ np.uint32(0x5BD1E995)) * np.uint32(2246822519)) >> np.uint32(20)) + owner[:-2]
    counts += np.bincount(slot[same], minlength=rows * FEATURES)
    return counts.reshape(rows, FEATURES)


def text_slices(batch: pa.RecordBatch) -> Iterator[pa.Table]:
    for part in slices(batch, "text", SLICE_BYTES):
        for start in range(0, part.num_rows, SLICE_ROWS):
            yield part.slice(start, SLICE_ROWS)


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF vectors of length one; zero for a text without grams."""
    vectors = np.log1p(counts, dtype=np.float32) * idf
    norms = np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
    return vectors / np.maximum(norms, 1e-12)


def clustered(vectors: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    """Centroids of length one by spherical k-means, begun from vectors far from each other."""
    centres = [vectors.mean(axis=0)]
    while len(centres) < min(k, len(vectors)):
        near = np.max(vectors @ np.stack(centres).T, axis=1)
        centres.append(vectors[near.argmin()])
    found = np.stack(centres)
    for _ in range(rounds):
        found = found / np.maximum(np.linalg.norm(found, axis=1, keepdims=True), 1e-12)
        nearest = (vectors @ found.T).argmax(axis=1)
        found = np.stack([vectors[nearest == c].mean(axis=0) if (nearest == c).any() else found[c] for c in range(len(found))])
    return found / np.maximum(np.linalg.norm(found, axis=1, keepdims=True), 1e-12)


class LanguageModel:
    """Centroids with the language and the least admitted cosine of each."""

    def __init__(self, idf: np.ndarray, languages: list[str], centroids: np.ndarray, floors: np.ndarray) -> None:
        self.idf, self.languages, self.centroids, self.floors = idf, languages, centroids, floors

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and rejection of each text."""
        lettered = pc.fill_null(pc.match_substring_regex(texts, LETTER), False).to_numpy(zero_copy_only=False)
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        cosines = weighted(gram_counts(texts), self.idf) @ self.centroids.T
        best = cosines.argmax(axis=1)
        score = np.clip(cosines[np.arange(len(best)), best], 0, 1).astype(np.float64)
        named = [self.languages[b] if ok else UNKNOWN for b, ok in zip(best, lettered)]
        return named, np.where(lettered, score, 0.0), ~lettered | (score < self.floors[best])


def smallest_marks(marks: DataFrame, most: int) -> DataFrame:
    """``lang, cut``: the mark of the ``most``-th row of each language by ``mark``, or its last one.

    Rows are counted by ranges of marks first, so that only those of the ranges up to the cut are ranked.
    """

    def last(counted: DataFrame, by: str, name: str) -> DataFrame:
        before = counted.selectExpr("lang", by, f"sum(n) OVER (PARTITION BY lang ORDER BY {by}) - n AS before")
        return before.where(f"before < {int(most)}").groupBy("lang").agg(F.max(by).alias(name))

    ranged = marks.withColumn("range", F.shiftright("mark", 64 - RANGE_BITS))
    ranges = last(ranged.groupBy("lang", "range").agg(F.count("*").alias("n")), "range", "last_range")
    near = ranged.join(F.broadcast(ranges), "lang").where("range <= last_range")
    return last(near.groupBy("lang", "mark").agg(F.count("*").alias("n")), "mark", "cut")


def fit_languages(training: DataFrame, fit_documents: int = FIT_DOCUMENTS, centroids: int = CENTROIDS) -> LanguageModel:
    """Fit on ``doc_id, text, lang``; rows with a null language or a text that is null or has no letter teach nothing.

    Document frequencies come from all rows.  The centroids come from the ``fit_documents`` rows of each language with
    the smallest hash of their id, one for each id: that bound is the only sample taken.
    """
    small_batches(training.sparkSession)
    known = training.select("doc_id", "text", "lang").where("lang IS NOT NULL").where(F.col("text").rlike(LETTER))

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(FEATURES + 1, np.int64)
        for batch in batches:
            for part in text_slices(batch):
                total[:FEATURES] += (gram_counts(whole(part["text"])) > 0).sum(axis=0)
                total[FEATURES] += part.num_rows
        yield pa.record_batch({"place": np.arange(FEATURES + 1, dtype=np.int32), "n": total})

    counted = known.select("text").mapInArrow(tidy(frequencies), "place int, n long").groupBy("place").agg(F.sum("n").alias("n"))
    found = np.zeros(FEATURES + 1, np.int64)
    for row in counted.collect():
        found[row.place] = row.n
    idf = (np.log((1 + found[FEATURES]) / (1 + found[:FEATURES])) + 1).astype(np.float32)

    # The cut of each language: the hash that so many of its rows do not exceed.  One row per language, like the model's
    # centroids, so it goes to the texts and not they to it.
    marked = known.withColumn("mark", F.xxhash64("doc_id"))
    cuts = smallest_marks(marked.select("lang", "mark"), fit_documents)
    sample = marked.join(F.broadcast(cuts), "lang").where("mark <= cut")
    sample = sample.dropDuplicates(["lang", "mark"]).select("lang", "text")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                made = weighted(gram_counts(whole(part["text"])), idf)
                yield pa.record_batch(
                    {"lang": whole(part["lang"]), "vector": pa.array([v.tobytes() for v in made], pa.binary())}
                )

    def centres(rows: pa.Table) -> pa.Table:
        own = np.frombuffer(b"".join(sorted(rows["vector"].to_pylist())), np.float32).reshape(-1, FEATURES)
        made = clustered(own, centroids)
        least = float(np.quantile(np.max(own @ made.T, axis=1), LOWEST))
        langs = [rows["lang"][0].as_py()] * len(made)
        return pa.table({"lang": langs, "least": [least] * len(made), "vector": [v.tobytes() for v in made]})

    shaped = sample.mapInArrow(tidy(vectors), "lang string, vector binary")
    shaped = shaped.groupBy("lang").applyInArrow(centres, "lang string, least double, vector binary")
    rows = sorted(shaped.collect())
    found = np.frombuffer(b"".join(r.vector for r in rows), np.float32).reshape(-1, FEATURES)
    return LanguageModel(idf, [r.lang for r in rows], found, MARGIN * np.array([r.least for r in rows]))


def identified(documents: DataFrame, model: LanguageModel, carry: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, lang_pred, score, rejected`` for every row of ``documents``, from its text alone.

    Of other columns, whatever their names, only those in ``carry`` are kept, before these.  A null text, or one
    without any letter, is ``und`` with score 0 and rejected; so is every text if nothing was learned.  The score is the
    cosine with the nearest centroid.  Null ids are kept, repeated rows judged each; no rows give no rows.
    """
    small_batches(documents.sparkSession)
    kept = [f"carried_{k}" for k in range(len(carry))]
    rows = documents.select("doc_id", "text", *(F.col(c).alias(k) for c, k in zip(carry, kept)))
    types = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = ", ".join(f"{c} {types[c]}" for c in ("doc_id", *kept))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                named, score, rejected = model.predict(whole(part["text"]))
                columns = {c: part[c] for c in ("doc_id", *kept)}
                columns |= {"lang_pred": named, "score": score, "rejected": rejected}
                yield from pa.table(columns).to_batches()

    result = rows.mapInArrow(tidy(predict), f"{schema}, lang_pred string, score double, rejected boolean")
    carried = (F.col(k).alias(c) for c, k in zip(carry, kept))
    return result.select("doc_id", *carried, "lang_pred", "score", "rejected")


def fold(parts: int, column: str = "doc_id") -> Column:
    """``crc32(id as text) mod parts``; null for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % parts
