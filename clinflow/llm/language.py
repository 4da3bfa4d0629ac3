"""Language identification by the nearest of several centroids per language.

A text becomes a vector of character 2- and 3-gram counts, hashed to a fixed number of
dimensions, damped by a logarithm, weighted by inverse document frequency and normalised. Documents of
known language are clustered within their language by spherical k-means; a text gets the language of the
centroid with the largest cosine, and is rejected if it lies further from it than documents of that
cluster do that have about as many distinct n-grams: cosines grow with that number, in any script.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinflow.llm.common import pick, slices, unit_hash

DIMENSIONS = 2048
#: Code points of a text are looked at in parts of this size, which bounds memory for long texts.
PART = 1 << 16
#: Limits are kept by the number of distinct n-grams, in steps of half an octave.
SIZES = 24
LETTER = re.compile(r"[^\W\d_]").search


def counts(texts: list[str], dimensions: int = DIMENSIONS) -> np.ndarray:
    """Hashed n-gram counts of the whole texts; letters lower-cased, all else one gap."""
    out = np.zeros((len(texts), dimensions), dtype=np.float32)
    for row, text in enumerate(texts):
        tail = " "
        for at in range(0, len(text), PART):
            part = tail + text[at:at + PART].lower()
            code = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
            letter = (code >= 97) & (code <= 122) | (code >= 0xAA) & (code != 0xD7) & (code != 0xF7)
            code = np.where(letter, code, np.uint32(32)).astype(np.int64)
            keep = np.ones(code.size, dtype=bool)
            keep[1:] = (code[1:] != 32) | (code[:-1] != 32)
            code = code[keep]
            two = code[:-1] * 8191 + code[1:]
            three = two[:-1] * 8191 + code[2:]
            for values in (two, three):
                hashed = (values * 0x9E3779B1 >> 7) % dimensions
                out[row] += np.bincount(hashed, minlength=dimensions)
            tail = part[-2:]
    return out


def vectors(raw: np.ndarray, idf: np.ndarray) -> np.ndarray:
    out = np.log1p(raw) * idf
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def size_steps(raw: np.ndarray) -> np.ndarray:
    distinct = np.maximum((raw > 0).sum(axis=1), 1)
    return np.minimum((2 * np.log2(distinct)).astype(np.int64), SIZES - 1)


def cluster(points: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    centres = points[rng.permutation(len(points))[:k]]
    for _ in range(rounds):
        own = np.argmax(points @ centres.T, axis=1)
        sums = np.stack([
            points[own == j].sum(axis=0) if (own == j).any() else centres[j]
            for j in range(len(centres))])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
    return centres


@dataclass
class Model:
    idf: np.ndarray
    centres: np.ndarray
    languages: list[str]  # of each centre
    limits: np.ndarray  # least cosine that each centre accepts, by size step

    def predict(self, texts: list[str]) -> list[tuple[str, float, bool]]:
        """(language, score, accepted); ``und`` for a text without letters or an empty model."""
        if not self.languages:
            return [("und", 0.0, False)] * len(texts)
        raw = counts(texts, self.idf.size)
        near = vectors(raw, self.idf) @ self.centres.T
        best = near.argmax(axis=1)
        return [
            (self.languages[b], float(np.clip(row[b], 0, 1)), bool(row[b] >= self.limits[b, s]))
            if LETTER(t) else ("und", 0.0, False)
            for t, b, s, row in zip(texts, best, size_steps(raw), near)]


def reach(near: np.ndarray, spreads: float) -> float:
    """The least cosine accepted among documents with these: the spread is that of the lower half,
    without what a few odd documents add to it."""
    middle, low = np.percentile(near, [50, 16])
    return float(middle - spreads * max(middle - low, 0.01))


def limits_by_size(
    found: list[tuple[int, int, float]], languages: list[str], spreads: float, least: int = 30,
) -> np.ndarray:
    """Limits per centre and size step from (centre, step, cosine) of its documents and of their
    beginnings. A centre with fewer than ``least`` of a step takes them from its language; a step
    without any takes the limit of the next smaller one, else of the next larger."""
    centre, step, near = (np.array(x) for x in zip(*found))
    names = np.array(languages)
    out = np.full((len(languages), SIZES), np.nan)
    for c in range(len(languages)):
        for s in np.unique(step):
            own = near[(centre == c) & (step == s)]
            if own.size < least:
                own = near[(names[centre] == names[c]) & (step == s)]
            if own.size:
                out[c, s] = reach(own, spreads)
        known = np.flatnonzero(~np.isnan(out[c]))
        out[c] = out[c, known[np.maximum(np.searchsorted(known, np.arange(SIZES), "right") - 1, 0)]]
    return np.maximum(out, 1e-3)


def train(
    labelled: DataFrame, clusters: int = 4, sample_rows: int = 4000, spreads: float = 4.0,
    dimensions: int = DIMENSIONS,
) -> Model:
    """Fit on rows with ``text`` and ``lang``.

    Document frequencies count all rows. Centroids are fitted on a sample of about ``sample_rows``
    documents, shared equally by the languages and taken by a hash of the text. A centroid
    accepts cosines down to ``spreads`` times the lower spread below the median of its own documents, and
    of their beginnings, of the same size step. Rows without text
    or language are not used; without any the model answers ``und``.
    """
    rows = pick(labelled, text="text:string", lang="lang:string").where(
        "text is not null and lang is not null")

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(dimensions, dtype=np.int64), 0
        for batch in batches:
            for part in slices(batch, 0):
                total += (counts(part.column(0).to_pylist(), dimensions) > 0).sum(axis=0)
                n += part.num_rows
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(dimensions + 1)), pa.array(np.append(total, n))], ["d", "n"])

    found = rows.select("text").mapInArrow(frequencies, "d bigint, n bigint").groupBy("d").agg(
        F.sum("n")).collect()
    if not found:
        return Model(np.ones(dimensions), np.zeros((0, dimensions)), [], np.zeros((0, SIZES)))
    df = np.zeros(dimensions + 1)
    for d, n in found:
        df[d] = n
    idf = np.log((1 + df[-1]) / (1 + df[:-1])) + 0.1
    sizes = dict(rows.groupBy("lang").count().collect())
    each = max(1, sample_rows // len(sizes))
    share = F.element_at(F.create_map(*[
        x for k, v in sizes.items() for x in (F.lit(k), F.lit(min(1.0, each / v)))]), F.col("lang"))
    taken = rows.where(unit_hash("text", seed=21) <= share)

    def vectorise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 0):
                found = vectors(counts(part.column(0).to_pylist(), dimensions), idf)
                yield pa.RecordBatch.from_arrays(
                    [part.column(1), pa.array([v.astype(np.float16).tobytes() for v in found],
                                              pa.binary())], ["lang", "v"])

    sample = taken.select("text", "lang").mapInArrow(vectorise, "lang string, v binary").sort(
        "lang", "v").collect()
    rng = np.random.default_rng(3)
    centres, languages = [], []
    for lang in sorted(sizes):
        own = [np.frombuffer(r[1], np.float16) for r in sample if r[0] == lang]
        if not own:
            continue
        points = np.stack(own).astype(np.float32)
        found = cluster(points, min(clusters, len(points)), rng)
        best = (points @ found.T).argmax(axis=1)
        for j in np.unique(best):
            centres.append(found[j])
            languages.append(lang)
    if not centres:
        return Model(np.ones(dimensions), np.zeros((0, dimensions)), [], np.zeros((0, SIZES)))
    every, names = np.stack(centres), np.array(languages)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 0):
                out = []
                for text, lang in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    # Beginnings of every half octave of length, and the whole text.
                    cuts = [int(16 * 2 ** (k / 2)) for k in range(40)]
                    raw = counts([*(text[:n] for n in cuts if n < len(text)), text], dimensions)
                    near = vectors(raw, idf) @ every.T
                    near[:, names != lang] = -2
                    best = near.argmax(axis=1)
                    out += zip(best.tolist(), size_steps(raw).tolist(), near.max(axis=1).tolist())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([o[k] for o in out], kind) for k, kind in enumerate(
                        (pa.int64(), pa.int64(), pa.float64()))], ["centre", "step", "near"])

    spread = taken.where(F.col("lang").isin(languages)).select("text", "lang").mapInArrow(
        measure, "centre bigint, step bigint, near double").collect()
    limits = limits_by_size([tuple(r) for r in spread], languages, spreads)
    return Model(idf.astype(np.float32), every, languages, limits)


def classify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``accepted``, in place, without a shuffle.

    Only the text decides. NULL texts and texts without letters are ``und`` with score 0 and are
    not accepted. Columns of those names that the table has are replaced.
    """
    own = [c for c in docs.columns if c not in ("lang_pred", "score", "accepted")]
    schema = docs.select(*own).schema.add("lang_pred", "string").add("score", "double").add(
        "accepted", "boolean")
    text = own.index("text") if "text" in own else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in [batch] if text is None else slices(batch, text):
                texts = [""] * part.num_rows if text is None else [
                    t or "" for t in part.column(text).to_pylist()]
                found = model.predict(texts)
                yield pa.RecordBatch.from_arrays([*part.columns, *[
                    pa.array([f[i] for f in found], kind) for i, kind in enumerate(
                        (pa.string(), pa.float64(), pa.bool_()))]], schema.names)

    return docs.select(*own).mapInArrow(run, schema)


def held_out(doc_id: str = "doc_id") -> Column:
    """Documents that are never learnt from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))
