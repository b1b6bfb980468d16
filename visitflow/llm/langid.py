"""Language identification by nearest centroid.

A text is the vector of its byte bigrams and trigrams (lower case, everything in ASCII but letters one kind
of gap), counted in ``DIMENSIONS`` hashed places, weighted ``(1 + ln count) * idf`` and normalised.  Each
language has up to ``CLUSTERS`` centroids, found by spherical k-means over a bounded sample; a text gets the
language of the centroid of the largest cosine, and is marked as rejected where that centroid is farther
away than it is from all but one in a hundred of its own sample texts.  Document frequencies cover all
labelled texts, every count whole texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import flat, steps

BITS = 13
DIMENSIONS = 1 << BITS
#: Centroids of a language, and the sample they are fitted on: texts of one language, and of all.
CLUSTERS, PER_LANGUAGE, SAMPLE = 4, 400, 2000
UNKNOWN = "und"
#: Bytes of text whose n-grams are sorted together, and centroids that are compared at once.
PIECE, ABREAST = 1 << 18, 16

_GAP = 32
_KIND = np.array([b if b >= 0x80 or 97 <= b <= 122 else _GAP for b in range(256)], np.uint32)


def _places(b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed places of the bigram and of the trigram that begin at each byte, and which bigrams are no gap."""
    two = (b[:-1] << 8) | b[1:]
    three = (two[:-1] << 8) | b[2:]
    shift = np.uint32(32 - BITS)
    return (two * np.uint32(2654435761)) >> shift, ((three + np.uint32(1 << 24)) * np.uint32(2654435761)) >> shift, two != (_GAP << 8 | _GAP)


def ngram_counts(text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, place and count of all n-grams of the texts, in order of text and place.  Null is empty."""
    data, offsets = flat(pc.utf8_lower(pc.fill_null(text.cast(pa.large_string()), "")))
    b = np.concatenate([[np.uint32(_GAP)], _KIND.take(data)])
    if len(text) == 1 and len(b) > PIECE:
        total = np.zeros(DIMENSIONS, np.int64)
        for at in range(0, len(b) - 1, PIECE):
            two, three, kept = _places(b[at : at + PIECE + 2])
            total += np.bincount(two[:PIECE][kept[:PIECE]], minlength=DIMENSIONS)
            total += np.bincount(three[kept[:-1]], minlength=DIMENSIONS)
        place = np.flatnonzero(total)
        return np.zeros(len(place), np.int64), place, total[place]
    if len(b) < 2:
        return (np.zeros(0, np.int64),) * 3
    two, three, kept = _places(b)
    doc = np.repeat(np.arange(len(text), dtype=np.int64) << BITS, np.diff(offsets))
    inside = kept[:-1].copy()
    inside[offsets[1:-1] - 1] = False  # begins with the last byte of a text: the third is of the next
    keys = np.concatenate([doc[kept] | two[kept], doc[:-1][inside] | three[inside]])
    if len(text) < 1 << (31 - BITS):
        keys = keys.astype(np.int32)
    keys.sort()
    begin = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    first = keys[begin].astype(np.int64)
    return first >> BITS, first & (DIMENSIONS - 1), np.diff(np.append(begin, len(keys)))


def _pieces(batches, text_index: int):
    """Record batches of at most PIECE bytes of text, one row at least."""
    for batch in steps(batches, text_index):
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text_index)), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PIECE, side="right")))
            yield batch.slice(at, stop - at)
            at = stop


def weighted(doc, place, count, idf, n: int) -> np.ndarray:
    """The normalised TF-IDF weight of each entry of ``ngram_counts``."""
    weight = (1 + np.log(count)) * idf[place]
    norm = np.sqrt(np.bincount(doc, weight * weight, n))
    return weight / norm[doc]


def cosines(doc, place, weight, centroids: np.ndarray, n: int) -> np.ndarray:
    """Cosine of each of the n texts with each centroid, a row of ``centroids``; 0 for texts without n-grams."""
    out = np.zeros((n, len(centroids)))
    if len(doc):
        begin = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
        for at in range(0, len(centroids), ABREAST):
            across = np.ascontiguousarray(centroids[at : at + ABREAST].T)
            out[doc[begin], at : at + ABREAST] = np.add.reduceat(across[place] * weight[:, None], begin)
    return out


def has_letter(text: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.match_substring_regex(text, r"\p{L}"), False).to_numpy(zero_copy_only=False)


def learnable(doc_id: Column) -> Column:
    """Whether a document may be learned from: crc32 of its id modulo 4 is not 2; false without an id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 != 2, F.lit(False))


def _frequencies(texts: DataFrame) -> tuple[int, np.ndarray]:
    """Number of texts and of texts that hold each place: one array a task, added up in 64 tasks, then here."""
    def count(batches):
        n, total = 0, np.zeros(DIMENSIONS, np.int64)
        for batch in _pieces(batches, 0):
            n += batch.num_rows
            total += np.bincount(ngram_counts(batch.column(0))[1], minlength=DIMENSIONS)
        yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64()), "counts": pa.array([total.tobytes()], pa.binary())})

    def add(batches):
        n, total = 0, np.zeros(DIMENSIONS, np.int64)
        for batch in batches:
            for k, counts in zip(*(c.to_pylist() for c in batch.columns)):
                n, total = n + k, total + np.frombuffer(counts, np.int64)
        yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64()), "counts": pa.array([total.tobytes()], pa.binary())})

    parts = texts.mapInArrow(count, "n long, counts binary").where("n > 0")
    rows = parts.repartition(64, "n").mapInArrow(add, "n long, counts binary").where("n > 0").collect()
    return sum(r.n for r in rows), sum((np.frombuffer(r.counts, np.int64) for r in rows), np.zeros(DIMENSIONS, np.int64))


def _sample(labelled: DataFrame, per_language: int, sample: int) -> list:
    """(lang, places, counts) of at most ``per_language`` texts of a language and ``sample`` of all, those of the
    smallest id hashes; an id with several texts in a language gives the one of the smallest MD5."""
    ids = labelled.select("lang", "doc_id").distinct().withColumn("hash", F.xxhash64("doc_id"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("hash", "doc_id"))
    picked = ids.withColumn("rank", rank).where(F.col("rank") <= per_language).orderBy("rank", "lang").limit(sample)
    # at most `sample` rows of an id and a label
    texts = labelled.join(F.broadcast(picked.drop("hash", "rank")), ["lang", "doc_id"]).groupBy("lang", "doc_id").agg(
        F.min_by("text", F.md5("text")).alias("text"))

    def count(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                _, place, counts = ngram_counts(batch.column(2).slice(k, 1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(k, 1), batch.column(1).slice(k, 1), pa.array([place.astype(np.int32).tobytes()], pa.binary()),
                     pa.array([counts.astype(np.int32).tobytes()], pa.binary())], names=["lang", "doc_id", "places", "counts"])

    schema = T.StructType([labelled.schema["lang"], labelled.schema["doc_id"],
                           T.StructField("places", T.BinaryType()), T.StructField("counts", T.BinaryType())])
    rows = texts.mapInArrow(count, schema).collect()
    return [(r.lang, np.frombuffer(r.places, np.int32), np.frombuffer(r.counts, np.int32))
            for r in sorted(rows, key=lambda r: (r.lang, str(r.doc_id))) if r.places]


def clusters(vectors: np.ndarray, k: int, rounds: int = 10) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means: unit centroids, begun farthest first, and the centroid of each unit vector."""
    middle = vectors.sum(0)
    begun = [int(np.argmax(vectors @ middle))]
    near = vectors @ vectors[begun[0]]
    while len(begun) < min(k, len(vectors)) and near.min() < 1 - 1e-6:
        begun.append(int(np.argmin(near)))
        near = np.maximum(near, vectors @ vectors[begun[-1]])
    centroids = vectors[begun]
    for _ in range(rounds):
        own = np.argmax(vectors @ centroids.T, axis=1)
        used = np.unique(own)
        centroids = np.stack([vectors[own == c].sum(0) for c in used])
        centroids /= np.linalg.norm(centroids, axis=1, keepdims=True)
    return centroids, np.argmax(vectors @ centroids.T, axis=1)


class Model:
    """``languages[k]`` is the language of row k of ``centroids``, ``radius[k]`` the least cosine it accepts."""

    def __init__(self, idf, languages, centroids, radius):
        self.idf, self.languages, self.centroids, self.radius = idf, languages, centroids, radius

    def judge(self, text: pa.Array):
        """Language, score and whether it is rejected, of each text."""
        n = len(text)
        letters = has_letter(text)
        if not self.languages:
            return [UNKNOWN] * n, np.zeros(n), np.ones(n, bool)
        doc, place, count = ngram_counts(text)
        near = cosines(doc, place, weighted(doc, place, count, self.idf, n), self.centroids, n)
        best = np.argmax(near, axis=1)
        score = np.clip(near[np.arange(n), best], 0, 1) * letters
        return [self.languages[b] if ok else UNKNOWN for b, ok in zip(best, letters)], score, (score < self.radius[best]) | ~letters


def fit(labelled: DataFrame, k: int = CLUSTERS, per_language: int = PER_LANGUAGE, sample: int = SAMPLE) -> Model:
    """A model of the texts and languages of ``labelled`` (doc_id, text, lang); rows without text or lang are left out.

    The centroids are fitted on at most ``per_language`` texts of a language and ``sample`` texts in all, so the model
    holds at most ``sample`` rows of DIMENSIONS numbers; document frequencies are those of all rows.  Without any
    labelled text the model knows no language."""
    labelled = labelled.where("text is not null and lang is not null").select("doc_id", "text", "lang")
    n, frequency = _frequencies(labelled.select("text"))
    idf = np.log((1 + n) / (1 + frequency)) + 1
    rows = _sample(labelled, per_language, sample)
    languages, centroids, radius = [], [], []
    for lang in sorted({r[0] for r in rows}):
        own = [r for r in rows if r[0] == lang]
        vectors = np.zeros((len(own), DIMENSIONS), np.float32)
        for v, (_, place, count) in zip(vectors, own):
            v[place] = weighted(np.zeros(len(place), np.int64), place, count, idf, 1)
        found, member = clusters(vectors, k)
        near = np.einsum("ij,ij->i", vectors, found[member])
        languages += [lang] * len(found)
        centroids.append(found)
        radius += [float(np.quantile(near[member == c], 0.01)) if (member == c).any() else 1.0 for c in range(len(found))]
    table = np.concatenate(centroids).astype(np.float32) if centroids else np.zeros((0, DIMENSIONS), np.float32)
    return Model(idf, languages, table, np.array(radius))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` (doc_id, text) as (doc_id, lang_pred, score, rejected).

    ``lang_pred`` is the language of the nearest centroid, ties the smaller name; ``und``, with score 0 and rejected,
    if the text is null or holds no letter (or the model no language).  ``score`` is the cosine, 0 to 1.  ``rejected``
    marks texts farther from their centroid than it accepts: take them as ``und`` where precision counts."""
    schema = T.StructType([docs.schema["doc_id"], T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())])

    def judge(batches):
        for batch in _pieces(batches, 1):
            lang, score, rejected = model.judge(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected)], names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(judge, schema)
