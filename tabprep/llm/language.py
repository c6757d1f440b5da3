"""Language identification with hyperdimensional profiles.

Every letter (and the word boundary) has a random +1/-1 vector drawn from
its code point.  An n-gram binds its letters' vectors, each permuted by its
place (rolled once per later letter) and multiplied.  A text bundles (adds)
the vectors of all its n-grams; a language's prototype bundles all its
training texts, which is the same as binding once per distinct n-gram and
weighing by its count.  Texts are compared with the prototypes by cosine.

Training adds the vectors within each task and then by (language,
dimension) in Spark, so what meets anywhere is languages x dimensions
however many rows one language has.  The prototypes that reach the driver
and the tasks have that size too.

Defined cases: null, empty and letterless texts are ``und`` with score 0; a
null label does not train; ties go to the first language in order; with no
training text everything is ``und``; repeated rows each train and each get a
row; a text's bundle has a fixed size however long it is.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabprep.functions.names import qcol
from tabprep.llm.common import mix64, table

N, DIMS, UNKNOWN = 3, 512, "und"
CHUNK_CHARS = 500_000


@lru_cache(maxsize=1)
def _alphabetic() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x10000)])


def _letters(code: np.ndarray) -> np.ndarray:
    """Code points with 0 for everything that is no letter."""
    low = code < 0x10000
    is_letter = np.zeros(len(code), bool)
    is_letter[low] = _alphabetic()[code[low]]
    if not low.all():
        far, where = np.unique(code[~low], return_inverse=True)
        is_letter[~low] = np.array([chr(c).isalpha() for c in far])[where]
    return np.where(is_letter, code, 0)


def letter_vectors(code: np.ndarray, dims: int = DIMS) -> np.ndarray:
    """A +1/-1 row per code point, a function of the code point alone."""
    words = (dims + 63) // 64
    seeds = (code.astype(np.uint64)[:, None] << np.uint64(16)) + np.arange(1, words + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        bits = mix64(seeds * np.uint64(0x9E3779B97F4A7C15))
    bits = np.unpackbits(bits.view(np.uint8), axis=1)[:, :dims]
    return bits.astype(np.int8) * 2 - 1


def _chunks(texts: list[str | None]) -> Iterator[range]:
    start, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t or "") + 2
        if held >= CHUNK_CHARS:
            yield range(start, i + 1)
            start, held = i + 1, 0
    if start < len(texts):
        yield range(start, len(texts))


def ngram_counts(texts: list[str | None], n: int = N):
    """(document, n-gram index, count) triples, the n-grams as letter indices, the letters."""
    parts = [np.frombuffer(f" {t.lower() if t else ''} ".encode("utf-32-le", "replace"), np.uint32) for t in texts]
    doc = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    code = _letters(np.concatenate(parts))
    keep = (code != 0) | np.concatenate([[True], (code[:-1] != 0) | (doc[1:] != doc[:-1])])
    code, doc = code[keep], doc[keep]
    alphabet = np.flatnonzero(np.bincount(code))
    index = np.zeros(alphabet[-1] + 1, np.int64)
    index[alphabet] = np.arange(len(alphabet))
    sym, a = index[code], len(alphabet)
    if len(sym) < n:
        return np.zeros((0, 3), np.int64), np.zeros((0, n), np.int64), alphabet
    gram = np.zeros(len(sym) - n + 1, np.int64)
    for j in range(n):
        gram = gram * a + sym[j:len(sym) - n + 1 + j]
    first, last = doc[:len(gram)], doc[n - 1:]
    whole = first == last
    kinds, gram = np.unique(gram[whole], return_inverse=True)
    pair, counts = np.unique(first[whole] * len(kinds) + gram, return_counts=True)
    letters = np.stack([kinds // a ** (n - 1 - j) % a for j in range(n)], axis=1)
    return np.stack([pair // max(len(kinds), 1), pair % max(len(kinds), 1), counts], axis=1), letters, alphabet


def ngram_vectors(letters: np.ndarray, alphabet: np.ndarray, dims: int = DIMS) -> np.ndarray:
    base, n = letter_vectors(alphabet, dims), letters.shape[1]
    out = np.ones((len(letters), dims), np.int8)
    for j in range(n):
        out *= np.roll(base, n - 1 - j, axis=1)[letters[:, j]]
    return out.astype(np.float32)


def _bundles(texts: list[str | None], n: int, dims: int) -> np.ndarray:
    """A row per text: the sum of its n-grams' vectors (0 for letterless texts)."""
    out = np.zeros((len(texts), dims), np.float32)
    triples, letters, alphabet = ngram_counts(texts, n)
    if len(triples):
        vectors = ngram_vectors(letters, alphabet, dims)
        ends = np.searchsorted(triples[:, 0], np.arange(len(texts) + 1))
        counts = triples[:, 2].astype(np.float32)
        for i, (s, e) in enumerate(zip(ends[:-1], ends[1:])):
            out[i] = counts[s:e] @ vectors[triples[s:e, 1]]
    return out


def train_prototypes(docs: DataFrame, text: str, label: str, n: int = N, dims: int = DIMS) -> dict[str, np.ndarray]:
    """Language -> bundled prototype, from all rows with a label."""

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for chunk in _chunks(texts):
                own = [langs[i] for i in chunk]
                triples, letters, alphabet = ngram_counts([texts[i] for i in chunk], n)
                if not len(triples):
                    continue
                vectors = ngram_vectors(letters, alphabet, dims)
                names = sorted(set(own))
                of = np.array([names.index(x) for x in own])[triples[:, 0]]
                for k, name in enumerate(names):
                    mine = of == k
                    counts = np.bincount(triples[mine, 1], triples[mine, 2], len(letters))
                    # whole numbers: exact within a chunk, and in doubles across chunks
                    sums[name] = sums.get(name, 0.0) + (counts.astype(np.float32) @ vectors).astype(float)
        for name, v in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([name] * dims), pa.array(np.arange(dims), pa.int32()),
                                              pa.array(np.asarray(v, float))], ["lang", "dim", "value"])

    known = docs.where(qcol(label).isNotNull() & qcol(text).isNotNull()).select(
        qcol(text).alias("text"), qcol(label).cast("string").alias("lang"))
    rows = known.mapInArrow(bundle, "lang string, dim int, value double").groupBy("lang", "dim").agg(
        F.sum("value").alias("value")).groupBy("lang").agg(
        F.array_sort(F.collect_list(F.struct("dim", "value"))).alias("v")).collect()  # languages x dims numbers
    return {r["lang"]: np.array([x["value"] for x in r["v"]]) for r in sorted(rows, key=lambda r: r["lang"])}


def identify(docs: DataFrame, text: str, prototypes: dict[str, np.ndarray], n: int = N,
             dims: int = DIMS) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (the best cosine, 0 to 1)."""
    docs = docs.drop("lang_pred", "score")
    names = sorted(prototypes)
    known = np.array([prototypes[x] / max(np.linalg.norm(prototypes[x]), 1e-30) for x in names]).reshape(-1, dims)

    def guess(texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        found, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
        for chunk in _chunks(texts) if names else ():
            v = _bundles([texts[i] for i in chunk], n, dims).astype(float)
            norm = np.linalg.norm(v, axis=1)
            cosine = v @ known.T / np.maximum(norm, 1e-30)[:, None]
            best = cosine.argmax(axis=1)
            for j, i in enumerate(chunk):
                if norm[j] > 0:
                    found[i], score[i] = names[best[j]], min(1.0, max(0.0, cosine[j, best[j]]))
        return found, score

    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, score = guess(batch.column(place).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string()), pa.array(score)],
                                             [*batch.schema.names, "lang_pred", "score"])

    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])
    return docs.mapInArrow(run, schema)


def fold(key: str | Column, n: int) -> Column:
    """crc32 of the id as text, modulo n (a null id counts as empty text)."""
    c = qcol(key) if isinstance(key, str) else key
    return F.crc32(F.encode(F.coalesce(c.cast("string"), F.lit("")), "UTF-8")) % n


def identified(docs: DataFrame, dims: int = DIMS) -> DataFrame:
    """All documents with predictions of prototypes learnt outside the held-out fold.

    A text in an unlearned script has a cosine of about ``1 / sqrt(dims)`` to a prototype, either way.
    """
    prototypes = train_prototypes(docs.where(fold("doc_id", 4) != 2), "text", "lang", dims=dims)
    return identify(docs, "text", prototypes, dims=dims)


def op5_hyperdimensional_language(spark, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document."""
    docs = table(spark, sf_dir, "documents")
    prototypes = train_prototypes(docs.where(fold("doc_id", 4) != 2), "text", "lang")
    rows = identify(docs.select("doc_id", "text"), "text", prototypes)
    return rows.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")
