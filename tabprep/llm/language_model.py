"""Language-model scores of whole documents.

1. **Counts.**  Each task counts its training words; Spark adds them up by
   64-bit word hash.  The table grows with the corpus and stays distributed.
2. **Model.**  The ``gru.LISTED`` most frequent words (the end of a text is
   one) are the model's words, in classes by frequency; every other word
   belongs to one of ``SHAPES`` classes by its shape, within which its
   probability is its add-half count share, with one share for all unseen
   words.  So the model is a proper distribution over all tokens.
3. **Training.**  ``ROUNDS`` rounds of local training with averaging.  Each
   training document belongs whole to one round and to one shard of about
   ``SHARD_TOKENS`` tokens, by hashes of id and text; every shard trains a copy of the
   model on its documents in the order of their ids, with the state carried
   through each document, and the copies are averaged by tokens, in groups of
   at most ``FAN_IN``, until few are left.  How the input is partitioned does not
   matter.
4. **Scores.**  Tasks hold the counts of the ``COUNTED`` most frequent words
   (a bounded broadcast) and score their documents whole.  The words beyond
   are looked up by a join on the hash; as the frequent ones never enter it,
   no key is hot.

Defined cases: null and empty texts are the end token alone; with no training
text every token is unseen; repeated rows count and are scored each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabprep.functions.names import qcol
from tabprep.llm.common import list_array, store, table, utf8
from tabprep.llm.gru import LISTED, Gru
from tabprep.llm.language import fold

END = b"\n"  # no word holds white space
SHAPES, COUNTED, ROUNDS, FAN_IN, FLUSH = 12, 200_000, 3, 32, 300_000
RATE = 0.04  # of the first round
#: Tokens of a shard of a round, of a training call, and scored together.
SHARD_TOKENS, TRAINED_AT_ONCE, SCORED_AT_ONCE = 1_500_000, 600_000, 2_500_000
#: Bytes of texts whose words are looked up together.
TEXT_AT_ONCE = 2_000_000


def words_of(text: bytes) -> list[bytes]:
    words = text.lower().split()
    words.append(END)
    return words


#: Of a last byte: a letter or digit, a full stop or comma, another sign.
_ENDS = [0 if b >= 0x80 or chr(b).isalnum() else 1 if b in b".," else 2 for b in range(256)]


def shape_of(word: bytes) -> int:
    """Class of a word beyond the list: last byte, script, length."""
    return _ENDS[word[-1]] + (0 if word.isascii() else 3) + (6 if len(word) > 8 else 0)


def _hash(word: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(word)


class _Words:
    """The words of some texts: ``distinct`` (binary), the number of each in ``ids``, the texts' ``lengths`` without ends."""

    def __init__(self, texts: pa.Array):
        lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.cast(pa.string())))
        words = lists.flatten()
        full = pc.binary_length(words).to_numpy() > 0  # white space at a text's ends leaves empty words
        ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        self.lengths = np.diff(np.concatenate([[0], np.cumsum(full)])[ends])
        coded = words.filter(pa.array(full)).dictionary_encode()
        self.distinct, self.ids = coded.dictionary.cast(pa.large_binary()), coded.indices.to_numpy()

    def _bytes(self) -> tuple[np.ndarray, pa.Buffer]:
        """(ends of the distinct words, with a 0 before them, and their bytes)."""
        if not len(self.distinct):
            return np.zeros(1, np.int64), b""
        return np.frombuffer(self.distinct.buffers()[1], np.int64)[self.distinct.offset:][:len(self.distinct) + 1], self.distinct.buffers()[2]

    def hashes(self) -> np.ndarray:
        import xxhash

        ends, data = self._bytes()
        data, ends = memoryview(data), ends.tolist()
        found = map(xxhash.xxh64_intdigest, (data[s:e] for s, e in zip(ends, ends[1:])))
        return np.fromiter(found, np.uint64, len(ends) - 1).view(np.int64)

    def shapes(self) -> np.ndarray:
        """``shape_of`` each distinct word."""
        ends, data = self._bytes()
        data = np.frombuffer(data, np.uint8)
        beyond = np.concatenate([[0], np.cumsum(data >= 0x80)])[ends]
        return np.array(_ENDS)[data[ends[1:] - 1]] + 3 * (np.diff(beyond) > 0) + 6 * (np.diff(ends) > 8)


def _texts(column: pa.Array, at_once: int) -> Iterator[pa.Array]:
    """Slices of whole texts of about ``at_once`` bytes."""
    size = pc.cumulative_sum(pc.binary_length(column).cast(pa.int64())).to_numpy()
    edge = np.flatnonzero(np.diff(size // at_once)) + 1
    for s, e in zip([0, *edge], [*edge, len(column)]):
        if e > s:
            yield column.slice(s, e - s)


def _summed(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """(hashes, shapes, counts) with a row a hash."""
    word, shape, n = (np.concatenate(c) for c in zip(*parts))
    order = np.argsort(word, kind="stable")
    word = word[order]
    first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
    return word[first], shape[order][first], np.add.reduceat(n[order], first)


def count_words(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, shape, n): counts of every word of all texts, by signed 64-bit hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = lambda *columns: pa.RecordBatch.from_arrays(
            [pa.array(c, kind) for c, kind in zip(columns, (pa.int64(), pa.int32(), pa.int64()))], ["word", "shape", "n"])
        parts, held, ends = [], 0, 0
        for batch in batches:
            ends += batch.num_rows
            for texts in _texts(batch.column(0), TEXT_AT_ONCE):
                words = _Words(texts)
                if len(words.distinct):
                    parts.append((words.hashes(), words.shapes(), np.bincount(words.ids, minlength=len(words.distinct))))
                    held += len(words.distinct)
                if held > 2 * FLUSH:
                    parts = [_summed(parts)]
                    held = len(parts[0][0])
                    if held > FLUSH:
                        yield row(*parts[0])
                        parts, held = [], 0
        if parts:
            yield row(*_summed(parts))
        if ends:
            yield row(np.array([_hash(END)], np.uint64).view(np.int64), [shape_of(END)], [ends])

    found = docs.select(utf8(qcol(text))).mapInArrow(run, "word long, shape int, n long")
    return store(found.groupBy("word", "shape").agg(F.sum("n").alias("n")), "word-counts")


class Vocabulary:
    """What tasks know of the corpus: frequent words' counts, the listed words, totals."""

    def __init__(self, counts: DataFrame):
        total = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()
        self.tokens, self.kinds = total["n"] or 0, total["v"]
        end = np.array([_hash(END)], np.uint64).view(np.int64)[0]
        # the most frequent words, by a count that at most COUNTED words reach
        floor, held = 1 << 62, 0
        for r in counts.groupBy("n").agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("n")).toLocalIterator():
            held += r["words"]
            if held >= COUNTED:
                break
            floor = r["n"]
        top = counts.where((F.col("n") >= floor) | (F.col("word") == int(end))).toPandas()
        top = top.assign(end=top["word"] == end).sort_values(["end", "n", "word"], ascending=[False, False, True])
        listed = top.head(LISTED)
        self.listed = {int(w): i for i, w in enumerate(listed["word"])}
        self.listed_n = listed["n"].to_numpy(np.int64)
        order = np.argsort(top["word"].to_numpy(np.int64))
        self.words, self.n = top["word"].to_numpy(np.int64)[order], top["n"].to_numpy(np.int64)[order]
        shapes = {r["shape"]: r for r in counts.groupBy("shape").agg(
            F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect()}
        n = np.array([shapes[s]["n"] if s in shapes else 0 for s in range(SHAPES)], np.int64)
        v = np.array([shapes[s]["v"] if s in shapes else 0 for s in range(SHAPES)], np.int64)
        self.shape_n = n - np.bincount(listed["shape"], listed["n"], SHAPES).astype(np.int64)
        self.shape_v = v - np.bincount(listed["shape"], minlength=SHAPES)

    def model(self) -> Gru:
        return Gru(SHAPES).biases(self.listed_n, self.shape_n)


class _Lookup:
    """Token, hash and count of every word and end of texts."""

    def __init__(self, vocabulary: Vocabulary):
        self.words, self.n = vocabulary.words, vocabulary.n  # by hash, at most COUNTED
        self.token = np.full(len(self.words), -1, np.int64)
        listed = np.fromiter(vocabulary.listed, np.int64, len(vocabulary.listed))
        self.token[np.searchsorted(self.words, listed)] = np.fromiter(vocabulary.listed.values(), np.int64, len(listed))
        end = np.array([_hash(END)], np.uint64).view(np.int64)
        self.end = [int(x[0]) for x in self._of(end, np.array([shape_of(END)]))]

    def _of(self, hashes: np.ndarray, shapes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        token, n = LISTED + shapes, np.full(len(hashes), -1, np.int64)
        if len(self.words):
            at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
            known = self.words[at] == hashes
            n[known] = self.n[at[known]]
            token = np.where(known & (self.token[at] >= 0), self.token[at], token)
        return token, n, hashes

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(first places of the texts and the end, tokens, counts or -1, hashes) of the texts, one after another."""
        words = _Words(texts)
        ends = np.cumsum(words.lengths + 1)
        is_word = np.ones(ends[-1], bool)
        is_word[ends - 1] = False
        found = []
        for of_word, of_end in zip(self._of(words.hashes(), words.shapes()), self.end):
            every = np.full(len(is_word), of_end, np.int64)
            every[is_word] = of_word[words.ids]
            found.append(every)
        return np.concatenate([[0], ends]), *found


def train(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", key: str = "doc_id",
          rounds: int = ROUNDS) -> Gru:
    """The averaged model after all rounds."""
    spark, model = docs.sparkSession, vocabulary.model()
    words = spark.sparkContext.broadcast(vocabulary)
    turn = F.pmod(F.xxhash64(qcol(key), F.lit("round")), F.lit(rounds))
    shards = 1 + vocabulary.tokens // (rounds * SHARD_TOKENS)
    shard = F.pmod(F.xxhash64(qcol(key), qcol(text), F.lit("shard")), F.lit(shards)).cast("int")
    kind = docs.schema[key].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = _Lookup(words.value)
        for batch in batches:
            at = 0
            for texts in _texts(batch.column(2), TEXT_AT_ONCE):
                places, tokens, _, _ = look(texts)
                own, at = batch.slice(at, len(texts)), at + len(texts)
                yield pa.RecordBatch.from_arrays([own.column(0), own.column(1), pa.ListArray.from_arrays(
                    pa.array(places, pa.int32()), pa.array(tokens, pa.int16()))], ["shard", "_key", "tokens"])

    for r in range(rounds):
        sent = spark.sparkContext.broadcast(model.flat())
        rate = RATE / (1 + r)

        def run(batches: Iterator[pa.RecordBatch], sent=sent, rate=rate) -> Iterator[pa.RecordBatch]:
            place, own, tokens, pieces, held = None, None, 0, [], 0
            for batch in batches:  # a partition may hold several shards, one after another
                for at, ids in zip(batch.column(0).to_pylist(), batch.column(1)):
                    if at != place:
                        if place is not None:
                            yield _row(place, own.train(pieces, rate), tokens)
                        place, own, tokens, pieces, held = at, Gru(SHAPES).load(sent.value), 0, [], 0
                    piece = ids.values.to_numpy().astype(np.int64)
                    pieces.append(piece)
                    tokens, held = tokens + len(piece), held + len(piece)
                    if held >= TRAINED_AT_ONCE:
                        own.train(pieces, rate)
                        pieces, held = [], 0
            if place is not None:
                yield _row(place, own.train(pieces, rate), tokens)

        part = docs.where(turn == r).select(shard.alias("shard"), qcol(key).alias("_key"), utf8(qcol(text)))
        dealt = part.mapInArrow(encode, f"shard int, _key {kind}, tokens array<short>").repartition(shards, "shard") \
            .sortWithinPartitions("shard", "_key", F.xxhash64("tokens")).select("shard", "tokens")
        copies = store(dealt.mapInArrow(run, _COPY), "gru-copies")
        n = copies.count()
        while n > FAN_IN:  # copies of FAN_IN neighbouring shards at a time
            copies = store(copies.withColumn("place", F.floor(F.col("place") / FAN_IN).cast("int"))
                           .groupBy("place").applyInPandas(_add, _COPY), "gru-copies")
            n = copies.count()
        rows = copies.collect()  # at most FAN_IN
        if rows:
            model.load(sum(np.array(x["flat"]) for x in sorted(rows, key=lambda x: x["place"])) / sum(x["tokens"] for x in rows))
    return model


_COPY = "place int, flat array<double>, tokens long"


def _row(place: int, copy: Gru, tokens: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        pa.array([place], pa.int32()), list_array([copy.flat().astype(np.float64) * tokens], pa.float64()),
        pa.array([tokens], pa.int64())], ["place", "flat", "tokens"])


def _add(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("place")
    return pd.DataFrame({"place": [int(pdf["place"].iloc[0])], "flat": [np.sum(np.array(pdf["flat"].tolist()), axis=0)],
                         "tokens": [int(pdf["tokens"].sum())]})


def score(docs: DataFrame, counts: DataFrame, vocabulary: Vocabulary, model: Gru, text: str = "text",
          key: str = "doc_id") -> DataFrame:
    """(key, n_tokens, n_known, base_score, score), one row per document."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((vocabulary, model.flat()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, flat = shared.value
        look, gru = _Lookup(v), Gru(SHAPES).load(flat)
        whole = np.log10(v.tokens + 0.5 * (v.kinds + 1))
        of_shape = np.log10(v.shape_n + 0.5 * (v.shape_v + 1))

        def scored(keys, tokens, sums, rare):
            s = np.concatenate(sums)
            own = gru.score(tokens) / np.log(10) + s[:, 3]
            return pa.RecordBatch.from_arrays([
                pa.concat_arrays(keys), pa.array(s[:, 0].astype(np.int64)), pa.array(s[:, 1].astype(np.int64)),
                pa.array(s[:, 2]), pa.array(own), list_array(rare, pa.int64())],
                ["_key", "n_tokens", "n_common", "base", "own", "rare"])

        # long documents cost a step a token: many documents share the steps
        keys, tokens, sums, rare, held = [], [], [], [], 0
        for batch in batches:
            at = 0
            for texts in _texts(batch.column(1), TEXT_AT_ONCE):
                places, token, n, word = look(texts)
                known, beyond = n >= 0, token >= LISTED
                logs = np.log10(np.where(known, n, 0) + 0.5)
                per = lambda x: np.add.reduceat(x, places[:-1])  # noqa: B023, E731
                size = np.diff(places)
                # within their shape: log10(n + 0.5) less the shape's total; rare words' n follows by join
                within = per(np.where(beyond, np.where(known, logs, 0) - of_shape[np.where(beyond, token - LISTED, 0)], 0))
                sums.append(np.stack([size, per(known.astype(np.int64)), per(np.where(known, logs, 0)) - whole * size, within], axis=1))
                keys.append(batch.column(0).slice(at, len(texts)))
                at += len(texts)
                tokens += np.split(token.astype(np.int16), places[1:-1])
                rare += np.split(word[~known], np.cumsum(per((~known).astype(np.int64)))[:-1])
                held += len(token)
                if held >= SCORED_AT_ONCE:
                    yield scored(keys, tokens, sums, rare)
                    keys, tokens, sums, rare, held = [], [], [], [], 0
        if keys:
            yield scored(keys, tokens, sums, rare)

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(qcol(key).alias("_key"), utf8(qcol(text)).alias("body")).mapInArrow(
        run, f"_key {kind}, n_tokens long, n_common long, base double, own double, rare array<long>")
    rows = store(rows.withColumn("row", F.monotonically_increasing_id()), "lm-rows")  # the row number is fixed by storing
    rare = rows.select("row", F.explode("rare").alias("word")).join(counts.select("word", "n"), "word", "left") \
        .groupBy("row").agg(F.sum(F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("logs"), F.count("n").alias("found"))
    out = rows.drop("rare").join(rare, "row", "left")
    logs = F.coalesce("logs", F.lit(0.0))
    return out.select(F.col("_key").alias(key), "n_tokens", (F.col("n_common") + F.coalesce("found", F.lit(0))).alias("n_known"),
                      (F.col("base") + logs).alias("base_score"), (F.col("own") + logs).alias("score"))


def language_model_scores(docs: DataFrame, train_on: Column, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Scores of all documents by a model of those that ``train_on`` selects."""
    training = docs.where(train_on)
    counts = count_words(training, text)
    vocabulary = Vocabulary(counts)
    model = train(training, vocabulary, text, key)
    return score(docs, counts, vocabulary, model, text, key).withColumn("train_tokens", F.lit(vocabulary.tokens).cast("long"))


def op9_gru_language_model(spark, sf_dir: str) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = language_model_scores(docs, fold("doc_id", 5) != 1)
    return scored.select("doc_id", (fold("doc_id", 5) == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                         "base_score", "score")
