"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes.

1. Every text is tokenised whole: a space and the text by tokenizer A
   (byte-level BPE), the text by tokenizer B (sentence pieces, which adds the
   space itself).  Both token sequences must spell the space and text byte for byte.
2. **Anchors.**  A byte offset where tokens of A and of B both end, and where both
   continue with a token that starts with a space, cuts the document into
   windows.  The windows are short (mostly a word), whatever the document's length.
3. **Windows.**  A window's groups and links depend on its token ids alone, so
   they are found once and remembered by the tuple of both sides' ids (windows of up to
   ``MEMO`` ids in all a task; then it starts afresh).  Windows above ``LONG`` ids
   are aligned, as arrays, but not remembered.
4. **Counts.**  An id pair's count is the number of documents that hold it linked:
   tasks add up their documents' distinct pairs, Spark adds up the tasks.
5. **Look-up.**  Tasks hold the counts of the ``FREQUENT`` most frequent pairs (a
   bounded broadcast); the pairs beyond are looked up by a join.  As the
   frequent ones never enter it, no key is hot.

Tokens overlap in one unbroken byte range, so the ends of A and B together cut a
window into as many pieces as it has links, and each shared end closes a group.

Defined cases: null and empty texts, and texts that A's or B's tokens do not
spell (B normalises some characters, and writes a space as U+2581), have no
tokens: all numbers are 0 and ``groups_sha256`` is empty.  Their rows stay.
Repeated rows each count as a document; null keys are kept; further columns of
the input, whatever their names, are left aside; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.functions.names import qcol
from tabprep.llm.common import list_array, store, table

MEMO, LONG, FREQUENT, FLUSH = 2_000_000, 64, 300_000, 2_000_000
A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: The ranks of A's vocabulary, for the quicker library, and the texts it may take: on these characters both
#: libraries cut words alike (tested one by one); other texts depend on each library's Unicode tables.
A_RANKS, PLAIN = "byte_bpe_50k.tiktoken", re.compile(r"[\t\n\r -~\u00C0-\u024F]*")
#: Fixed value: the word pattern of the byte-level vocabulary.
WORDS = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def vocabulary_path(name: str, folder: str | None = None) -> str:
    """A vocabulary file in ``folder``; by default where this Python keeps its public tokenizers."""
    if folder is not None:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_alphabet() -> dict[str, int]:
    """Printable stand-in -> byte, of byte-level BPE: printable Latin-1 stands for itself, the rest from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Side:
    """A tokenizer with the bytes of its tokens."""

    def __init__(self, spelled: list[bytes]):
        self.spelled = spelled
        self.length = np.array([len(s) for s in spelled], np.int64)
        self.spaced = np.array([s[:1] == b" " for s in spelled], bool)

    def spells(self, ids: list[int], body: bytes) -> bool:
        return b"".join(map(self.spelled.__getitem__, ids)) == body


class ByteLevel(Side):
    """Tokenizer A: byte-level BPE from a ``tokenizers`` file.

    With ``ranks``, the same vocabulary as ``tiktoken`` ranks, texts of ``PLAIN`` characters
    take that library, which gives the same ids four times as fast.
    """

    def __init__(self, path: str, ranks: str | None = None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are plain text
        alphabet = _byte_alphabet()
        ids = self.tokenizer.get_vocab(with_added_tokens=True)
        spelled = [b""] * (max(ids.values()) + 1)
        for entry, i in ids.items():
            spelled[i] = bytes(alphabet[c] for c in entry) if all(c in alphabet for c in entry) else entry.encode()
        super().__init__(spelled)
        self.quick = None
        if ranks is not None:
            import tiktoken

            with open(ranks, "rb") as lines:
                rank = {base64.b64decode(token): int(n) for token, n in map(bytes.split, lines)}
            if any(self.spelled[n] != token for token, n in rank.items()):
                raise ValueError(f"{ranks} is not the vocabulary of {path}")
            self.quick = tiktoken.Encoding("ranks", pat_str=WORDS, mergeable_ranks=rank, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        plain = [self.quick is not None and PLAIN.fullmatch(t) is not None for t in texts]
        rest = iter(self.tokenizer.encode_batch_fast([" " + t for t, p in zip(texts, plain) if not p], add_special_tokens=False))
        return [self.quick.encode_ordinary(" " + t) if p else next(rest).ids for t, p in zip(texts, plain)]


class Pieces(Side):
    """Tokenizer B: sentence pieces with byte fallback."""

    def __init__(self, path: str):
        import sentencepiece

        self.tokenizer = sentencepiece.SentencePieceProcessor(model_file=path)
        super().__init__([self._bytes(i) for i in range(self.tokenizer.get_piece_size())])

    def _bytes(self, i: int) -> bytes:
        piece = self.tokenizer.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.tokenizer.is_byte(i) else piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.tokenizer.encode(texts, num_threads=1)


def align(a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray):
    """(shared ends, linked A positions, linked B positions) of two token sequences over the same bytes."""
    ends = np.union1d(ends_a, ends_b)
    at_a, at_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
    return ends[(ends_a[at_a] == ends) & (ends_b[at_b] == ends)], at_a, at_b


def group_text(a: list[int], b: list[int], ends_a: np.ndarray, ends_b: np.ndarray, shared: np.ndarray) -> str:
    """``a1,a2|b1;a3|b2,b3``: the ids of each group."""
    out, i, k = [], 0, 0
    for j, m in zip((np.searchsorted(ends_a, shared) + 1).tolist(), (np.searchsorted(ends_b, shared) + 1).tolist()):
        out.append(",".join(map(str, a[i:j])) + "|" + ",".join(map(str, b[k:m])))
        i, k = j, m
    return ";".join(out)


class Aligner:
    """Aligns whole documents, window by window."""

    def __init__(self, a: Side, b: Side, memo: int = MEMO, long: int = LONG):
        self.a, self.b, self.limit, self.long = a, b, memo, long
        self.tables = (a.length.tolist(), b.length.tolist(), *([str(i) for i in range(len(s.spelled))] for s in (a, b)))
        self.place: dict[bytes, int] = {}  # both id tuples as packed 32-bit numbers, -1 between them
        self.hits = self.misses = 0
        self._clear()

    def _clear(self):
        self.place.clear()
        self.groups, self.held = [], 0
        self.n_groups, self.pairs, self.start = array("q"), array("q"), array("q", [0])

    def _new(self, packed: bytes) -> int:
        """Align a window that is not remembered; its place in the lists."""
        ids = array("i", packed)
        cut = ids.index(-1)
        if len(ids) <= self.long:
            groups = self._walk(ids, cut)
            self.place[packed] = len(self.groups)
            self.groups.append(";".join(groups))
            self.n_groups.append(len(groups))
        else:
            a, b = ids[:cut].tolist(), ids[cut + 1:].tolist()
            x, y = np.array(a, np.int64), np.array(b, np.int64)
            ends_a, ends_b = self.a.length[x].cumsum(), self.b.length[y].cumsum()
            shared, at_a, at_b = align(x, y, ends_a, ends_b)
            self.groups.append(group_text(a, b, ends_a, ends_b, shared))
            self.n_groups.append(len(shared))
            self.pairs.frombytes(((x[at_a] << 32) | y[at_b]).tobytes())
        self.start.append(len(self.pairs))
        self.misses += 1
        self.held += len(ids)
        return len(self.groups) - 1

    def _walk(self, ids: array, cut: int) -> list[str]:
        """Texts of the groups of A's ids (before ``cut``) and B's (after it); appends the linked pairs."""
        size_a, size_b, text_a, text_b = self.tables
        groups, link = [], self.pairs.append
        i, k = 0, cut + 1
        a, b = ids[0], ids[k]
        end_a, end_b, mine, other = size_a[a], size_b[b], text_a[a], text_b[b]
        while True:
            link((a << 32) | b)
            if end_a < end_b:
                i += 1
                a = ids[i]
                end_a += size_a[a]
                mine = f"{mine},{text_a[a]}"
            elif end_b < end_a:
                k += 1
                b = ids[k]
                end_b += size_b[b]
                other = f"{other},{text_b[b]}"
            else:
                groups.append(f"{mine}|{other}")
                i, k = i + 1, k + 1
                if i == cut:
                    return groups
                a, b = ids[i], ids[k]
                end_a += size_a[a]
                end_b += size_b[b]
                mine, other = text_a[a], text_b[b]

    def __call__(self, texts: list[str | None]) -> list[tuple]:
        """Of each text: (n_a, n_b, n_groups, n_links, digest of the groups, linked pairs, their numbers of links)."""
        out = [(0, 0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int32))] * len(texts)
        some = [i for i, t in enumerate(texts) if t]
        whole = [texts[i] for i in some]
        for i, text, a, b in zip(some, whole, self.a.encode(whole), self.b.encode(whole)):
            body = (" " + text).encode()
            if self.a.spells(a, body) and self.b.spells(b, body):
                out[i] = self._document(a, b)
        return out

    def _document(self, a: list[int], b: list[int]) -> tuple:
        x, y = np.array(a, np.int64), np.array(b, np.int64)
        ends_a, ends_b = self.a.length[x].cumsum(), self.b.length[y].cumsum()
        # ends before space-marked tokens on either side, then those that both sides share
        cut_a, cut_b = ends_a[:-1][self.a.spaced[x[1:]]], ends_b[:-1][self.b.spaced[y[1:]]]
        at = np.minimum(np.searchsorted(cut_b, cut_a), max(len(cut_b) - 1, 0))
        anchors = np.append(cut_a[cut_b[at] == cut_a] if len(cut_b) else cut_a[:0], ends_a[-1])
        if self.held > self.limit:
            self._clear()
        # the windows' ids one after the other: A's, -1, B's
        upto_a, upto_b = np.searchsorted(ends_a, anchors) + 1, np.searchsorted(ends_b, anchors) + 1
        number = np.arange(len(anchors))
        from_a, from_b = np.append(0, upto_a[:-1]), np.append(0, upto_b[:-1])
        ids = np.full(len(a) + len(b) + len(anchors), -1, np.int32)
        ids[np.arange(len(a)) + np.repeat(from_b + number, upto_a - from_a)] = x
        ids[np.arange(len(b)) + np.repeat(upto_a + number + 1, upto_b - from_b)] = y
        packed, ends = ids.tobytes(), ((upto_a + upto_b + number + 1) * 4).tolist()
        windows, lo, known, misses = [], 0, self.place.get, self.misses
        for hi in ends:
            w = known(packed[lo:hi])
            if w is None:
                w = self._new(packed[lo:hi])
            windows.append(w)
            lo = hi
        self.hits += len(windows) - (self.misses - misses)
        digest = hashlib.sha256(";".join([self.groups[w] for w in windows]).encode()).hexdigest()
        kinds, times = np.unique(np.array(windows), return_counts=True)
        start = np.frombuffer(self.start, np.int64)
        n_groups, n_links = np.frombuffer(self.n_groups, np.int64)[kinds], start[kinds + 1] - start[kinds]
        flat = np.arange(n_links.sum()) + np.repeat(start[kinds] - (n_links.cumsum() - n_links), n_links)
        pairs, links = _added(np.frombuffer(self.pairs, np.int64)[flat], np.repeat(times, n_links))
        return len(a), len(b), int(times @ n_groups), int(times @ n_links), digest, pairs, links.astype(np.int32)


def _added(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sums of their ``n``."""
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.diff(keys, prepend=keys[0] - 1)) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(n, first) if len(first) else n


def aligned(docs: DataFrame, text: str = "text", key: str = "doc_id", folder: str | None = None) -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, groups_sha256, pairs, links) of every row, stored.

    ``pairs`` are the distinct linked id pairs (A's id times 2 ** 32 plus B's), ``links`` their numbers.
    """
    a_file, ranks, b_file = (vocabulary_path(name, folder) for name in (A_FILE, A_RANKS, B_FILE))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(ByteLevel(a_file, ranks), Pieces(b_file))
        for batch in batches:
            for at in range(0, batch.num_rows, 100):  # results of 100 documents at a time
                part = batch.slice(at, 100)
                rows = list(zip(*aligner(part.column(1).to_pylist())))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *[pa.array(rows[c], pa.int64()) for c in range(4)], pa.array(rows[4], pa.string()),
                     list_array(rows[5], pa.int64()), list_array(rows[6], pa.int32())],
                    ["_key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "links"])

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(qcol(key).alias("_key"), qcol(text).cast("string").alias("_text")).mapInArrow(
        run, f"_key {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
             "pairs array<long>, links array<int>")
    return store(rows, "aligned")


def pair_counts(rows: DataFrame) -> DataFrame:
    """(pair, n, best): documents that hold the pair, and whether no pair of its A id is in more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def added(parts, numbers):
            keys, n = _added(np.concatenate(parts), np.concatenate(numbers))
            return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], ["pair", "n"])

        parts, numbers, held = [], [], 0
        for batch in batches:
            flat = batch.column(0).flatten().to_numpy(zero_copy_only=False)
            keys, n = np.unique(flat, return_counts=True)
            parts.append(keys), numbers.append(n.astype(np.int64))
            held += len(keys)
            if held > FLUSH:
                yield added(parts, numbers)
                parts, numbers, held = [], [], 0
        if held:
            yield added(parts, numbers)

    counts = rows.select("pairs").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = store(counts.withColumn("a", F.shiftright("pair", 32)), "pair-counts")
    best = counts.groupBy("a").agg(F.max("n").alias("most"))  # one row an id of A: bounded by its vocabulary
    return store(counts.join(F.broadcast(best), "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "pair-best")


def _frequent(counts: DataFrame, most: int):
    """The most frequent pairs, by a count that at most ``most`` pairs reach: sorted pairs, counts, best."""
    floor, held = 1 << 62, 0
    for r in counts.groupBy("n").agg(F.count(F.lit(1)).alias("pairs")).orderBy(F.desc("n")).toLocalIterator():
        held += r["pairs"]
        if held > most:
            break
        floor = r["n"]
    top = counts.where(F.col("n") >= floor).toPandas().sort_values("pair")
    return top["pair"].to_numpy(np.int64), top["n"].to_numpy(np.int64), top["best"].to_numpy(bool), floor


def with_counts(rows: DataFrame, counts: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """``rows`` of ``aligned`` with ``n_best`` and ``count_sum`` instead of pairs and links."""
    *top, floor = _frequent(counts, frequent)
    shared = rows.sparkSession.sparkContext.broadcast(tuple(top))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, n, best = shared.value
        for batch in batches:
            mine, links = (batch.column(c) for c in (6, 7))
            size = np.diff(mine.offsets.to_numpy())
            row = np.repeat(np.arange(batch.num_rows), size)
            key, number = mine.flatten().to_numpy(zero_copy_only=False), links.flatten().to_numpy(zero_copy_only=False)
            at = np.minimum(np.searchsorted(pairs, key), max(len(pairs) - 1, 0))
            known = pairs[at] == key if len(pairs) else np.zeros(len(key), bool)
            count, is_best = np.zeros(len(key), np.int64), np.zeros(len(key), bool)
            count[known], is_best[known] = n[at[known]], best[at[known]]
            add = lambda x: pa.array(_row_sums(x, row, batch.num_rows))
            rare = np.append(0, np.cumsum(np.bincount(row[~known], minlength=batch.num_rows))).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(rare), pa.array(x[~known])) for x in (key, number)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:6], add(number * is_best), add(number * count), *lists],
                                             [*batch.schema.names[:6], "best", "total", "rare", "times"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:6])
    found = rows.mapInArrow(run, f"{kinds}, best long, total long, rare array<long>, times array<int>")
    found = store(found.withColumn("row", F.monotonically_increasing_id()), "aligned-rows")  # storing fixes the row number
    beyond = found.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")) \
        .select("row", F.col("x.rare").alias("pair"), F.col("x.times").alias("times")) \
        .join(counts.where(F.col("n") < floor), "pair").groupBy("row").agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("b"), F.sum(F.col("times") * F.col("n")).alias("t"))
    zero = F.lit(0)
    return found.join(beyond, "row", "left").select(
        *rows.columns[:6], (F.col("best") + F.coalesce("b", zero)).alias("n_best"),
        (F.col("total") + F.coalesce("t", zero)).alias("count_sum"))


def _row_sums(values: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """Exact sums of whole numbers by row."""
    total = np.append(0, np.cumsum(values, dtype=np.int64))
    ends = np.cumsum(np.bincount(row, minlength=n))
    return total[ends] - total[ends - np.bincount(row, minlength=n)]


def token_alignment(docs: DataFrame, text: str = "text", key: str = "doc_id", folder: str | None = None) -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum), one row per row of ``docs``."""
    rows = aligned(docs, text, key, folder)
    return with_counts(rows, pair_counts(rows)).withColumnRenamed("_key", key)


def op11_anchored_token_alignment(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every document."""
    return token_alignment(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
