"""Benchmark decontamination with a distributed positional inverted index.

``build_index`` stores the postings of all training tokens: each task turns
its documents into segments of about ``segment_words`` words, one row each,
with the segment's sorted term hashes and every term's ascending positions.
Documents lie ``GAP`` positions apart, so no match spans two of them.  No
row is shuffled, a segment is rebuilt alone when its executor is lost, and
the size of a segment is bounded except for a single longer document.

``search`` looks up a test set.  The windows of the test items go to the
tasks in blocks of at most ``block_words`` words (the proven size of each
broadcast; further blocks are further passes over the index).  In a segment,
windows with an absent term are dropped at once; of the others the rarest
term's list is taken, moved back by its place in the window, and intersected
with the next rarest terms' lists until it is empty or exact.

``proximity`` finds the terms of a phrase in order within ``slack`` extra words.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z and are
compared by 64-bit hash.

Defined cases: null and wordless texts have no words, no hits, and are not
contaminated; a wordless item has no window; repeated items each count; an item
without an id hits like any other, but is not listed;
an empty test set hits nothing; repeated documents each get a row; columns
beyond the named ones are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.functions.names import qcol
from tabprep.llm.common import WordHashes, list_array, small_side, store, table, utf8

WINDOW, SEGMENT_WORDS, BLOCK_WORDS = 13, 500_000, 2_000_000
#: Segments that a task writes or reads at once: Parquet's writer holds a row group, by itself of 100 rows at
#: least, and its reader decodes one, so a task's memory would grow with the segments of its input.  Hashes and
#: positions hardly repeat: no dictionaries.
ROW_GROUP = 4
_WRITER = {"parquet.block.row.count.limit": str(ROW_GROUP), "parquet.enable.dictionary": "false"}
GAP = 64  # at least the longest window or phrase with its slack

_KEEP = set(range(0x30, 0x3A)) | set(range(0x61, 0x7B)) | set(range(0x80, 0x100))
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in _KEEP else 0x20 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


INDEX_SCHEMA = ("ids array<long>, text_keys array<long>, starts array<int>, n_words array<int>, "
                "terms array<long>, offsets array<int>, positions array<int>")


def _segment(ids, keys, hashes: list[np.ndarray]) -> pa.RecordBatch:
    n = np.array([len(h) for h in hashes], np.int64)
    starts = np.concatenate([[0], np.cumsum(n + GAP)])[:-1]
    flat = np.concatenate(hashes)
    place = np.arange(len(flat)) + np.repeat(starts - (np.cumsum(n) - n), n)
    order = np.argsort(flat, kind="stable")
    terms, first = np.unique(flat[order], return_index=True)
    parts = [(np.array(ids, object), pa.int64()), (np.array(keys, object), pa.int64()), (starts, pa.int32()),
             (n, pa.int32()), (terms.view(np.int64), pa.int64()), (np.append(first, len(flat)), pa.int32()),
             (place[order], pa.int32())]
    return pa.RecordBatch.from_arrays([list_array([a], k) for a, k in parts],
                                      [p.split()[0] for p in INDEX_SCHEMA.split(", ")])


def build_index(docs: DataFrame, text: str = "text", key: str = "doc_id",
                segment_words: int = SEGMENT_WORDS) -> DataFrame:
    """The stored positional index of all documents: one row a segment."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = WordHashes()
        ids, keys, hashes, held = [], [], [], 0
        for batch in batches:
            for i, k, body in zip(*(c for c in batch.columns)):
                h = hashed(words_of(body.as_py()))
                ids.append(i.as_py()), keys.append(k.as_py()), hashes.append(h)
                held += len(h) + GAP
                if held >= segment_words:
                    yield _segment(ids, keys, hashes)
                    ids, keys, hashes, held = [], [], [], 0
        if ids:
            yield _segment(ids, keys, hashes)

    rows = docs.select(qcol(key).cast("long").alias("id"), F.xxhash64(qcol(text)).alias("k"),
                       utf8(qcol(text)).alias("body"))
    return store(rows.mapInArrow(index, INDEX_SCHEMA), "postings", **_WRITER)


def _blocks(items: DataFrame, key: str, text: str, block_words: int, window: int):
    """The test set's windows in blocks: (hashes, lengths, item ids of each window)."""
    hashed = WordHashes()

    def block(windows):
        terms = np.zeros((len(windows), window), np.uint64)
        for row, w in zip(terms, windows):
            row[:len(w)] = w
        return terms, np.array([len(w) for w in windows]), [sorted(s - {None}) for s in windows.values()]

    windows, held = {}, 0
    for item, body in items.select(qcol(key).cast("string"), utf8(qcol(text))).toLocalIterator():
        h = hashed(words_of(bytes(body))).tolist()
        for i in range(max(1, len(h) - window + 1) if h else 0):
            w = tuple(h[i:i + window])
            windows.setdefault(w, set()).add(item)
            held += len(w)
            if held >= block_words:
                yield block(windows)
                windows, held = {}, 0
    if windows:
        yield block(windows)


def _list(c, i: int, dtype) -> np.ndarray:
    return c[i].values.to_numpy(zero_copy_only=False).astype(dtype, copy=False)


def _starts(terms, offsets, positions, query: np.ndarray, lengths: np.ndarray):
    """(window, ascending start positions) of every window that occurs."""
    if not len(terms):
        return
    at = np.minimum(np.searchsorted(terms, query), len(terms) - 1)
    inside = np.arange(query.shape[1]) < lengths[:, None]
    for w in np.flatnonzero(((terms[at] == query) | ~inside).all(axis=1)):
        slots = at[w, :lengths[w]]
        found = None
        for j in np.argsort(offsets[slots + 1] - offsets[slots], kind="stable"):  # rarest first
            listed = positions[offsets[slots[j]]:offsets[slots[j] + 1]] - j
            if found is None:
                found = listed
            else:
                hit = np.searchsorted(listed, found)
                found = found[(hit < len(listed)) & (listed[np.minimum(hit, len(listed) - 1)] == found)]
            if not len(found):
                break
        if len(found):
            yield w, found


FOUND = ("doc_id long, text_key long, segment long, ordinal int, n_words int, "
         "spans array<struct<start:int,end:int>>, items array<string>")


def search(index: DataFrame, items: DataFrame, key: str = "item_id", text: str = "text",
           window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row a document: its words, hit spans (merged, end exclusive) and items (sorted)."""
    spark = index.sparkSession
    index = index.withColumn("segment", F.monotonically_increasing_id())
    if window + 1 > GAP:
        raise ValueError(f"windows of up to {GAP - 1} words")

    def over(block):
        shared = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            query, lengths, owners = shared.value
            for batch in batches:
                c = {n: batch.column(n) for n in batch.schema.names}
                for i in range(batch.num_rows):
                    starts, n = _list(c["starts"], i, np.int64), _list(c["n_words"], i, np.int64)
                    spans, owned = [[] for _ in n], [set() for _ in n]
                    terms = _list(c["terms"], i, np.int64).view(np.uint64)
                    for w, found in _starts(terms, _list(c["offsets"], i, np.int64),
                                            _list(c["positions"], i, np.int64), query, lengths):
                        doc = np.searchsorted(starts, found, "right") - 1
                        for d, s in zip(doc.tolist(), (found - starts[doc]).tolist()):
                            spans[d].append((s, s + int(lengths[w])))
                            owned[d].update(owners[w])
                    yield pa.RecordBatch.from_arrays([
                        c["ids"][i].values, c["text_keys"][i].values, pa.array([c["segment"][i].as_py()] * len(n), pa.int64()),
                        pa.array(np.arange(len(n)), pa.int32()), pa.array(n, pa.int32()),
                        pa.array([[{"start": a, "end": b} for a, b in merged(s)] for s in spans],
                                 pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                        pa.array([sorted(s) for s in owned], pa.list_(pa.string()))],
                        ["doc_id", "text_key", "segment", "ordinal", "n_words", "spans", "items"])

        return index.mapInArrow(run, FOUND)

    found = [over(b) for b in _blocks(items, key, text, block_words, window)]
    if not found:
        found = [over((np.zeros((0, window), np.uint64), np.zeros(0, np.int64), []))]
    if len(found) == 1:
        return found[0].drop("segment", "ordinal")
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionByName(more)
    rows = rows.groupBy("segment", "ordinal").agg(
        F.first("doc_id").alias("doc_id"), F.first("text_key").alias("text_key"), F.first("n_words").alias("n_words"),
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    join = F.expr("""aggregate(spans, array(cast(null as struct<start:int,end:int>)), (acc, s) ->
        if(element_at(acc, -1) is null or s.start > element_at(acc, -1).end, concat(acc, array(s)),
           concat(slice(acc, 1, size(acc) - 1), array(named_struct('start', element_at(acc, -1).start,
                  'end', greatest(element_at(acc, -1).end, s.end))))))""")
    return rows.withColumn("spans", F.filter(join, lambda s: s.isNotNull())).drop("segment", "ordinal")


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def proximity(index: DataFrame, phrase: str, slack: int) -> DataFrame:
    """(doc_id, start, end): the phrase's words in order, with up to ``slack`` words between them.

    From every place of the first word the earliest continuation is followed,
    so each start has its shortest match.
    """
    query = WordHashes()(words_of(phrase.encode()))
    if not len(query) or len(query) + slack >= GAP:
        raise ValueError(f"a phrase of words that spans under {GAP} words with its slack")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = {n: batch.column(n) for n in batch.schema.names}
            for i in range(batch.num_rows):
                terms = _list(c["terms"], i, np.int64).view(np.uint64)
                offsets, positions = _list(c["offsets"], i, np.int64), _list(c["positions"], i, np.int64)
                starts = _list(c["starts"], i, np.int64)
                at = np.searchsorted(terms, query)
                if (at >= len(terms)).any() or (terms[at] != query).any():
                    continue
                begin = end = positions[offsets[at[0]]:offsets[at[0] + 1]]
                for t in at[1:]:
                    listed = positions[offsets[t]:offsets[t + 1]]
                    nxt = np.searchsorted(listed, end, "right")
                    ok = nxt < len(listed)
                    begin, end = begin[ok], listed[nxt[ok]]
                    ok = end - begin < len(query) + slack
                    begin, end = begin[ok], end[ok]
                doc = np.searchsorted(starts, begin, "right") - 1
                yield pa.RecordBatch.from_arrays(
                    [c["ids"][i].values.take(pa.array(doc)), pa.array(begin - starts[doc], pa.int32()),
                     pa.array(end - starts[doc] + 1, pa.int32())], ["doc_id", "start", "end"])

    return index.mapInArrow(run, "doc_id long, start int, end int")


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Every document's hits, item digest and verdict (a twentieth of its words hit)."""
    found = search(build_index(docs), items)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + (s["end"] - s["start"]))
    return (found.withColumn("n_words", F.col("n_words").cast("long")).withColumn("n_hit", n_hit)
            .withColumn("n_items", F.size("items").cast("long"))
            .withColumn("items_sha256", F.sha2(F.concat_ws(",", "items"), 256))
            .withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))))


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that are not contaminated; rows of equal id and text share the verdict."""
    bad = contamination(docs, items).where("contaminated").select(
        F.col("doc_id").alias("__bad_id"), F.col("text_key").alias("__bad_key")).distinct()
    bad = small_side(bad, "contaminated")
    return docs.join(bad, qcol("doc_id").eqNullSafe(F.col("__bad_id")) & (F.xxhash64("text") == F.col("__bad_key")), "left_anti")


def op7_positional_index(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every document."""
    rows = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return rows.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


_WORDS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
SQL_OP7 = f"""
WITH i AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
q AS (SELECT DISTINCT item, least(len(w), {WINDOW}) AS n, array_to_string(w[k:k + least(len(w), {WINDOW}) - 1], ' ') AS g
  FROM i, unnest(range(1, greatest(len(w) - {WINDOW} + 1, 1) + 1)) u(k) WHERE len(w) > 0),
d AS (SELECT doc_id, row_number() OVER () AS r, {_WORDS} AS w FROM documents),
l AS (SELECT DISTINCT n FROM q),
g AS (SELECT r, n, k, array_to_string(w[k:k + n - 1], ' ') AS g FROM d, l, unnest(range(1, CAST(len(w) - n + 2 AS BIGINT))) u(k)),
m AS (SELECT g.r, g.k, g.n, q.item FROM g JOIN q ON g.g = q.g AND g.n = q.n),
h AS (SELECT r, count(DISTINCT k + o) AS n_hit FROM (SELECT DISTINCT r, k, n FROM m), unnest(range(n)) u(o) GROUP BY r),
s AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM m) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN s USING (r)
"""
