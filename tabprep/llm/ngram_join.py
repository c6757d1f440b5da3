"""N-gram Jaccard join with a tree over count vectors.

A document's set holds the 64-bit hashes of its distinct word shingles.
Dealing the hashes to groups makes it a point: the count in each group.
Two sets with Jaccard similarity t or more differ in at most
``(1 - t) / (1 + t) * (|A| + |B|)`` shingles, hence by no more than that in
the L1 distance of their points, and their overlap is at most the sum of the
coordinates' minima.  The tree has these levels:

1. **Size bands.**  A linked pair's sizes lie in one band or in neighbouring
   ones; a document also enters the next band if a partner can be there.
2. **Cells.**  A band's coordinates form one block more than the largest
   difference, so linked points agree exactly in some block (pigeonhole).
   Points that agree in a block share a cell: a box without extent in that
   block.  This replaces the range boxes of a plain R-tree at this level; those
   do not prune here, because documents of one length have nearly the same
   spread in each coordinate (figures in the README).
3. **Leaves.**  A cell's points, sorted by size, are cut in leaves of
   ``LEAF`` points with bounding boxes; pairs of leaves, then pairs of points,
   are dropped when the summed minima of the upper corners (coordinates)
   cannot reach the similarity.

Pairs that survive are verified on the whole sets.  Only components are
wanted, so a cell first tries each point against its first point; all other
pairs of a cell are tried only where the cell's points are not yet in one
component.  No link between components is lost, and a group of g near copies
costs g tries in its cells, not g * g.  Equal sets are one point throughout.

Defined cases: null, empty and wordless texts have no shingle and are alone;
a text of fewer words than a shingle is one shingle; ids may repeat (each
row gets a result); a null id is never the smallest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabprep.functions.names import qcol
from tabprep.llm.common import WordHashes, drop_stored, list_array, mix64, small_side, store, table, utf8
from tabprep.llm.components import components

SHINGLE, NEAR, OUT_OF = 3, 90, 100
BAND_RATIO, BLOCK_DIMS, COORDS, LEAF, CROWDED = 1.3, 64, 256, 1024, 100
STAR_ROWS, BITMAP_BITS = 2000, 26

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0x94D049BB133111EB, 0xBF58476D1CE4E5B9], np.uint64)


def shingle_hashes(words: np.ndarray, k: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles (fewer words: the sequence as one)."""
    if not len(words):
        return words
    with np.errstate(over="ignore"):
        if len(words) < k:
            out = np.array([len(words)], np.uint64)
            for w in words:
                out = mix64(out * _ODD[0] + w)
            return out
        out = np.zeros(len(words) - k + 1, np.uint64)
        for j in range(k):
            out += mix64(words[j:len(words) - k + 1 + j] + _ODD[7]) * (_ODD[j % 7] + np.uint64(2 * (j // 7)))
    return np.unique(mix64(out))


def set_identity(hashes: np.ndarray) -> int:
    """64-bit identity of a set of hashes; 0 for the empty one."""
    if not len(hashes):
        return 0
    with np.errstate(over="ignore"):
        return int(mix64((mix64(hashes) * _ODD[3]).sum(keepdims=True) + np.uint64(len(hashes)))[0])


def band_tops(limit: int) -> np.ndarray:
    """Largest set size of each band, up to the first that holds ``limit``."""
    tops = [1]
    while tops[-1] < limit:
        tops.append(max(tops[-1] + 1, int(tops[-1] * BAND_RATIO)))
    return np.array(tops, np.int64)


_CONTENT = mix64(np.arange(1, BLOCK_DIMS + 1, dtype=np.uint64) * _ODD[0])


def cells(hashes: np.ndarray, near: int = NEAR, out_of: int = OUT_OF) -> np.ndarray:
    """One 64-bit cell per band that the set enters and block of that band's coordinates."""
    n = len(hashes)
    tops = band_tops(n * out_of // near)
    own = int(np.searchsorted(tops, n))
    found = []
    # coordinate within a block: the low bits; block: by the high bits, so blocks are runs of the sorted hashes
    content = _CONTENT[(hashes & np.uint64(BLOCK_DIMS - 1)).astype(np.int64)]
    high = hashes >> np.uint64(32)
    for band in range(own, len(tops)):
        blocks = 2 * int(tops[band]) * (out_of - near) // (out_of + near) + 1
        block = (high * np.uint64(blocks)) >> np.uint64(32)
        sums = np.zeros(blocks, np.uint64)
        edge = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
        with np.errstate(over="ignore"):
            sums[block[edge].astype(np.int64)] = np.add.reduceat(content, edge)
            found.append(mix64(sums + np.arange(blocks, dtype=np.uint64) * _ODD[1] + np.uint64(band) * _ODD[2]))
    return np.concatenate(found)


def coordinates(hashes: np.ndarray) -> bytes:
    """Counts in ``COORDS`` groups (other bits than the cells use), modulo 256."""
    return np.bincount((hashes >> np.uint64(8)).astype(np.int64) & (COORDS - 1), minlength=COORDS).astype(np.uint8).tobytes()


def most_overlap(a: np.ndarray, b: np.ndarray, n_a, n_b) -> np.ndarray:
    """Sum of the coordinates' minima, ``(n_a + n_b - L1) / 2``, row by row.

    Differences are taken the short way round 256, which can only raise the bound.
    """
    d = a - b
    return (n_a + n_b - np.minimum(d, -d).sum(axis=1, dtype=np.int64)) // 2


SKETCH = "doc_id long, n int, set_id long, cells array<long>, coords binary"


def sketch(docs: DataFrame, text: str, key: str, k: int, near: int, out_of: int) -> DataFrame:
    """A stored row per document: set size, set id; for a batch's first copy of a set, cells and coordinates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = WordHashes()
        none = np.zeros(0, np.uint64)
        for batch in batches:
            size, ids, in_cells, coords, seen = [], [], [], [], set()
            for body in batch.column(1):
                h = shingle_hashes(hashed(body.as_py().lower().split()), k)
                ident = set_identity(h)
                first = len(h) > 0 and ident not in seen
                seen.add(ident)
                size.append(len(h))
                ids.append(ident)
                in_cells.append(cells(h, near, out_of).view(np.int64) if first else none.view(np.int64))
                coords.append(coordinates(h) if first else None)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(size, pa.int32()), pa.array(np.array(ids, np.uint64).view(np.int64)),
                list_array(in_cells, pa.int64()), pa.array(coords, pa.binary())],
                ["doc_id", "n", "set_id", "cells", "coords"])

    rows = docs.select(qcol(key).cast("long").alias("doc_id"), utf8(qcol(text)).alias("body"))
    return store(rows.mapInArrow(run, SKETCH), "sketch")


def _members(sketches: DataFrame) -> DataFrame:
    """(cell, set_id) of the cells with several points: runs of the sorted cells, streamed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell_now = centre_now = last = None
        for batch in batches:
            cell, point = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if not len(cell):
                continue
            new = np.concatenate([[cell_now is None or cell[0] != cell_now], cell[1:] != cell[:-1]])
            at = np.maximum.accumulate(np.where(new, np.arange(len(cell)), -1))
            centre = np.where(at >= 0, point[at], centre_now if centre_now is not None else 0)
            before = np.concatenate([[last if last is not None else 0], point[:-1]])
            keep = (point != centre) & ((point != before) | new)
            # the run's first point comes along with its second
            second = keep & (before == centre)
            cell_now, centre_now, last = cell[-1], centre[-1], point[-1]
            if keep.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([cell[keep], cell[second]])),
                     pa.array(np.concatenate([point[keep], centre[second]]))], ["cell", "set_id"])

    entries = sketches.select(F.explode("cells").alias("cell"), "set_id")
    return store(entries.repartition("cell").sortWithinPartitions("cell", "set_id")
                 .mapInArrow(run, "cell long, set_id long"), "cell-members")


def _stars(members: DataFrame) -> DataFrame:
    """(a, b): each cell's points against its centre, the point that shares most cells with most points.

    The original of a family of near copies agrees with each copy in more
    blocks than the copies among themselves, so it becomes the centre.
    """
    size = members.groupBy("cell").agg(F.count(F.lit(1)).alias("size"))
    degree = members.join(size, "cell").groupBy("set_id").agg(F.sum("size").alias("degree"))
    ranked = members.join(degree, "set_id")
    centre = ranked.groupBy("cell").agg(F.max(F.struct("degree", "set_id")).alias("c")).select("cell", F.col("c.set_id").alias("a"))
    return members.join(centre, "cell").where("a != set_id").select("a", F.col("set_id").alias("b")).distinct()


def _can_reach(n_a, n_b, overlap, near: int, out_of: int):
    return out_of * overlap >= near * (n_a + n_b - overlap)


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint8).reshape(-1, COORDS)


def _bounded(pairs: DataFrame, points: DataFrame, near: int, out_of: int) -> DataFrame:
    """Pairs (a, b) whose summed coordinate minima can reach the similarity."""
    side = lambda x: points.select(F.col("set_id").alias(x), F.col("n").alias(f"n_{x}"), F.col("coords").alias(f"c_{x}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = {n: batch.column(n) for n in batch.schema.names}
            n_a, n_b = c["n_a"].to_numpy().astype(np.int64), c["n_b"].to_numpy().astype(np.int64)
            most = most_overlap(_matrix(c["c_a"].to_pylist()), _matrix(c["c_b"].to_pylist()), n_a, n_b)
            keep = pa.array(_can_reach(n_a, n_b, most, near, out_of))
            yield pa.RecordBatch.from_arrays([c["a"].filter(keep), c["b"].filter(keep)], ["a", "b"])

    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(run, "a long, b long")


def _sets(docs: DataFrame, text: str, key: str, wanted: DataFrame, k: int) -> DataFrame:
    """(set_id, hashes) of the documents with the wanted ids (and of some others).

    A bitmap of fixed size (2 ** BITMAP_BITS bits) of the wanted ids spares
    the other texts the hashing and the shuffle; the caller's join on the
    set sorts out ids that share a bit or repeat.
    """
    bit = F.pmod(F.xxhash64("doc_id"), F.lit(1 << BITMAP_BITS))
    words = wanted.select(F.shiftright(bit, 5).alias("w"), F.call_function("shiftleft", F.lit(1), (bit % 32).cast("int")).alias("b")) \
        .groupBy("w").agg(F.bit_or("b").alias("b")).toPandas()  # at most 2 ** (BITMAP_BITS - 5) rows
    bitmap = np.zeros(1 << (BITMAP_BITS - 5), np.uint32)
    bitmap[words["w"].to_numpy(np.int64)] = words["b"].to_numpy(np.int32).view(np.uint32)
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed, bits = WordHashes(), shared.value
        for batch in batches:
            place = batch.column(1).to_numpy()
            hit = np.flatnonzero((bits[place >> 5] >> (place & 31).astype(np.uint32)) & np.uint32(1))
            for part in np.array_split(hit, max(1, len(hit) // 500)):
                sets = [shingle_hashes(hashed(batch.column(2)[i].as_py().lower().split()), k) for i in part.tolist()]
                ids = np.array([set_identity(s) for s in sets], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids), list_array([s.view(np.int64) for s in sets], pa.int64())], ["set_id", "hashes"])

    rows = docs.select(qcol(key).cast("long").alias("doc_id"), utf8(qcol(text)).alias("body")) \
        .select("doc_id", bit.alias("place"), "body")
    return rows.mapInArrow(run, "set_id long, hashes array<long>")


def _verified(pairs: DataFrame, docs: DataFrame, text: str, key: str, sketches: DataFrame,
              k: int, near: int, out_of: int) -> DataFrame:
    """The pairs (a, b) of set ids whose whole sets reach the similarity.

    Rows are streamed by a: its set first, then its partners' sets.  A point
    with many partners is dealt in parts of about STAR_ROWS partners.
    """
    ids = pairs.select(F.col("a").alias("set_id")).union(pairs.select("b")).distinct()
    holder = store(sketches.where("size(cells) > 0").join(ids, "set_id").groupBy("set_id").agg(
        F.min("doc_id").alias("doc_id")), "holders")
    sets = store(_sets(docs, text, key, holder.select("doc_id"), k).join(holder.select("set_id"), "set_id", "left_semi")
                 .dropDuplicates(["set_id"]), "sets")
    parts = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / STAR_ROWS).cast("int").alias("parts"))
    dealt = pairs.join(parts, "a").withColumn("part", F.pmod(F.hash("b"), F.col("parts")))
    centres = parts.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))) \
        .join(sets.withColumnRenamed("set_id", "a"), "a").select("a", "part", F.lit(None).cast("long").alias("b"), "hashes")
    partners = dealt.select("a", "part", "b").join(sets.withColumnRenamed("set_id", "b"), "b") \
        .select("a", "part", "b", "hashes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, hashes = None, None
        for batch in batches:
            a, b, h = batch.column(0).to_numpy(), batch.column(2), batch.column(3)
            out_a, out_b = [], []
            for i in range(batch.num_rows):
                own = h[i].values.to_numpy()
                if not b[i].is_valid:
                    centre, hashes = a[i], own
                    continue
                assert a[i] == centre
                at = np.minimum(np.searchsorted(hashes, own), len(hashes) - 1)
                both = int((hashes[at] == own).sum())
                if _can_reach(len(own), len(hashes), both, near, out_of):
                    out_a.append(a[i]), out_b.append(b[i].as_py())
            yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], ["a", "b"])

    # sets are sorted as unsigned numbers; compare them as signed ones
    signed = F.array_sort("hashes")
    rows = centres.unionByName(partners).withColumn("hashes", signed)
    links = store(rows.repartition("a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())
                  .mapInArrow(run, "a long, b long"), "links")
    drop_stored(holder, sets)
    return links


def _leaf_pairs(members: DataFrame, points: DataFrame, near: int, out_of: int) -> DataFrame:
    """Pairs in cells that hold several components, by leaves, bounding boxes and points.

    Two points that share several crowded cells are tried in the smallest of them.
    """
    order = Window.partitionBy("cell").orderBy("n", "set_id")
    rows = members.join(points.select("set_id", "n"), "set_id")
    rows = store(rows.withColumn("leaf", F.floor((F.row_number().over(order) - 1) / LEAF).cast("int")), "leaves")
    leaves = rows.groupBy("cell", "leaf").agg(F.min("n").alias("lo"), F.max("n").alias("hi"), F.count(F.lit(1)).alias("m"),
                                              F.min("component").alias("c0"), F.max("component").alias("c1"))
    l, r = leaves.alias("l"), leaves.alias("r")
    pairs = store(l.join(r, (F.col("l.cell") == F.col("r.cell")) & (F.col("l.leaf") <= F.col("r.leaf")))
                  .where("least(l.c0, r.c0) != greatest(l.c1, r.c1)")
                  .where(F.lit(out_of) * F.col("l.hi") >= F.lit(near) * F.col("r.lo")).select(
        F.col("l.cell").alias("cell"), F.col("l.leaf").alias("i"), F.col("r.leaf").alias("j"),
        (F.col("l.m") + F.col("r.m") > CROWDED).alias("crowded")), "leaf-boxes")
    left = rows.withColumnRenamed("leaf", "i").join(pairs, ["cell", "i"]).withColumn("side", F.lit(0))
    right = rows.withColumnRenamed("leaf", "j").join(pairs.where("i < j"), ["cell", "j"]).withColumn("side", F.lit(1))
    narrow = store(left.unionByName(right), "leaf-rows")
    # a set's crowded cells, for the rows in those: at most as many as its cells
    own = narrow.where("crowded").groupBy("set_id").agg(F.array_sort(F.collect_set("cell")).alias("own"))
    dealt = narrow.join(own, "set_id", "left").join(points.select("set_id", "coords"), "set_id").select(
        "cell", "i", "j", "side", "set_id", "component", "n", "coords", F.when(F.col("crowded"), F.col("own")).alias("own"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None  # rows of a pair of leaves that may go on in the next batch
        for batch in batches:
            rows = pa.Table.from_batches([batch] if rest is None else [*rest.to_batches(), batch]).combine_chunks()
            keys = [rows.column(c).to_numpy() for c in ("cell", "i", "j")]
            new = np.flatnonzero(np.concatenate([[True], np.any([k[1:] != k[:-1] for k in keys], axis=0)])) if len(keys[0]) else []
            found = [_leaf_pair(rows.slice(s, e - s), near, out_of) for s, e in zip(new[:-1], new[1:])]
            rest = rows.slice(new[-1]) if len(new) else None
            yield _pairs_batch(found)
        if rest is not None:
            yield _pairs_batch([_leaf_pair(rest, near, out_of)])

    found = store(dealt.repartition("cell", "i", "j").sortWithinPartitions("cell", "i", "j", "side")
                  .mapInArrow(run, "a long, b long").distinct(), "leaf-pairs")
    drop_stored(rows, pairs, narrow)
    return found


def _pairs_batch(found: list[np.ndarray]) -> pa.RecordBatch:
    found = np.concatenate([np.zeros((0, 2), np.int64), *found])
    return pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["a", "b"])


def _leaf_pair(rows: pa.Table, near: int, out_of: int) -> np.ndarray:
    """(a, b) that can link, of two leaves of a cell or of one leaf with itself; at most 2 * LEAF rows."""
    none, cell = np.zeros((0, 2), np.int64), rows.column("cell")[0].as_py()
    m = int((rows.column("side").to_numpy() == 0).sum())
    alone = m == len(rows)
    ids, component, n = (rows.column(c).to_numpy() for c in ("set_id", "component", "n"))
    n, coords, own = n.astype(np.int64), _matrix(rows.column("coords").to_pylist()), rows.column("own").to_pylist()
    r = slice(None) if alone else slice(m, None)
    l = slice(0, m)
    if not alone and coords.max() < 128 and n.max() < 128 * COORDS:  # true counts: compare the boxes
        corner = np.minimum(coords[l].max(axis=0), coords[r].max(axis=0)).sum(dtype=np.int64)
        if not _can_reach(n[l].min(), n[r].min(), corner, near, out_of):
            return none
    todo = component[l][:, None] != component[r][None, :]
    todo &= _can_reach(n[l][:, None], n[r][None, :], np.minimum(n[l][:, None], n[r][None, :]), near, out_of)
    if alone:
        todo = np.triu(todo, 1)
    if own[0] is not None:  # crowded: pairs that share a smaller crowded cell are tried there
        lists = [[c for c in x if c < cell] for x in own]
        kinds, at = np.unique(np.array([c for x in lists for c in x], np.int64), return_inverse=True)
        has = np.zeros((len(lists), len(kinds)), np.float32)
        has[np.repeat(np.arange(len(lists)), [len(x) for x in lists]), at] = 1
        todo &= has[l] @ has[r].T == 0
    x, y = np.nonzero(todo)
    y = y if alone else y + m
    ok = np.zeros(len(x), bool)
    for at in range(0, len(x), 20_000):
        p, q = x[at:at + 20_000], y[at:at + 20_000]
        ok[at:at + 20_000] = _can_reach(n[p], n[q], most_overlap(coords[p], coords[q], n[p], n[q]), near, out_of)
    p, q = ids[x[ok]], ids[y[ok]]
    return np.stack([np.minimum(p, q), np.maximum(p, q)], axis=1)


def jaccard_components(docs: DataFrame, text: str = "text", key: str = "doc_id", k: int = SHINGLE,
                       near: int = NEAR, out_of: int = OUT_OF) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest id reachable) of every row."""
    sketches = sketch(docs, text, key, k, near, out_of)
    points = sketches.where("size(cells) > 0").dropDuplicates(["set_id"]).select("set_id", "n", "coords")
    members = _members(sketches)
    # first each cell's points against its centre
    pairs = store(_bounded(_stars(members), points, near, out_of), "star-pairs")
    links = _verified(pairs, docs, text, key, sketches, k, near, out_of)
    drop_stored(pairs)
    found = store(components(links), "star-components")
    # then the other pairs of cells that still hold several components
    of_cell = members.join(found.select(F.col("node").alias("set_id"), "component"), "set_id", "left") \
        .withColumn("component", F.coalesce("component", "set_id"))
    torn = of_cell.groupBy("cell").agg(F.count(F.lit(1)).alias("m"), F.min("component").alias("c0"),
                                       F.max("component").alias("c1")).where("m > 2 and c0 != c1").select("cell")
    torn_members = store(of_cell.join(torn, "cell"), "torn-cells")
    drop_stored(members)
    if torn_members.limit(1).count():
        rest = _leaf_pairs(torn_members, points, near, out_of)
        if rest.limit(1).count():
            more = _verified(rest, docs, text, key, sketches, k, near, out_of)
            found = store(components(links.union(more)), "components")
        drop_stored(rest)
    # back to documents: equal sets are linked
    own = sketches.where("n > 0").groupBy("set_id").agg(F.min("doc_id").alias("least")) \
        .join(found.select(F.col("node").alias("set_id"), "component"), "set_id", "left") \
        .withColumn("component", F.coalesce("component", "set_id"))
    least = own.groupBy("component").agg(F.min("least").alias("component_id"))
    of_set = own.join(least, "component").select("set_id", "component_id")
    return sketches.join(of_set, "set_id", "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def one_of_each(docs: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """One row of each component; rows without id stay, of rows with one id the first stays."""
    found = jaccard_components(docs, key=key, **options).where("doc_id is not null") \
        .groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"), F.bool_or(F.col("doc_id") == F.col("component_id")).alias("kept")) \
        .where("rows > 1 or not kept")
    odd = store(found.select(F.col("doc_id").alias("__odd_id"), "kept"), "not-alone")
    rest = docs.join(small_side(odd.select("__odd_id"), "odd"), qcol(key) == F.col("__odd_id"), "left_anti")
    twice = docs.join(small_side(odd.where("kept").select("__odd_id"), "twice"), qcol(key) == F.col("__odd_id"), "left_semi")
    return rest.unionByName(twice.dropDuplicates([key]))


def op10_count_vector_join(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    return jaccard_components(table(spark, sf_dir, "documents"))


_W = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
      r"'[^\x20\x09-\x0D]+')")
SQL_OP10 = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_W} AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, CAST(len(w) - 1 AS BIGINT)), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS g FROM d),
c AS (SELECT g, min(doc_id) AS rep, len(g) AS n FROM (SELECT doc_id, list_sort(g) AS g FROM s) WHERE len(g) > 0 GROUP BY g),
e AS (SELECT rep, n, unnest(g) AS x FROM c),
p AS (SELECT a.rep AS u, b.rep AS v FROM e a JOIN e b ON a.x = b.x AND a.rep < b.rep AND 100 * a.n >= 90 * b.n AND 100 * b.n >= 90 * a.n
  GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
l AS (SELECT u, v FROM p UNION ALL SELECT v, u FROM p),
r AS (SELECT rep AS node, rep AS reached FROM c UNION SELECT r.node, l.v FROM r JOIN l ON r.reached = l.u),
m AS (SELECT node, min(reached) AS component FROM r GROUP BY node)
SELECT s.doc_id, CAST(len(s.g) AS BIGINT) AS n_shingles, coalesce(m.component, s.doc_id) AS component_id
FROM s LEFT JOIN c ON list_sort(s.g) = c.g LEFT JOIN m ON m.node = c.rep
"""
