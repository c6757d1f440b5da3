"""Vector code compression: product codes by exact k-means with norm-of-sum bounds.

Components become integers, ``floor(SCALE * x)``; a vector is cut into ``PARTS``
equal parts, each coded by the index of the nearest of ``ENTRIES`` entries of
the part's codebook.  Codebooks start at the vectors of the smallest ids and are
improved by ``ROUNDS`` rounds of k-means in whole numbers (means rounded down).

Distances to all entries are computed in the first round only.  Afterwards a
part keeps its entry and, for every group of ``GROUP`` neighbouring entries, a
lower bound of its distance to the group's other entries, with the round in
which it was exact (its stamp).  The driver keeps the codebooks of all rounds, so
a bound is lowered by the norm of the sum of its entries' moves since the
stamp, that is by their true net displacement, which is at most (and mostly well
below) the sum of the single moves.  A group is scanned again, exactly, only
if its bound no longer exceeds the exact distance to the own entry; a part that
changes its entry also has the group of the old entry scanned, whose bound
left that entry out.  Bounds are rounded down, and equality scans: ties go to the lower
index as by a full search.

Spark holds the state (a row per vector) as stored tables, one per round.  What reaches the
driver is the codebooks: sums and counts of each entry.

Defined cases: rows whose vector is null or holds null or non-finite components
are dropped; the dimension is that of the smallest id whose vector's length is a
positive multiple of ``parts``, and vectors of other lengths keep a row with null
code and error and take no part; null ids come after all others; repeated ids are
ordered by their vectors; fewer vectors than entries make as many entries; null
labels are one label; an empty table gives an empty result.  Components of 2 ** 15
or more raise an error, as squared distances would leave 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.functions.names import qcol
from tabprep.llm.common import drop_stored, list_array, small_side, store, table

SCALE, PARTS, ENTRIES, ROUNDS, GROUP = 1024, 4, 256, 4, 16
LIMIT = 2 ** 15
SLACK = 1e-9  # relative; far above the rounding of a square root


@dataclass
class Codebooks:
    """The codebooks of every round so far: arrays (parts, entries, width) of whole numbers."""
    history: list

    @property
    def last(self) -> np.ndarray:
        return self.history[-1]

    def text(self) -> str:
        return ",".join(map(str, self.last.ravel().tolist()))

    def sha256(self) -> str:
        return hashlib.sha256(self.text().encode()).hexdigest()

    def net_moves(self) -> np.ndarray:
        """(round, part, group): how far an entry of the group is now from where it was in that round, at most."""
        groups = -(-self.last.shape[1] // GROUP)
        out = np.zeros((len(self.history), len(self.last), groups))
        for t, book in enumerate(self.history):
            moved = np.sqrt(((book - self.last).astype(np.float64) ** 2).sum(axis=2)) * (1 + SLACK)
            for g in range(groups):
                out[t, :, g] = moved[:, g * GROUP:(g + 1) * GROUP].max(axis=1)
        return out

    def decode(self, code: str) -> np.ndarray:
        """The vector that a code stands for, in the scale of the input."""
        digits = code_digits(self.last.shape[1])
        at = [int(code[i:i + digits], 16) for i in range(0, len(code), digits)]
        return np.concatenate([self.last[p][e] for p, e in enumerate(at)]) / SCALE


def code_digits(entries: int) -> int:
    return max(2, len(f"{entries - 1:x}"))


def squared(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances (rows of x, entries) of whole numbers."""
    most = max(np.abs(x).max(initial=0), np.abs(entries).max(initial=0))
    if x.shape[1] * (2 * int(most)) ** 2 < 2 ** 53:  # every term is exact in doubles
        a, b = x.astype(np.float64), entries.astype(np.float64)
        return ((a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)).astype(np.int64)
    return np.stack([((x - e) ** 2).sum(axis=1) for e in entries], axis=1)


def _down(x: np.ndarray) -> np.ndarray:
    """As 32-bit floats, never above ``x``."""
    return np.nextafter((x * (1 - SLACK)).astype(np.float32), np.float32(-np.inf))


FAR = np.int64(2 ** 63 - 1)


def assign(x: np.ndarray, book: np.ndarray, now: int, own=None, bound=None, stamp=None, moves=None):
    """One part of many vectors: (entry, squared distance, bounds, stamps, groups scanned).

    Without ``own`` all groups are scanned.  ``moves`` is (round, group).
    """
    n, groups = len(x), -(-len(book) // GROUP)
    rows = np.arange(n)
    full = np.full((n, len(book)), FAR)
    if own is None:
        scan = np.ones((n, groups), bool)
        bound, stamp = np.zeros((n, groups), np.float32), np.zeros((n, groups), np.int8)
    else:
        near = ((x - book[own]) ** 2).sum(axis=1)
        full[rows, own] = near
        still = bound - moves[stamp, np.arange(groups)]
        scan = ~(np.sqrt(near.astype(np.float64))[:, None] * (1 + SLACK) < still)

    def look(which):
        for g in range(groups):
            at = np.flatnonzero(which[:, g])
            if len(at):
                full[at, g * GROUP:(g + 1) * GROUP] = squared(x[at], book[g * GROUP:(g + 1) * GROUP])

    look(scan)
    new = full.argmin(axis=1)  # the lowest index among equals
    if own is not None:
        left = np.zeros((n, groups), bool)
        left[rows, own // GROUP] = new != own
        left &= ~scan
        look(left)
        scan = scan | left
    best = full[rows, new]
    full[rows, new] = FAR
    for g in range(groups):
        at = np.flatnonzero(scan[:, g])
        least = full[at, g * GROUP:(g + 1) * GROUP].min(axis=1)
        bound[at, g] = np.where(least == FAR, np.float32(np.inf), _down(np.sqrt(least.astype(np.float64))))
        stamp[at, g] = now
    return new, best, bound, stamp, scan.sum(axis=1)


_STATE = "v array<int>, code array<short>, error long, bound array<float>, stamp array<tinyint>, scans int"


def _assigned(state: DataFrame, books: Codebooks) -> DataFrame:
    """The next state: every part at the nearest entry of the last codebooks."""
    shared = state.sparkSession.sparkContext.broadcast((books, books.net_moves()))  # entries x dimension x rounds

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books, moves = shared.value
        parts, entries, width = books.last.shape
        groups, now = -(-entries // GROUP), len(books.history) - 1

        def wide(column, *shape):
            return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, *shape)

        for batch in batches:
            n = batch.num_rows
            x = wide(batch.column(2), parts, width).astype(np.int64)
            code, error, scans = np.zeros((n, parts), np.int16), np.zeros(n, np.int64), np.zeros(n, np.int64)
            if now:
                own = wide(batch.column(3), parts).astype(np.int64)
                bound, stamp = wide(batch.column(5), parts, groups).copy(), wide(batch.column(6), parts, groups).copy()
            else:
                bound, stamp = np.zeros((n, parts, groups), np.float32), np.zeros((n, parts, groups), np.int8)
            for p in range(parts):
                old = (own[:, p], bound[:, p], stamp[:, p], moves[:, p]) if now else ()
                code[:, p], best, bound[:, p], stamp[:, p], seen = assign(x[:, p], books.last[p], now, *old)
                error, scans = error + best, scans + seen
            lists = lambda a, kind: list_array(list(a.reshape(n, -1)), kind)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], lists(code, pa.int16()), pa.array(error), lists(bound, pa.float32()),
                 lists(stamp, pa.int8()), pa.array(scans, pa.int32())], batch.schema.names)

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in state.schema.fields[:2])
    return store(state.mapInArrow(run, f"{kinds}, {_STATE}"), "codes")


def _means(state: DataFrame, book: np.ndarray) -> np.ndarray:
    """The codebooks' next entries: componentwise floor(sum / count); unused entries stay."""
    parts, entries, width = book.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((parts, entries, width), np.int64), np.zeros((parts, entries), np.int64)
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, parts, width)
            code = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, parts)
            for p in range(parts):
                np.add.at(sums[p], code[:, p], x[:, p])
                counts[p] += np.bincount(code[:, p], minlength=entries)
        at = np.flatnonzero(counts.ravel())
        if len(at):
            yield pa.RecordBatch.from_arrays(
                [pa.array(at, pa.int32()), pa.array(counts.ravel()[at]), list_array(list(sums.reshape(-1, width)[at]), pa.int64())],
                ["slot", "n", "sums"])

    partial = state.select("v", "code").mapInArrow(run, "slot int, n long, sums array<long>")
    added = partial.select("slot", "n", F.posexplode("sums").alias("pos", "x")).groupBy("slot", "pos").agg(
        F.sum("x").alias("x"), F.sum("n").alias("n")).toPandas()  # at most entries x dimension rows
    out = book.reshape(-1, width).copy()
    out[added["slot"].to_numpy(), added["pos"].to_numpy()] = added["x"].to_numpy(np.int64) // added["n"].to_numpy(np.int64)
    return out.reshape(book.shape)


def compress(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS,
             entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks]:
    """(rows of key, label, code, error and scans; the codebooks of all rounds)."""
    x = qcol(vector).cast("array<double>")
    finite = F.forall("_x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    whole = lambda c: F.when(F.abs(c) < LIMIT, F.floor(c * SCALE).cast("int")).otherwise(
        F.raise_error(F.lit(f"a component of {LIMIT} or more cannot be coded")).cast("int"))
    kept = vectors.select(qcol(key).alias("_id"), qcol(label).alias("_label"), x.alias("_x")) \
        .where(F.col("_x").isNotNull() & finite).select("_id", "_label", F.transform("_x", whole).alias("v"))
    kept = store(kept, "code-vectors")
    order = [F.col("_id").asc_nulls_last(), F.col("v")]
    fits = (F.size("v") > 0) & (F.size("v") % parts == 0)
    first = kept.where(fits).orderBy(*order).select("v").first()
    if first is None:
        none = kept.select("_id", "_label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"),
                           F.lit(0).alias("scans"))
        return none, Codebooks([np.zeros((parts, 0, 0), np.int64)])
    dimension = len(first["v"])
    same = kept.where(F.size("v") == dimension)
    start = np.array([r["v"] for r in same.orderBy(*order).select("v").limit(entries).collect()], np.int64)
    books = Codebooks([start.reshape(len(start), parts, dimension // parts).transpose(1, 0, 2)])
    nothing = [F.lit(None).cast(part.split()[1]).alias(part.split()[0]) for part in _STATE.split(", ")[1:]]
    state = _assigned(same.select("_id", "_label", "v", *nothing), books)
    for _ in range(rounds):
        books.history.append(_means(state, books.last))
        last, state = state, _assigned(state, books)
        drop_stored(last)
    hexed = F.transform("code", lambda c: F.lower(F.lpad(F.hex(c.cast("long")), code_digits(entries), "0")))
    out = state.select("_id", "_label", F.array_join(hexed, "").alias("code"), "error", "scans")
    other = kept.where(F.size("v") != dimension).select(
        "_id", "_label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"), F.lit(0).alias("scans"))
    return out.unionByName(other), books


def op12_norm_of_sum_codes(spark, sf_dir: str) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of every kept vector."""
    coded, books = compress(table(spark, sf_dir, "embeddings"))
    totals = small_side(coded.groupBy(F.col("_label").alias("_l")).agg(F.sum("error").alias("label_error")), "label-errors")
    return coded.join(totals, F.col("_label").eqNullSafe(F.col("_l"))).select(
        F.col("_id").alias("vec_id"), "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))


def _sql_rounds() -> str:
    """Assignments and means, round after round; a part's nearest entry is the least of distance * ENTRIES + index."""
    steps = []
    for r in range(ROUNDS + 1):
        steps.append(f"""
a{r} AS MATERIALIZED (SELECT vec_id, label, part, any_value(x) AS x, min(
    CAST(list_inner_product(x, x) - 2 * list_inner_product(x, c) + list_inner_product(c, c) AS BIGINT) * {ENTRIES} + entry) AS best
  FROM p JOIN c{r} USING (part) GROUP BY vec_id, label, part)""")
        if r < ROUNDS:
            steps.append(f"""
m{r} AS (SELECT part, best % {ENTRIES} AS entry, pos, sum(x[pos]) AS s, count(*) AS n FROM a{r}, (SELECT unnest(range(1, {{width}} + 1)) AS pos)
  GROUP BY ALL),
c{r + 1} AS MATERIALIZED (SELECT part, entry, coalesce(d.c, c{r}.c) AS c FROM c{r} LEFT JOIN (
  SELECT part, entry, list(floor(s / n) ORDER BY pos) AS c FROM m{r} GROUP BY part, entry) d USING (part, entry))""")
    return ",".join(steps).replace("{width}", "(SELECT max(len(x)) FROM p)")


SQL_OP12 = f"""
WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
k AS (SELECT vec_id, label, list_transform(v, lambda t: floor({SCALE} * t)) AS v FROM e
  WHERE v IS NOT NULL AND list_count(v) = len(v) AND len(list_filter(v, lambda t: NOT isfinite(t))) = 0),
p AS MATERIALIZED (SELECT vec_id, label, part, v[part * len(v) // {PARTS} + 1:(part + 1) * len(v) // {PARTS}] AS x
  FROM k, (SELECT unnest(range({PARTS})) AS part)),
s AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM k QUALIFY entry < {ENTRIES}),
c0 AS MATERIALIZED (SELECT part, entry, x AS c FROM p JOIN s USING (vec_id)),{_sql_rounds()},
h AS (SELECT sha256(string_agg(array_to_string(list_transform(c, lambda t: CAST(t AS BIGINT)), ','), ',' ORDER BY part, entry)) AS books FROM c{ROUNDS}),
o AS (SELECT vec_id, label, string_agg(printf('%02x', best % {ENTRIES}), '' ORDER BY part) AS code,
  CAST(sum(best // {ENTRIES}) AS BIGINT) AS error FROM a{ROUNDS} GROUP BY vec_id, label)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, books AS codebooks_sha256 FROM o, h
"""
