"""Token alignment, vector codes and graph search against direct re-implementations, and their defined cases."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from oracle import compare, duck
from tabprep.llm import graph_search, token_alignment, vector_codes

NAN, INF = float("nan"), float("inf")
ODD = [(1, None, 0), (2, [], 0), (3, [NAN, 1.0], 0), (4, [INF, 1.0], 0), (5, [None, 1.0], 0)]


# ---------------------------------------------------------------- token alignment

@pytest.fixture(scope="module")
def sides():
    path = token_alignment.vocabulary_path
    return token_alignment.ByteLevel(path(token_alignment.A_FILE)), token_alignment.Pieces(path(token_alignment.B_FILE))


def spans(side, ids):
    at, out = 0, []
    for i in ids:
        out.append((at, at + len(side.spelled[i])))
        at = out[-1][1]
    return out


def by_definition(sides, texts):
    """Every number from the tokens' byte ranges, one pair at a time."""
    rows, held = [], Counter()
    for text in texts:
        body = (" " + (text or "")).encode()
        ids = [s.encode([text])[0] for s in sides] if text else [[], []]
        if not text or any(b"".join(s.spelled[i] for i in x) != body for s, x in zip(sides, ids)):
            rows.append(None)
            continue
        (a, b), (ra, rb) = ids, [spans(s, x) for s, x in zip(sides, ids)]
        links, k = [], 0
        for i, (lo, hi) in enumerate(ra):
            while rb[k][1] <= lo:
                k += 1
            m = k
            while m < len(rb) and rb[m][0] < hi:
                links.append((a[i], b[m]))
                m += 1
        shared = sorted({hi for _, hi in ra} & {hi for _, hi in rb})
        groups, last = [], 0
        for end in shared:
            groups.append(",".join(str(i) for i, (lo, hi) in zip(a, ra) if last <= lo and hi <= end) + "|"
                          + ",".join(str(i) for i, (lo, hi) in zip(b, rb) if last <= lo and hi <= end))
            last = end
        rows.append((len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
        held.update(set(links))
    best = {}
    for (a, _), n in held.items():
        best[a] = max(best.get(a, 0), n)
    return [(0, 0, 0, 0, 0, 0, "") if r is None else
            (*r[:3], len(r[3]), sum(held[x] == best[x[0]] for x in r[3]), sum(held[x] for x in r[3]), r[4]) for r in rows]


NUMBERS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
TEXTS = [None, "", " ", "one", "one", "Two  spaces\n\tand tabs", "<|endoftext|> <s> <unk> </s>", "été à la plage, 日本語 😀", "▁ marked",
         "ﬁ ligature", "nul\x00byte", "a" * 500, "x" * 3000 + " " + "the cat sat on the mat " * 200, "trailing ", "  leading", "\r\nline end"]


@pytest.mark.parametrize("frequent", [0, 40, 300_000])
def test_alignment_equals_the_definition(spark, sides, sf, frequent):
    texts = TEXTS + [r[0][:4000] if r[0] else r[0] for r in
                     spark.read.parquet(f"{sf}/documents.parquet").select("text").limit(60).collect()]
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in enumerate(texts)], "doc_id long, text string, n_a int, _key int").repartition(3)
    rows = token_alignment.aligned(docs)
    out = token_alignment.with_counts(rows, token_alignment.pair_counts(rows), frequent).orderBy("_key").collect()
    assert [tuple(r[c] for c in NUMBERS) for r in out] == by_definition(sides, texts)
    assert sum(r["n_a"] > 0 for r in out) > 60 and out[8]["groups_sha256"] == ""


def test_both_libraries_of_tokenizer_a_agree_on_plain_characters(sides, spark, sf):
    quick = token_alignment.ByteLevel(*[token_alignment.vocabulary_path(f) for f in (token_alignment.A_FILE, token_alignment.A_RANKS)])
    plain = [c for c in map(chr, range(0x3000)) if token_alignment.PLAIN.fullmatch(c)]
    assert len(plain) == 3 + 95 + 0x190
    texts = [f"a{c}b {c} {c}{c}1 '{c}'s\n{c}\t {c}  {c}{d}{d}" for c in plain for d in (" ", "x", "7", "'")]
    texts += ["<|endoftext|>", "it's we'll I'D 'S", " \r\n \n", "y" * 4000, "0123456789" * 30, "été " * 99, "日本 text"]
    texts += [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect() if r["text"]]
    assert quick.encode(texts) == sides[0].encode(texts)
    assert sum(token_alignment.PLAIN.fullmatch(t) is not None for t in texts) > 0.9 * len(texts)


def test_windows_are_remembered_and_do_not_change_results(sides):
    text = "the cat sat on the mat and the cat sat on the rug. " * 50
    kept, short, none = (token_alignment.Aligner(*sides, memo=m, long=n) for m, n in ((10_000, 64), (9, 64), (10_000, 0)))
    results = [[x[:5] for t in (text, "a mat " + text) for x in f([t])] for f in (kept, short, none)]
    assert results[0] == results[1] == results[2]
    assert kept.hits > 20 * kept.misses and none.hits == 0
    assert max(len(k) for k in kept.place) <= 4 * 64


def test_alignment_of_null_keys_and_empty_tables(spark):
    docs = spark.createDataFrame([(None, "one two"), (7, "one two"), (7, "one two"), (8, None)], "doc_id long, text string")
    out = token_alignment.token_alignment(docs)
    rows = out.collect()
    assert sorted((str(r["doc_id"]), r["n_a"]) for r in rows) == [("7", 2), ("7", 2), ("8", 0), ("None", 2)]
    assert {r["count_sum"] for r in rows} == {0, 3 * 2}
    assert out.columns[0] == "doc_id" and token_alignment.token_alignment(docs.limit(0)).count() == 0


# ---------------------------------------------------------------- vector codes

def coded_by_definition(x, parts, entries, rounds):
    """Full scans in Python integers."""
    x = np.floor(np.array(x) * 1024).astype(np.int64).reshape(len(x), parts, -1)
    book = x[:entries].transpose(1, 0, 2).copy()
    nearest = lambda: np.stack([((x[:, p, None] - book[p][None]) ** 2).sum(2).argmin(1) for p in range(parts)], 1)
    for _ in range(rounds):
        at = nearest()
        for p in range(parts):
            for e in set(at[:, p].tolist()):
                mine = x[at[:, p] == e, p]
                book[p, e] = mine.sum(0) // len(mine)
    at = nearest()
    return at, ((x - np.stack([book[p][at[:, p]] for p in range(parts)], 1)) ** 2).sum((1, 2)), book


@pytest.mark.parametrize("spread", [0.01, 1.0, 20_000.0])
def test_codes_equal_full_scans(spark, spread):
    rng = np.random.default_rng(3)
    middle = rng.standard_normal((40, 8)) * spread
    x = np.clip(middle[rng.integers(0, 40, 900)] + spread * 0.1 * rng.standard_normal((900, 8)), -30_000, 30_000)
    x[100:130] = x[5]
    df = spark.createDataFrame([(i, v.tolist(), i % 3, 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int, code int")
    out, books = vector_codes.compress(df.repartition(5), entries=48, rounds=4)
    rows = {r["_id"]: r for r in out.collect()}
    at, error, book = coded_by_definition(x, 4, 48, 4)
    assert (books.last == book).all()
    assert [rows[i]["code"] for i in range(900)] == ["".join(f"{e:02x}" for e in r) for r in at.tolist()]
    assert [rows[i]["error"] for i in range(900)] == error.tolist()
    assert np.abs(books.decode(rows[7]["code"]) * 1024 - np.floor(x[7] * 1024)).sum() ** 2 >= error[7]
    # bounds spare most groups: 4 parts of 3 groups would be 12 scans a vector
    assert np.mean([r["scans"] for r in rows.values()]) < 6


def test_net_moves_are_tighter_than_added_moves():
    books = vector_codes.Codebooks([np.full((1, 2, 2), v, np.int64) for v in (0, 50, 20, 5)])
    net = books.net_moves()[0, 0, 0]
    added = sum(np.sqrt(2) * abs(b - a) for a, b in ((0, 50), (50, 20), (20, 5)))
    assert 5 * np.sqrt(2) <= net < 5 * np.sqrt(2) * 1.001 < added


def test_codes_of_odd_rows(spark):
    good = [(i, [float(i), 2.0, -0.5, 0.25], None if i % 2 else 4) for i in range(10, 16)]
    df = spark.createDataFrame(ODD + good + [(12, [9.0, 9.0, 9.0, 9.0], 4), (None, [1.0, 1.0, 1.0, 1.0], 4), (99, [1.0, 2.0], 4),
                                             (98, [1.0], 4)], "vec_id long, embedding array<double>, label int")
    out, books = vector_codes.compress(df)
    rows = out.collect()
    assert sorted(str(r["_id"]) for r in rows) == sorted(map(str, [2, 10, 11, 12, 12, 13, 14, 15, 98, 99, None]))
    assert {str(r["_id"]) for r in rows if r["code"] is None} == {"2", "98", "99"}
    assert {r["error"] for r in rows if r["code"]} == {0} and books.last.shape == (4, 8, 1)
    for none in (df.limit(0), spark.createDataFrame(ODD, df.schema)):
        out, books = vector_codes.compress(none)
        assert out.where("code IS NOT NULL").count() == 0 and books.text() == ""


def test_op12_matches_sql(spark, sf):
    assert compare(vector_codes.op12_norm_of_sum_codes(spark, sf), duck(sf), vector_codes.SQL_OP12) == []


# ---------------------------------------------------------------- graph search

def recall(rows, x, ids, queries, k=10):
    found, want = {}, 0
    for r in rows:
        found.setdefault(r["query_id"], []).append(r)
    hit = 0
    for q in queries:
        i = ids.index(q)
        d = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
        d[i] = np.inf
        limit = np.sort(d)[:k][-1]
        got = sorted(found[q], key=lambda r: r["rank"])
        assert [r["rank"] for r in got] == list(range(1, k + 1))
        assert [(r["score"], r["vec_id"]) for r in got] == sorted((r["score"], r["vec_id"]) for r in got)
        for r in got:
            assert r["vec_id"] != q and r["score"] == pytest.approx(d[ids.index(r["vec_id"])], rel=1e-12)
        hit, want = hit + sum(r["score"] <= limit * (1 + 1e-12) for r in got), want + k
    return hit / want


@pytest.mark.parametrize("shards", [1, 4])
def test_recall_on_the_given_vectors(spark, monkeypatch, shards):
    monkeypatch.setattr(graph_search, "shards_of", lambda rows: shards)
    path = "/root/testdata/sf0.1/embeddings.parquet"
    data = spark.read.parquet(path).orderBy("vec_id").toPandas()
    out = graph_search.nearest_neighbours(spark.read.parquet(path), F.col("id") % 100 == 0).collect()
    ids = data["vec_id"].tolist()
    found = recall(out, np.array(data["embedding"].tolist(), float), ids, [i for i in ids if i % 100 == 0])
    print(f"recall at 10, {len(ids)} vectors, {shards} shards: {found:.4f}")
    assert found >= 0.97


def test_recall_on_separate_clusters_and_unclustered_vectors():
    rng = np.random.default_rng(1)
    clustered = rng.standard_normal((150, 32))[rng.integers(0, 150, 4000)] + 0.01 * rng.standard_normal((4000, 32))
    for x in (clustered, rng.standard_normal((4000, 32))):
        q, node, d = graph_search.Graph(x).build().nearest(x[::40])
        hit = 0
        for i, row in enumerate(range(0, 4000, 40)):
            best = np.sort(np.delete(np.sqrt(((x - x[row]) ** 2).sum(axis=1)), row))[:10]
            hit += (np.sort(d[(q == i) & (node != row)])[:10] <= best[-1] * (1 + 1e-12)).sum()
        assert hit / 1000 >= 0.95


def test_pruning_keeps_diverse_edges():
    x = np.array([[0, 0], [1, 0], [1.1, 0], [1.2, 0.1], [0, 3], [-5, 0]], float)
    graph = graph_search.Graph(x)
    pool = np.array([[1, 2, 3, 4, 5, 2]], np.int32)
    kept = graph.prune(np.array([0]), pool, graph._distances(np.array([0]), pool), 1.2)[0]
    assert set(kept[kept >= 0].tolist()) == {1, 4, 5}


def test_graph_copies_ties_and_odd_rows(spark):
    rows = ODD + [(6, [0.0, 0.0], 0)] + [(i, [1.0, 1.0], 0) for i in range(100, 400)] + \
        [(400, [1.0, -0.0], 0), (401, [1.0, 0.0], 0), (None, [1.0, 0.0], 0), (500, [1.0, 0.0, 0.0], 0), (600, [1e200, 1e200], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("row", F.lit(1)).repartition(4)
    out = graph_search.nearest_neighbours(df, F.col("id") % 100 == 0)
    got = {}
    for r in out.orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert [v for v, _ in got[100]] == list(range(101, 111)) and [v for v, _ in got[200]] == list(range(100, 110))
    assert [v for v, _ in got[400]] == [401, None, *range(100, 108)] and got[400][2][1] == 1.0
    assert 500 not in got and got[600][0][1] == pytest.approx(2 ** 0.5 * 1e200)
    few = graph_search.nearest_neighbours(df.where("vec_id >= 398"), F.col("id") % 100 == 0).where("query_id = 400").collect()
    assert [r["vec_id"] for r in few] == [401, 398, 399, 600]
    assert graph_search.nearest_neighbours(df.limit(0), F.col("id") % 100 == 0).count() == 0
    twice = spark.createDataFrame([(100, [1.0, 0.0]), (100, [0.0, 1.0]), (7, [0.0, 2.0])], "vec_id long, embedding array<double>")
    assert sorted((r["rank"], r["vec_id"], r["score"]) for r in
                  graph_search.nearest_neighbours(twice, F.col("id") % 100 == 0).collect()) == \
        [(1, 7, 1.0), (1, 100, 2 ** 0.5), (2, 7, 5 ** 0.5), (2, 100, 2 ** 0.5)]


def test_graphs_do_not_depend_on_partitions(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = graph_search.usable(df, "vec_id", "embedding")
    first, second = (sorted((r["shard"], r["point"], r["edges"]) for r in
                            graph_search.build_graphs(x, 3).select("shard", "point", "edges").collect())
                     for x in (rows, rows.repartition(7)))
    assert first == second
