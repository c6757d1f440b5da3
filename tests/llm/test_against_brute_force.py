"""Operators against SQL twins, direct re-implementations and held-out accuracy."""

import glob
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from oracle import compare, duck
from pyspark.sql import functions as F

from tabprep.llm import (common, decontaminate, embedding_dedup, gru, language, language_model, mixing, ngram_join, queries,
                         sharding, substring_dedup)

TWINS = {n: sql for n, (_, sql) in queries.REGISTRY.items() if sql}


@pytest.mark.parametrize("name", sorted(TWINS))
def test_twin(spark, sf, name):
    assert compare(queries.REGISTRY[name][0](spark, sf), duck(sf), TWINS[name]) == []


def _words(rng, n, kinds=4000):
    return [f"w{int(kinds * rng.random() ** 2)}" for _ in range(n)]


def _edited(rng, words, edits):
    out = list(words)
    for _ in range(edits):
        out[rng.randrange(len(out))] = f"x{rng.random():.9f}"
    return out


# ---------------------------------------------------------------- 10: n-gram join

def _components(ids, linked):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in linked:
        a, b = find(i), find(j)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("leaf", [4, 1024])
def test_near_copy_families(spark, monkeypatch, leaf):
    """Families around the threshold: every link found, by whole components; small leaves too."""
    monkeypatch.setattr(ngram_join, "LEAF", leaf)
    rng, rows = random.Random(3), []
    for family in range(8):
        base = _words(rng, 20 + 45 * family)
        for copy in range(14):
            text = _edited(rng, base, rng.randrange(0, 2 + len(base) // 40))
            rows.append((len(rows), " ".join(text)))
    rows += [(1000 + i, " ".join(_words(rng, n))) for i, n in enumerate([1, 1, 2, 2, 3, 4, 300, 300])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    sets = {}
    for i, t in rows:
        w = t.split()
        sets[i] = {tuple(w[j:j + 3]) for j in range(len(w) - 2)} if len(w) >= 3 else {tuple(w)}
    ids = [i for i, _ in rows]
    linked = [(i, j) for i in ids for j in ids if i < j
              and 100 * len(sets[i] & sets[j]) >= 90 * len(sets[i] | sets[j])]
    want = _components(ids, linked)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.jaccard_components(docs).collect()}
    assert got == {i: (len(sets[i]), want[i]) for i in ids}
    assert len(set(want.values())) > 12 and len(linked) > 100


def test_cells_are_exact():
    """Linked sets share a cell whatever their sizes are."""
    rng = np.random.default_rng(1)
    for n in (1, 5, 9, 10, 11, 40, 97, 98, 500):
        a = np.unique(rng.integers(0, 2 ** 63, n).astype(np.uint64))
        for change in range(n // 19 * 2 + 2):
            b = np.unique(np.concatenate([a[min(change, n - 1):], rng.integers(0, 2 ** 63, change // 2).astype(np.uint64)]))
            if 100 * len(np.intersect1d(a, b)) >= 90 * len(np.union1d(a, b)):
                assert set(ngram_join.cells(a)) & set(ngram_join.cells(b))
                ca, cb = (np.frombuffer(ngram_join.coordinates(x), np.uint8)[None] for x in (a, b))
                assert ngram_join.most_overlap(ca, cb, len(a), len(b))[0] >= len(np.intersect1d(a, b))


# ---------------------------------------------------------------- 7: decontamination

def test_blocks_and_proximity(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    index = decontaminate.build_index(docs, segment_words=20_000)
    digest = lambda df: sorted((r["doc_id"], r["n_words"], [tuple(s) for s in r["spans"]], r["items"]) for r in df.collect())
    one, many = digest(decontaminate.search(index, items)), digest(decontaminate.search(index, items, block_words=3000))
    assert one == many and any(x[2] for x in one)

    texts = [(1, "a x x b c"), (2, "a b y y y c"), (3, "c b a"), (4, "a a b c b c")]
    small = decontaminate.build_index(spark.createDataFrame(texts, "doc_id long, text string"))
    got = sorted(tuple(r) for r in decontaminate.proximity(small, "A b! c", slack=2).collect())
    assert got == [(1, 0, 5), (4, 0, 4), (4, 1, 4)]


def test_a_task_holds_few_segments_at_once(spark):
    docs = spark.range(40).selectExpr("id AS doc_id", "repeat(concat('w', id, ' '), 50) AS text").coalesce(1)
    index = decontaminate.build_index(docs, segment_words=100)
    groups = [f.metadata.row_group(i).num_rows for f in map(pq.ParquetFile, glob.glob(f"{index._stored_at.removeprefix('file://')}/*.parquet"))
              for i in range(f.metadata.num_row_groups)]
    assert sum(groups) == 40 and max(groups) <= decontaminate.ROW_GROUP
    items = spark.createDataFrame([(1, "w7 w7 w7")], "item_id long, text string")
    assert {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in decontaminate.search(index, items).collect() if r["spans"]} == {7: [(0, 50)]}


def test_rows_go_to_tasks_in_batches_of_few_bytes(spark):
    common.small_batches(spark)
    seen = spark.range(64).coalesce(1).selectExpr("repeat('x', 1000000) AS text").mapInArrow(
        lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"]) for b in batches), "n long").collect()
    assert sum(r["n"] for r in seen) >= 64_000_000 and max(r["n"] for r in seen) < 20_000_000


# ---------------------------------------------------------------- 2: mixing

def test_splitting_tree():
    blocks = np.array([5, 0, 17, 1000, 3])
    for n in (1, 2, 3, 8, 13):
        quotas = mixing.split_quotas(blocks, n, seed=4)
        assert (quotas.sum(axis=0) == blocks).all() and (quotas >= 0).all()
        assert quotas.sum(axis=1).max() - quotas.sum(axis=1).min() <= np.ceil(np.log2(n)) + 1 if n > 1 else True
    mean = np.mean([mixing.split_quotas(blocks, 4, seed=s)[1] for s in range(200)], axis=0)
    assert np.allclose(mean, blocks / 4, atol=0.06 * blocks.sum() ** 0.5 + 0.5)


def test_targets_and_draws(spark, sf):
    sizes = [("a", 100), ("b", 1000), ("c", 10), (None, 500)]
    want = mixing.targets(sizes)
    assert sum(want.values()) == pytest.approx(1.5 * 1610) and all(want[s] <= 2 * n + 1e-9 for s, n in sizes)
    free = [s for s, n in sizes if want[s] < 2 * n - 1e-9]
    weight = {"a": 5, "b": 2, "c": 1, None: 5}
    assert len({round(want[s] / weight[s], 6) for s in free}) == 1
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = mixing.mix(docs).collect()
    again = mixing.mix(docs.repartition(7)).collect()
    key = lambda r: (r["doc_id"], tuple(r["shards"]))
    assert sorted(map(key, rows)) == sorted(map(key, again))
    taken, target = Counter(), {}
    for r in rows:
        taken[r["source"]] += r["size"] * len(r["shards"])
        target[r["source"]] = r["target"]
        assert all(0 <= s < mixing.SHARDS for s in r["shards"])
    for s, n in target.items():
        assert abs(taken[s] - n) <= 0.01 * n + 5
    load = Counter(s for r in rows for s in r["shards"])
    assert len(load) == mixing.SHARDS


# ---------------------------------------------------------------- 8: sharding

def test_kd_tree(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = sharding.op8_kd_tree_shards(spark, sf).collect()
    texts = {r["doc_id"]: (r["text"], r["n_chars"], r["source"], r["lang"]) for r in docs.collect()}
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    size, home = Counter(), {}
    for r in rows:
        assert r["size"] == len(texts[r["doc_id"]][0].encode()) + 1
        size[r["shard"]] += r["size"]
        assert home.setdefault(texts[r["doc_id"]][0], r["shard"]) == r["shard"]  # equal texts together
    mean = sum(size.values()) / 8
    assert sorted(size) == list(range(8)) and all(abs(n - mean) < 0.03 * mean for n in size.values())
    for s in range(8):
        slots = sorted(r["slot"] for r in rows if r["shard"] == s)
        assert slots == list(range(len(slots)))
    # by target bytes: each leaf near the target
    out = sharding.kd_shards(docs, "text", ["n_chars"], target_bytes=100_000).groupBy("shard").agg(F.sum("size").alias("b")).collect()
    assert all(50_000 < r["b"] < 150_000 for r in out)


def test_one_cut_is_the_weighted_median(spark):
    rng = random.Random(5)
    rows = [(i, "x" * rng.randrange(1, 50) + str(i), rng.randrange(10_000)) for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, year long")
    got = {r["doc_id"]: r["shard"] for r in sharding.kd_shards(docs, "text", ["year"], n_shards=2, tolerance=0).collect()}
    size = {i: len(t) + 1 for i, t, _ in rows}
    year = {i: y for i, _, y in rows}
    left, right = [i for i in got if got[i] == 0], [i for i in got if got[i] == 1]
    assert max(year[i] for i in left) <= min(year[i] for i in right) + 1
    assert abs(sum(size[i] for i in left) - sum(size[i] for i in right)) <= 2 * max(size.values())


def test_a_huge_group_is_dealt(spark):
    docs = spark.range(300).selectExpr("id as doc_id", "'same text' as text", "id % 3 as year")
    out = sharding.kd_shards(docs, "text", ["year"], n_shards=4).groupBy("shard").count().collect()
    assert len(out) == 4 and max(r["count"] for r in out) < 120


# ---------------------------------------------------------------- 5: language

def test_bundles_are_the_definition():
    text, dims = "Été, il l'a vu", 128
    seq = re.sub(r"[^a-zé]+", " ", f" {text.lower()} ")
    vec = lambda c: language.letter_vectors(np.array([0 if c == " " else ord(c)]), dims)[0].astype(int)
    want = sum(np.roll(vec(a), 2) * np.roll(vec(b), 1) * vec(c) for a, b, c in zip(seq, seq[1:], seq[2:]))
    assert (language._bundles([text, "other"], 3, dims)[0] == want).all()


def test_language_held_out(spark, sf):
    rows = language.op5_hyperdimensional_language(spark, sf).join(
        spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.97


# ---------------------------------------------------------------- 1 and 4: classifiers

@pytest.mark.parametrize("name,label,least", [("op1_weak_supervision_toxicity", "toxic", 0.6), ("op4_line_crf_quality", "quality", 0.9)])
def test_held_out(spark, name, label, least):
    sf = "/root/testdata/sf0.1"
    rows = queries.REGISTRY[name][0](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    good = np.array([r["score"] for r in rows if r[label] == 1])
    bad = np.array([r["score"] for r in rows if r[label] == 0])
    auc = np.mean([(good > x).mean() + 0.5 * (good == x).mean() for x in bad])
    accuracy = np.mean([r["predicted"] == r[label] for r in rows])
    assert auc > 0.95 and accuracy > 0.95
    assert np.mean([r["predicted"] for r in rows if r[label] == 1]) > least


# ---------------------------------------------------------------- 9: language model

def test_gradients():
    model = gru.Gru(3, hidden=4, seed=1)
    rng = np.random.default_rng(0)
    for name in model.NAMES:
        setattr(model, name, getattr(model, name).astype(np.float64) + 0.1 * rng.standard_normal(getattr(model, name).shape))
    docs = [rng.integers(0, gru.LISTED + 3, n) for n in (7, 5, 5, 1)]
    _, size, flat, starts = model._lanes(docs)
    grads, n, _ = model._window(np.zeros((4, 4)), size, flat, starts, 0, 16)
    assert n == 18
    for name in model.NAMES:
        a = getattr(model, name)
        for place in [np.unravel_index(i, a.shape) for i in np.argsort(-np.abs(grads[name]).ravel())[:4]]:
            keep, eps = a[place], 1e-5
            a[place] = keep + eps
            up = model.score(docs).sum()
            a[place] = keep - eps
            down = model.score(docs).sum()
            a[place] = keep
            assert -(up - down) / (2 * eps) == pytest.approx(grads[name][place], rel=1e-3, abs=1e-6)


def test_state_is_carried_and_probabilities_add_up():
    model = gru.Gru(2, seed=2)
    rng = np.random.default_rng(1)
    docs = [rng.integers(0, gru.LISTED + 2, n) for n in (50, 3, 17)]
    whole = model.score(docs)
    assert np.allclose(whole, model.score(docs, tokens_at_once=5), atol=1e-3)
    assert np.allclose(whole, [model.score([d])[0] for d in docs], atol=1e-3)
    h = np.repeat(rng.standard_normal((1, model.hidden)).astype(np.float32), gru.LISTED + 2, axis=0)
    lp, _ = model.token_logp(h, np.arange(gru.LISTED + 2))
    assert np.exp(lp).sum() == pytest.approx(1, abs=1e-3)


def test_long_text_trains_as_it_is_scored(monkeypatch):
    """The lanes of a text of 300 tokens start with the states and tokens that scoring has there."""
    model = gru.Gru(2, seed=3)
    rng = np.random.default_rng(4)
    docs = [rng.integers(0, gru.LISTED + 2, n) for n in (300, 120, 121, 1, 240)]
    for d, states in zip(docs, model.states(docs)):
        h, expected = np.zeros((1, model.hidden), np.float32), []
        for t, token in enumerate(d):
            if t % gru.LANE == 0:
                expected.append(h[0])
            h = model.step(np.array([d[t - 1] if t else model.start]), h)[0]
        assert np.allclose(states, expected, atol=1e-5) and len(states) == -(-len(d) // gru.LANE)
    seen, window = [], model._window

    def watched(h, size, flat, starts, t0, *rest):
        out = window(h, size, flat, starts, t0, *rest)
        logp, at = 0.0, h  # the window's loss by the parameters that it was given
        for t in range(t0, min(t0 + gru.WINDOW, int(size[0]))):
            n = int((size > t).sum())
            at = model.step(flat[starts[:n] + t - 1] if t else rest[1][:n], at[:n])[0]
            logp += model.token_logp(at, flat[starts[:n] + t])[0].sum()
        seen.append(logp)
        return out

    monkeypatch.setattr(model, "_window", watched)
    whole = model.score(docs).sum()
    model.train(docs, rate=0.0)
    assert sum(seen) == pytest.approx(whole, rel=1e-4)


def test_scores_do_not_depend_on_partitions(spark, monkeypatch):
    monkeypatch.setattr(language_model, "SHARD_TOKENS", 2000)  # several shards a round
    rng = random.Random(8)
    rows = [(i, " ".join(_words(rng, rng.choice([0, 1, 40, 300])))) for i in range(120)]
    rows += [(None, "a text without id"), (5, rows[5][1]), (7, "the same id again")]
    scores = []
    for parts in (2, 8):
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        out = language_model.language_model_scores(docs, F.col("text") != "").collect()
        scores.append(np.array([r["score"] for r in sorted(out, key=lambda r: (r["doc_id"] is None, r["doc_id"], r["n_tokens"]))]))
    assert np.allclose(scores[0], scores[1], rtol=1e-5)


def test_base_scores_and_gain(spark, sf):
    rows = language_model.op9_gru_language_model(spark, sf).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    tokens = {i: language_model.words_of((t or "").encode()) for i, t in texts.items()}
    held = {r["doc_id"] for r in rows if r["held_out"]}
    counts = Counter(w for i, ws in tokens.items() if i not in held for w in ws)
    n, v = sum(counts.values()), len(counts)
    for r in rows:
        own = tokens[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(own), sum(w in counts for w in own), n)
        assert r["base_score"] == pytest.approx(sum(np.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own), rel=1e-9)
    assert sum(r["score"] for r in rows if r["held_out"]) > 0.95 * sum(r["base_score"] for r in rows if r["held_out"])


def test_words_of_many_texts_are_looked_up_together():
    """A task looks up each distinct word of a slice of texts once: tokens, counts and hashes are those of word by word."""
    texts = [b"first", b"A b  c\tA", b"", b" \n ", " \x0b É É. \x1f x\n".encode(), b"a-very-long-word, a-very-long-word,", b"b"]
    words = [language_model.words_of(t) for t in texts]
    hashes = {w: int(np.array([language_model._hash(w)], np.uint64).view(np.int64)[0]) for ws in words for w in ws}
    counts = {w: 3 + i for i, w in enumerate([language_model.END, b"a", b"x", b"first"])}
    vocabulary = object.__new__(language_model.Vocabulary)
    vocabulary.words, vocabulary.n = (np.array(x, np.int64) for x in zip(*sorted((hashes[w], n) for w, n in counts.items())))
    vocabulary.listed = {hashes[w]: i for i, w in enumerate([language_model.END, b"a"])}
    look = language_model._Lookup(vocabulary)
    for begin, at_once in ((0, 10 ** 6), (1, 10 ** 6), (0, 1), (2, 8)):
        got = []
        for part in language_model._texts(pa.array(texts, pa.binary()).slice(begin), at_once):
            places, *found = look(part)
            got += [[c[s:e].tolist() for c in found] for s, e in zip(places, places[1:])]
        assert got == [[[vocabulary.listed.get(hashes[w], gru.LISTED + language_model.shape_of(w)) for w in ws],
                        [counts.get(w, -1) for w in ws], [hashes[w] for w in ws]] for ws in words[begin:]]


def test_training_reads_every_token(spark, monkeypatch):
    """The copies of all rounds have seen each training token once, long texts' too."""
    rng = random.Random(3)
    rows = [(i, " ".join(_words(rng, rng.choice([0, 1, 40, 300, 2000])))) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    vocabulary, seen = language_model.Vocabulary(language_model.count_words(docs)), []

    def stored(df, label="step", keep=language_model.store):
        out = keep(df, label)
        seen.extend(r["tokens"] for r in out.collect() if label == "gru-copies")
        return out

    monkeypatch.setattr(language_model, "store", stored)
    language_model.train(docs, vocabulary)
    assert sum(seen) == vocabulary.tokens == sum(len(t.split()) + 1 for _, t in rows)


# ---------------------------------------------------------------- 3: passages

def test_chains_against_all_predecessors():
    rng = random.Random(2)
    for _ in range(60):
        found = sorted({(rng.randrange(200), rng.randrange(200), rng.randrange(5, 12)) for _ in range(rng.randrange(1, 25))})
        best = []
        for i, (b, a, w) in enumerate(found):
            gains = [best[j] - substring_dedup.GAP_COST * (b - bj - wj + a - aj - wj) for j, (bj, aj, wj) in enumerate(found[:i])
                     if bj + wj <= b and aj + wj <= a]
            best.append(w + max([0.0, *gains]))
        chain = substring_dedup.chains(found)[0]
        cost = sum(x[2] for x in chain) - substring_dedup.GAP_COST * sum(
            q[0] - p[0] - p[2] + q[1] - p[1] - p[2] for p, q in zip(chain, chain[1:]))
        if all(max(q[0] - p[0] - p[2], q[1] - p[1] - p[2]) <= substring_dedup.MAX_GAP for p, q in zip(chain, chain[1:])):
            assert cost <= max(best) + 1e-9
        if max(x[0] for x in found) <= substring_dedup.MAX_GAP and max(x[1] for x in found) <= substring_dedup.MAX_GAP:
            assert cost == pytest.approx(max(best))


def test_planted_passages(spark):
    rng = random.Random(9)
    passages = [_words(rng, n, 10 ** 6) for n in (55, 80, 200)]
    rows, planted = [], {}
    for i in range(60):
        words = _words(rng, 300, 10 ** 6)
        if i % 3:
            p = rng.randrange(3)
            own = _edited(rng, passages[p], len(passages[p]) // 60 if i % 2 else 0)
            at = rng.randrange(250)
            words[at:at] = own
            planted[i] = (p, at, len(own))
        rows.append((i, " ".join(words)))
    got = substring_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    for r in got:  # nothing but planted passages, and in their places
        (p, at, n), (q, other, m) = planted[r["doc_id"]], planted[r["other_id"]]
        assert p == q and r["doc_id"] > r["other_id"]
        assert abs(r["start"] - at) <= 4 and abs(r["end"] - at - n) <= 4 and abs(r["other_start"] - other) <= 4
    linked = _components(range(60), [(r["doc_id"], r["other_id"]) for r in got])
    for p in range(3):
        assert len({linked[i] for i, x in planted.items() if x[0] == p}) == 1


def test_shared_runs_of_the_tables(spark, sf):
    """Documents that share 60 words (not of one repeated word) are reported."""
    texts = {r["doc_id"]: (r["text"] or "").lower().split() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = substring_dedup.op3_collinear_chaining(spark, sf).collect()
    named = {r["doc_id"] for r in got} | {r["other_id"] for r in got}
    first, shared = {}, set()
    for i, w in sorted(texts.items()):
        for j in range(len(w) - 59):
            run = tuple(w[j:j + 60])
            if len(set(run)) > 8 and first.setdefault(run, i) != i:
                shared |= {i, first[run]}
    assert len(shared) > 20 and len(shared - named) <= 0.02 * len(shared)


def test_recall_of_edited_passages(spark):
    """Passages of words of which 0.8 to 0.9 stay equal; figures are in the README."""
    rng = random.Random(11)
    cases, rows, pairs = [(100, 10), (100, 8), (100, 7), (100, 6), (60, 10), (100, 0.1), (100, 0.15), (200, 0.18)], [], 40
    for case, (n, edit) in enumerate(cases):
        for i in range(pairs):
            passage = _words(rng, n, 10 ** 6)
            at = range(rng.randrange(edit), n, edit) if edit > 1 else rng.sample(range(n), round(edit * n))
            other = list(passage)
            for k in at:
                other[k] = f"new{rng.random()}"
            for side, words in enumerate((passage, other)):
                rows.append((2 * (case * pairs + i) + side, " ".join(_words(rng, 60, 10 ** 6) + words + _words(rng, rng.randrange(20, 90), 10 ** 6))))
    got = substring_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(r["doc_id"] // 2 == r["other_id"] // 2 for r in got)
    found = {r["doc_id"] // 2 for r in got}
    recall = {case: sum(k * pairs <= x < (k + 1) * pairs for x in found) / pairs for k, case in enumerate(cases)}
    print("recall of edited passages (words, edits):", recall)
    assert min(recall.values()) >= 0.9


def test_nearer_predecessor_is_tried():
    """The best end lies too far back in one text; a nearer block with a gain is chained all the same."""
    found = [(0, 0, 100), (150, 90, 20), (180, 165, 30)]
    assert substring_dedup.chains(found) == [[(0, 0, 100)], [(150, 90, 20), (180, 165, 30)]]


def test_passage_of_common_lines(spark):
    """Two texts that alone share two adjacent lines are linked, though many texts hold either line."""
    rng, rows, pairs = random.Random(5), [], []
    for _ in range(8):
        lines = [_words(rng, 25, 10 ** 6) for _ in range(2)]
        pairs.append((len(rows), len(rows) + 1))
        for own in [lines[0] + lines[1]] * 2 + [x for x in lines for _ in range(40)]:
            rows.append((len(rows), " ".join(_words(rng, 60, 10 ** 6) + own + _words(rng, 60, 10 ** 6))))
    got = substring_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r["other_id"], r["doc_id"]) for r in got} == set(pairs)
    assert all(r["n_equal"] >= 50 for r in got)


@pytest.mark.parametrize("stretch, n_others", [(9, 20), (20, 40)])
def test_edited_passages_of_common_stretches(spark, stretch, n_others):
    """Two texts that share an edited passage are linked, though other texts hold each equal stretch (or its halves)."""
    rng, rows, pairs = random.Random(6), [], []
    half = stretch if n_others <= substring_dedup.PARTNERS_OF_KEY else stretch // 2
    for _ in range(6):
        equal = [_words(rng, stretch, 10 ** 6) for _ in range(100 // stretch)]
        held = [e[k:k + half] for e in equal for k in range(0, stretch, half)]
        pairs.append((len(rows), len(rows) + 1))
        for side in range(2):
            passage = [w for e in equal for w in [*e, f"new{side}{rng.random()}"]]
            rows.append((len(rows), " ".join(_words(rng, 60, 10 ** 6) + passage + _words(rng, 60, 10 ** 6))))
        for part in [x for x in held for _ in range(n_others)]:
            rows.append((len(rows), " ".join(_words(rng, 30, 10 ** 6) + part + _words(rng, 30, 10 ** 6))))
    got = substring_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r["other_id"], r["doc_id"]) for r in got} == set(pairs)


def test_long_keys_of_many_texts_are_matched(spark):
    """The texts of a long key, however many, meet its first and its previous text."""
    n = substring_dedup.PARTNERS_OF_KEY + 8
    keys = spark.createDataFrame([([7 << 40], [i], [3 * i], [29]) for i in range(n)], substring_dedup._KEYS)
    rows = substring_dedup._level(keys, substring_dedup._key_rows, None, 3).where("b is not null").collect()
    assert {(r["b"], r["a"]) for r in rows} == {(y, x) for y in range(1, n) for x in (0, y - 1)}
    assert all(r["chain"] == [3 * r["b"], 3 * r["a"], 29] for r in rows)


def test_texts_of_few_share_all_pairs():
    """Every two texts of a key meet, wherever they stand among its texts; of a key of many, first and previous."""
    n = substring_dedup.PARTNERS_OF_KEY
    for size in (n, n + 1):
        text = np.arange(size, dtype=np.int64)
        code, at, span = np.full(size, 7, np.int32), (3 * text).astype(np.int32), np.full(size, 5, np.int32)
        (b, a, at_b, at_a, _), many = substring_dedup.matches(code, text, at, span, np.zeros((3, 0), np.int64))
        pairs = set(zip(b.tolist(), a.tolist()))
        assert pairs == {(y, x) for y in range(size) for x in range(y) if size == n or x in (0, y - 1)}
        assert (at_b == 3 * b).all() and (at_a == 3 * a).all() and len(many) == (0 if size == n else size)


def test_words_are_sent_once_for_all_pairs_of_a_group(spark, monkeypatch):
    """20 texts that are all partners: their words go to one place once each, or to each part that has pairs of theirs."""
    pairs = [(a, b, [[0, 0, 60]]) for b in range(1, 20) for a in range(b)] + [(30, 31, [[0, 0, 60]]), (25, 31, [[0, 0, 60]])]
    of_pair = spark.createDataFrame(pairs, "a long, b long, chains array<array<int>>")
    texts = spark.createDataFrame([(i, [i]) for i in [*range(20), 25, 30, 31]], "text_id long, words array<int>")
    for most, sent in ((2000, 20), (15, None)):
        monkeypatch.setattr(substring_dedup, "PARTNERS", most)
        rows = substring_dedup._meetings(of_pair, texts).collect()
        held = {(r["place"], r["part"], r["a"]): r["words"] for r in rows if r["b"] is None}
        met = [r for r in rows if r["b"] is not None]
        assert sorted((r["a"], r["b"], r["chains"]) for r in met) == sorted(pairs)
        assert all(held[r["place"], r["part"], x] == [x] for r in met for x in (r["a"], r["b"]))
        assert len(held) == sum(r["b"] is None for r in rows)
        assert sent is None or sum(x < 20 for _, _, x in held) == sent


def test_runs_with_a_repeated_word(spark):
    """Texts that alone share a run of 50 words are linked, though most of it is one repeated word or in many texts."""
    rng, rows, pairs = random.Random(10), [], []
    for n in (0, 45):
        lines = [_words(rng, 7, 10 ** 6) for _ in range(2)]
        pairs.append((len(rows), len(rows) + 1))
        for own in [lines[0] + ["x"] * 36 + lines[1]] * 2 + [x for x in lines for _ in range(n)]:
            rows.append((len(rows), " ".join(_words(rng, 40, 10 ** 6) + own + _words(rng, 40, 10 ** 6))))
    rows += [(len(rows) + i, " ".join(_words(rng, 40, 10 ** 6) + ["x"] * 60)) for i in range(3)]  # one repeated word is no passage
    got = substring_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r["other_id"], r["doc_id"]) for r in got} == set(pairs)


def test_hot_seeds_in_several_buckets(spark, monkeypatch):
    """Texts of a hot seed are linked over its anchor, and by longer keys, whatever buckets they are dealt to."""
    monkeypatch.setattr(substring_dedup, "HOT_ONE_IN", 2)
    monkeypatch.setattr(substring_dedup, "WORDS_PER_BUCKET", 500)
    rng = random.Random(8)
    lines = [_words(rng, 12, 10 ** 6) for _ in range(5)]
    whole, rows = [w for x in lines for w in x], []
    for i in range(150):
        own = whole if i in (20, 120) else whole[:30] if i % 2 else whole[30:]
        rows.append((i, " ".join(_words(rng, 30, 10 ** 6) + own + _words(rng, 30, 10 ** 6))))
    got = substring_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r["other_id"], r["doc_id"]) for r in got} == {(20, 120)}


def test_no_shared_run_is_missing(spark, sf):
    """Every document that shares MIN_WORDS words (not of one repeated word) is reported."""
    texts = {r["doc_id"]: (r["text"] or "").lower().split() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = substring_dedup.op3_collinear_chaining(spark, sf).collect()
    named = {r["doc_id"] for r in got} | {r["other_id"] for r in got}
    first, shared = {}, set()
    for i, w in sorted(texts.items()):
        for j in range(len(w) - 49):
            run = tuple(w[j:j + 50])
            if len(set(run)) > 1 and first.setdefault(run, i) != i:
                shared |= {i, first[run]}
    assert len(shared) > 20 and shared <= named


# ---------------------------------------------------------------- 6: embeddings

def test_small_cells_lose_no_link(spark):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((600, 16))
    near = x[:150] + 0.08 * rng.standard_normal((150, 16)) * np.linalg.norm(x[:150], axis=1, keepdims=True) / 4
    x = np.concatenate([x, near, x[:20]])
    label = rng.integers(0, 2, 600)
    label = np.concatenate([label, label[:150], label[:20]])
    df = spark.createDataFrame([(i, v.tolist(), int(c)) for i, (v, c) in enumerate(zip(x, label))],
                               "vec_id long, embedding array<double>, label int")
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    link = (u @ u.T >= 0.93) & (label[:, None] == label[None, :]) & ~np.eye(len(x), dtype=bool)
    want = _components(range(len(x)), zip(*np.nonzero(np.triu(link))))
    got = {r["vec_id"]: r for r in embedding_dedup.near_duplicates(df, cell=25).collect()}
    assert link.sum() > 100
    for i in range(len(x)):
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (int(link[i].sum()), want[i], want[i] == i)
