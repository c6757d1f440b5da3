"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing column names."""

import pytest
from pyspark.sql import functions as F

from tabprep.llm import (decontaminate, embedding_dedup, language, language_model, mixing, ngram_join, quality,
                         sharding, substring_dedup, toxicity)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard int, size string, _row int, _h int"
LONG = " ".join(f"word{i % 977} tail{i}" for i in range(30_000))
ROWS = [
    (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \n\t ", "en", None, 3), (4, "one", "en", "a", 3),
    (5, LONG, "en", "a", len(LONG)), (5, LONG, "en", "a", len(LONG)), (6, LONG, "fr", "b", len(LONG)),
    (7, "###!!! 123", None, "b", 10), (None, "a text without an id", "en", "a", 20), (8, "été à la plage " * 5, "fr", "b", 70),
    (9, "tie " * 4, "en", "c", 16), (10, "tie " * 4, "en", "c", 16), (11, "the cat and the dog sat " * 6, "en", "c", 144),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, 3, "x", 1, 2) for r in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(4, 0, 0), (5, 1, 0), (5, 1, 1), (9, 0, 1), (11, 1, 0), (99, 1, 1), (None, 1, 1), (8, None, None)],
                                 "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, None), (2, ""), (3, "one"), (4, " ".join(LONG.split()[100:120])), (4, "one")],
                                 "item_id long, text string")


def test_sharding(docs, empty):
    out = sharding.shard_documents(docs)
    assert out.count() == len(ROWS) and {"_row", "_h", "shard", "slot"} <= set(out.columns)
    rows = out.collect()
    for s in {r["shard"] for r in rows}:
        slots = sorted(r["slot"] for r in rows if r["shard"] == s)
        assert slots == list(range(len(slots)))
    assert {r["size"] for r in rows if r["text"] is None} == {1}
    assert sharding.shard_documents(empty).count() == 0


def test_patterns_vote_without_a_listed_word():
    for text, voter in [(b"just shut up and go away", "dismissal"), (b"what a joke", "contempt"), (b"u pathetic fools", "second person attack")]:
        assert toxicity.fixed_votes(text, toxicity.words_of(text)) >> toxicity.VOTERS.index(voter) & 1


def test_mixing_with_one_very_long_document(spark):
    """Wherever the long document falls in the hash order, the gap is below the smallest document left out."""
    for seed in range(4):
        rows = [(i, "a", "w " * (1 + i % 20)) for i in range(300)] + [(300, "a", "w " * 2000)]
        out = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string, text string"),
                         weights=(1,), amount=0.7, seed=seed).collect()
        gap = out[0]["target"] - sum(r["size"] * len(r["shards"]) for r in out)
        assert abs(gap) < min(r["size"] for r in out if not r["shards"])


def _mix_equals_sql(spark, rows):
    """(worst gap of a source, smallest group left out) of a mix that equals its SQL twin row by row."""
    import duckdb

    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    drawn = mixing.mix(df.repartition(3)).collect()
    con = duckdb.connect()
    con.register("documents", df.toArrow())
    want = con.execute(mixing.SQL_OP2).fetchall()
    got = [(r["doc_id"], r["size"], r["source_size"], round(r["target"], 6), r["size"] * len(r["shards"]), len(r["shards"])) for r in drawn]
    assert sorted(got, key=str) == sorted(want, key=str)
    return drawn


def test_mixing_of_repeated_rows_and_null_ids(spark):
    """Twenty rows an id, a hundred rows without one, one huge text: rows of one id are drawn alike and as a group."""
    import collections

    twenty = [(i, "a", "w " * 60) for i in range(40) for _ in range(20)]
    nameless = [(None, "b", f"w{i} " + "w " * (i % 50)) for i in range(100)] + [(None, "b", "same text")] * 30
    mixed = [(1000 + i, "c", "w " * (100 if i % 2 else 300)) for i in range(300)] + [(2000, "c", "w " * 20_000)]
    odd = [(3000 + i, None, t) for i, t in enumerate([None, "", " ", "one", "two words"])]
    drawn = _mix_equals_sql(spark, twenty + nameless + mixed + odd)
    for s in "abc":
        mine = [r for r in drawn if r["source"] == s]
        gap = mine[0]["target"] - sum(r["size"] * len(r["shards"]) for r in mine)
        whole = min(len(r["shards"]) for r in mine)
        groups = collections.Counter()
        for r in mine:
            if len(r["shards"]) == whole:
                groups[r["doc_id"] if r["doc_id"] is not None else r["text"]] += r["size"]
        assert -1e-6 <= gap < max(1, min(groups.values()))
    assert all(len({len(r["shards"]) for r in drawn if r["doc_id"] == i}) == 1 for i in range(40))


def test_mixing_where_many_runs_are_needed(spark):
    rows = [(i, "a", "w " * (100 if i % 10 == 0 else 300)) for i in range(900)] + [(5000, "a", "w " * 20_000), (5001, "z", "w " * 90_000)] \
        + [(6000 + i, "z", "w " * (1 + i * 7 % 400)) for i in range(200)]
    _mix_equals_sql(spark, rows)


def test_mixing(docs, empty):
    out = mixing.mix(docs).collect()
    assert len(out) == len(ROWS)
    for r in out:
        assert r["size"] == len((r["text"] or "").split()) and len(r["shards"]) <= 2
    assert mixing.mix(empty).count() == 0
    assert mixing.mixed_rows(docs).count() == sum(len(r["shards"]) for r in out)


def test_decontaminate(docs, empty, items):
    out = {(r["doc_id"], r["n_words"]): r for r in decontaminate.contamination(docs, items).collect()}
    assert out[(1, 0)]["n_hit"] == 0 and not out[(1, 0)]["contaminated"]
    assert out[(4, 1)]["contaminated"] and out[(4, 1)]["items"] == ["3", "4"]
    assert out[(5, 60_000)]["n_hit"] == 20 and not out[(5, 60_000)]["contaminated"]
    assert decontaminate.contamination(docs, items).count() == len(ROWS)
    assert decontaminate.contamination(empty, items).count() == 0
    assert decontaminate.contamination(docs, items.limit(0)).agg(F.sum("n_hit")).first()[0] == 0
    assert decontaminate.drop_contaminated(docs, items).columns == docs.columns


def test_decontaminate_with_null_item_ids(spark, docs):
    """A window shared by a named and a nameless item: it counts as hit, only the named item is listed."""
    items = spark.createDataFrame([(None, "one"), (3, "one"), (None, "tie tie tie tie")], "item_id long, text string")
    out = {r["doc_id"]: r for r in decontaminate.contamination(docs, items).collect()}
    assert out[4]["items"] == ["3"] and out[4]["n_hit"] == 1
    assert out[9]["items"] == [] and out[9]["n_hit"] == 4 and out[9]["contaminated"]


def test_language(docs, empty):
    prototypes = language.train_prototypes(docs, "text", "lang")
    assert sorted(prototypes) == ["en", "fr"]
    out = language.identify(docs, "text", prototypes).collect()
    assert len(out) == len(ROWS)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in out}
    assert got[1] == got[2] == got[3] == got[7] == ("und", 0.0) and got[8][0] == "fr"
    assert language.train_prototypes(empty, "text", "lang") == {}
    assert {r["lang_pred"] for r in language.identify(docs, "text", {}).collect()} == {"und"}
    assert language.identified(empty).count() == 0


def test_ngram_join(docs, empty):
    rows = ngram_join.jaccard_components(docs).collect()
    assert len(rows) == len(ROWS)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows}
    assert got[1] == (0, 1) and got[3] == (0, 3) and got[4] == (1, 4)
    assert got[6][1] == got[5][1] == 5 and got[10] == got[9] == (1, 9)
    assert ngram_join.jaccard_components(empty).count() == 0
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted([None, 1, 2, 3, 4, 5, 7, 8, 9, 11], key=str)


def test_toxicity(docs, empty, labels):
    def scored(learn, notes, over):
        terms, ids = toxicity.learn_terms(learn, notes)
        return toxicity.score(toxicity.featurize(over, terms),
                              toxicity.fit(toxicity.featurize(learn, terms), notes, terms, ids)).collect()

    out = scored(docs, labels, docs)
    assert len(out) == len(ROWS) and all(0 <= r["score"] <= 1 for r in out)
    assert len(scored(empty, labels.limit(0), docs)) == len(ROWS)
    assert scored(docs, labels, empty) == []


def test_quality(docs, empty, labels):
    out = quality.score(docs, quality.fit(docs, labels)).collect()
    assert len(out) == len(ROWS) and all(0 <= r["score"] <= 1 for r in out)
    blank = {r["score"] for r in out if r["doc_id"] in (1, 2, 3)}
    assert len(blank) == 1
    assert quality.score(docs, quality.fit(empty, labels)).count() == len(ROWS)
    assert quality.score(empty, quality.fit(docs, labels)).count() == 0


def test_language_model(docs, empty):
    out = language_model.language_model_scores(docs, F.lit(True)).collect()
    assert len(out) == len(ROWS)
    got = {r["doc_id"]: r for r in out}
    assert got[1]["n_tokens"] == got[2]["n_tokens"] == got[3]["n_tokens"] == 1
    assert got[5]["n_tokens"] == got[5]["n_known"] == 60_001
    none = language_model.language_model_scores(docs, F.lit(False)).collect()
    assert {r["n_known"] for r in none} == {0} and {r["train_tokens"] for r in none} == {0}
    assert language_model.language_model_scores(empty, F.lit(True)).count() == 0


def test_substring(docs, empty):
    out = substring_dedup.repeated_passages(docs).collect()
    assert {(r["doc_id"], r["other_id"], r["kind"]) for r in out} == {(6, 5, "copy")}
    assert substring_dedup.repeated_passages(empty).count() == 0


def test_embeddings(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 0), (2, [2.0, 0.0], 0), (3, [1.0, 0.0], 0), (4, [1.0, -0.0], 0), (5, [1.0, 0.0], None),
            (6, None, 0), (7, [], 0), (8, [0.0, 0.0], 0), (9, [nan, 1.0], 0), (10, [inf, 1.0], 0), (11, [None, 1.0], 0),
            (12, [1.0, 0.0, 0.0], 0), (13, [0.0, 1.0], 0), (14, [1.0, 0.0], 1), (15, [1e-200, 0.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("v", F.lit(1)).withColumn("_id", F.lit(2))
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embedding_dedup.near_duplicates(df).collect()}
    assert len(got) == len(rows)
    for i in (1, 2, 3, 4, 15):
        assert got[i] == (4, 1, i == 1)
    for i in (5, 6, 7, 8, 9, 10, 11, 12, 13, 14):
        assert got[i] == (0, i, True)
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


def test_embeddings_of_one_id(spark):
    """Rows of one id with different vectors have their own links; nameless rows link like others."""
    rows = [(1, [1.0, 0.0], 0), (1, [0.0, 1.0], 0), (2, [1.0, 0.01], 0), (3, [0.01, 1.0], 0), (None, [-1.0, 0.0], 0),
            (None, [0.0, -1.0], 0), (7, [0.0, -1.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = sorted(((r["vec_id"], tuple(r["embedding"]), r["n_links"], r["component_id"], r["kept"])
                  for r in embedding_dedup.near_duplicates(df).collect()), key=str)
    assert got == sorted([(1, (1.0, 0.0), 1, 1, True), (1, (0.0, 1.0), 1, 1, True), (2, (1.0, 0.01), 1, 1, False),
                          (3, (0.01, 1.0), 1, 1, False), (None, (-1.0, 0.0), 0, None, True),
                          (None, (0.0, -1.0), 1, 7, False), (7, (0.0, -1.0), 1, 7, True)], key=str)
