"""Toxicity by weak supervision.

1. **Voters.**  Lexicon voters fire on a listed word, pattern voters on a
   shape of the text.  Besides the short lists below, words that a bounded
   sample of labelled rows shows far more often in toxic texts are dealt by
   hash to further lexicon voters.  At most 16 voters, so a document's votes
   are a 16-bit pattern.
2. **Label model.**  Spark counts the patterns of *all* training documents by
   annotation (toxic, not toxic, none): at most 3 * 2 ** 16 rows.  EM fits a
   latent class with, per class, each voter's firing rate (its accuracy) and
   a tree of pairwise dependences between voters (their correlations; the
   tree has the largest expected mutual information, after Chow and Liu).
   An annotation is one more voter whose accuracy is learned too.
3. **Classifier.**  Logistic regression on the presence of words and beginnings and on votes is trained
   on the posteriors of the bounded sample (``SAMPLE`` rows per annotation),
   and scores every whole text.

The driver holds the pattern counts, the vocabulary and the sample's columns
(all bounded by parameters); no text is shuffled: the sample's ids are
broadcast (at most 3 * ``SAMPLE``), and every text is read once for its
features.

Defined cases: null and empty texts have no words and get the model's
base score; unlabelled tables give a model from votes alone; repeated rows
count and are scored each; labels of ids that have no document are unused,
and an id labelled twice counts as toxic if any label says so.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.functions.hashing import hash_uniform
from tabprep.functions.names import qcol
from tabprep.llm.common import list_array, store, table, utf8
from tabprep.llm.language import fold

SAMPLE, MINED, MINED_VOTERS, VOCABULARY, MIN_DOCS = 3000, 240, 5, 20_000, 4
BEGINNINGS = (4, 5, 6, 7)

#: Lexicons (lower case); each is a voter.
LEXICONS = {
    "insult nouns": "idiot idiots moron morons loser losers clown clowns fool fools jerk creep coward imbecile "
                    "dimwit halfwit scum trash garbage vermin parasite pig rat swine dunce dolt buffoon nitwit",
    "insult adjectives": "stupid dumb pathetic worthless disgusting ugly filthy vile useless brainless despicable "
                         "repulsive revolting hideous idiotic moronic braindead spineless gutless contemptible",
    "hostility": "hate hates despise loathe kill die hurt destroy attack beat punch burn threaten",
    "other languages": "idiota estúpido estúpida imbécil basura asqueroso inútil idiot idiote imbécile stupide "
                       "ordure débile crétin nul dumm dummkopf idioten trottel blödmann abschaum widerlich wertlos",
}
_PATTERNS = {
    "second person attack": re.compile(rb"\b(you|your|u)\b[^.\n]{0,40}\b(idiot|moron|loser|clown|scum|trash|fool)", re.I),
    "dismissal": re.compile(rb"shut up|get lost|go away|nobody (likes|wants) you", re.I),
    "contempt": re.compile(rb"\b(such|what) an? (idiot|moron|loser|clown|fool|joke)|piece of (trash|garbage)", re.I),
    "shouting": re.compile(rb"[A-Z]{4,}[^a-z\n]{0,40}!!"),
}
VOTERS = [*LEXICONS, *_PATTERNS, "several insults", *(f"mined {i}" for i in range(MINED_VOTERS)),
          "two mined words", "three mined words"]
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
_LISTED = [frozenset(w.encode() for w in words.split()) for words in LEXICONS.values()]
_INSULTS = _LISTED[0] | _LISTED[1] | _LISTED[3]


def words_of(text: bytes) -> set[bytes]:
    return set(text.translate(_FOLD).split())


def beginnings(words: set[bytes], k: int) -> set[bytes]:
    return {w[:k] for w in words if len(w) > k}


def terms_of(words: set[bytes]) -> set[bytes]:
    """The words and, marked, their beginnings."""
    out = set(words)
    for k in BEGINNINGS:
        out.update(b"^" + x for x in beginnings(words, k))
    return out


def fixed_votes(text: bytes, words: set[bytes]) -> int:
    bits = sum(1 << i for i, listed in enumerate(_LISTED) if not listed.isdisjoint(words))
    n = len(_LISTED)
    insults = len(_INSULTS & words)
    bits |= sum(1 << (n + i) for i, p in enumerate(_PATTERNS.values()) if p.search(text))
    return bits | (insults > 1) << (n + len(_PATTERNS))


class Terms:
    """The vocabulary (term -> column) and its mined part (term -> lexicon voter), ready for look-up."""

    def __init__(self, column: dict[bytes, int], mined: dict[bytes, int]):
        self.column, self.mined = column, mined
        self.words = frozenset(t for t in column if t[:1] != b"^")
        self.starts = {k: frozenset(t[1:] for t in column if t[:1] == b"^" and len(t) == k + 1) for k in BEGINNINGS}

    def __call__(self, words: set[bytes]) -> list[bytes]:
        """The text's terms that are in the vocabulary."""
        found = list(self.words & words)
        for k, listed in self.starts.items():
            if listed:
                found += [b"^" + x for x in listed & beginnings(words, k)]
        return found

    def votes(self, words: set[bytes], found: list[bytes]) -> int:
        """Which mined lexicons fire, and how many words have a mined term."""
        hit = [t for t in found if t in self.mined]
        if not hit:
            return 0
        first, bits = len(_LISTED) + len(_PATTERNS) + 1, 0
        for t in hit:
            bits |= 1 << (first + self.mined[t])
        n = sum(1 for w in words if not self.mined.keys().isdisjoint(terms_of({w})))
        return bits | (n > 1) << (first + MINED_VOTERS) | (n > 2) << (first + MINED_VOTERS + 1)


# ---------------------------------------------------------------- label model

def _patterns(codes: np.ndarray, n: int) -> np.ndarray:
    return (codes[:, None] >> np.arange(n)) & 1


def _tree(votes: np.ndarray, weight: np.ndarray) -> list[int]:
    """Parent of each voter (-1: root): the maximum spanning tree of mutual information."""
    n, total = votes.shape[1], weight.sum() + 1.0
    one = (weight @ votes + 0.5) / total
    both = (votes * weight[:, None]).T @ votes
    info = np.zeros((n, n))
    for a in (0, 1):
        for b in (0, 1):
            pa_, pb = (one if a else 1 - one), (one if b else 1 - one)
            joint = both if a and b else (weight @ votes)[:, None] - both if a else (weight @ votes)[None, :] - both if b \
                else weight.sum() - (weight @ votes)[:, None] - (weight @ votes)[None, :] + both
            p = np.maximum(joint, 0) / total + 1e-12
            info += p * np.log(p / np.outer(pa_, pb))
    parent, inside = [-1] * n, [0]
    while len(inside) < n:
        rest = [j for j in range(n) if j not in inside]
        block = info[np.ix_(inside, rest)]
        i, j = np.unravel_index(block.argmax(), block.shape)
        parent[rest[j]] = inside[i] if block[i, j] > 1e-4 else -1
        inside.append(rest[j])
    return parent


class LabelModel:
    """P(class), P(vote | class, parent's vote) and P(annotation | class), by EM."""

    def fit(self, codes: np.ndarray, notes: np.ndarray, counts: np.ndarray, rounds: int = 40) -> LabelModel:
        """notes: 1 toxic, 0 not toxic, -1 none."""
        n = self.n = len(VOTERS)
        votes, counts = _patterns(codes, n), counts.astype(float)
        fired = votes.sum(axis=1)
        p = np.where(notes == 1, 0.97, np.where(notes == 0, 0.03, 0.02 + 0.6 * (fired >= 2)))
        self.parents = None
        for r in range(rounds):
            self.prior = (counts @ p + 1) / (counts.sum() + 2)
            weights = (counts * (1 - p), counts * p)
            if r % 10 == 5:  # the dependences follow the current classes
                self.parents = [_tree(votes, w) for w in weights]
            self.rates, self.accuracy = [], []
            for c, w in enumerate(weights):
                parents = self.parents[c] if self.parents else [-1] * n
                rate = np.zeros((n, 2))
                for j, up in enumerate(parents):
                    for v in (0, 1):
                        mine = w if up < 0 else w * (votes[:, up] == v)
                        rate[j, v] = (mine @ votes[:, j] + 0.1) / (mine.sum() + 1.0)
                self.rates.append((parents, rate))
                noted = w * (notes >= 0)
                self.accuracy.append((noted @ (notes == c) + 9.5) / (noted.sum() + 10))
            p = self.posterior(codes, notes)
        return self

    def posterior(self, codes: np.ndarray, notes: np.ndarray) -> np.ndarray:
        votes = _patterns(codes, self.n)
        log = []
        for c, (parents, rate) in enumerate(self.rates):
            fire = np.stack([np.full(len(votes), rate[j, 0]) if up < 0 else rate[j][votes[:, up]]
                             for j, up in enumerate(parents)], axis=1)
            fire = np.clip(fire, 1e-6, 1 - 1e-6)
            a = self.accuracy[c]
            log.append(np.where(votes == 1, np.log(fire), np.log(1 - fire)).sum(axis=1)
                       + np.log(self.prior if c else 1 - self.prior)
                       + np.where(notes == c, np.log(a), np.where(notes == 1 - c, np.log(1 - a), 0.0)))
        return 1 / (1 + np.exp(np.clip(log[0] - log[1], -60, 60)))


# ---------------------------------------------------------------- classifier

def logistic(columns: np.ndarray, lengths: np.ndarray, n_columns: int, target: np.ndarray, weight: np.ndarray,
             rounds: int = 400, rate: float = 0.1, l2: float = 5e-5) -> tuple[np.ndarray, float]:
    """Weights and offset for rows of present columns, soft targets, by Adam on all rows."""
    w, b = np.zeros(n_columns + 1), 0.0
    row = np.repeat(np.arange(len(lengths)), lengths)
    m, v = np.zeros(n_columns + 1), np.zeros(n_columns + 1)
    weight = weight / max(weight.sum(), 1e-12)
    for t in range(1, rounds + 1):
        z = np.bincount(row, w[columns], len(lengths)) + w[-1]
        err = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - target) * weight
        g = np.append(np.bincount(columns, err[row], n_columns), err.sum()) + l2 * np.append(w[:-1], 0)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-9)
    return w[:-1], float(w[-1])


# ---------------------------------------------------------------- operator

def _annotated(labels: DataFrame, key: str, label: str) -> DataFrame:
    return labels.where(qcol(key).isNotNull() & qcol(label).isNotNull()).groupBy(qcol(key).cast("long").alias("_id")).agg(
        F.max(qcol(label)).cast("int").alias("note"))


def sampled_ids(notes: DataFrame, per_note: int, seed: str) -> DataFrame:
    """At most about ``per_note`` ids of each note, by hash; (``_id``, ``note``)."""
    n = {r["note"]: r["count"] for r in notes.groupBy("note").count().collect()}
    share = F.lit(0.0)
    for note, count in n.items():
        share = F.when(F.col("note") == note, F.lit(min(1.0, per_note / count))).otherwise(share)
    return notes.where(hash_uniform(seed, "_id") < share)


def learn_terms(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic",
                sample: int = SAMPLE) -> tuple[Terms, DataFrame]:
    """The vocabulary from a bounded sample, and the sample's (``_id``, ``note``).

    Terms are counted by documents and annotation in Spark; the VOCABULARY
    terms that tell most are kept, and the MINED that speak most for toxicity.
    """
    train = docs.select(qcol(key).cast("long").alias("_id"), utf8(qcol(text)).alias("body"))
    notes = _annotated(labels, key, label)
    noted = train.select("_id").where("_id is not null").distinct().join(notes, "_id", "left") \
        .select("_id", F.coalesce("note", F.lit(-1)).alias("note"))
    ids = store(sampled_ids(noted, sample, "toxic-sample"), "toxic-sample")
    rows = {r["note"]: r["count"] for r in ids.groupBy("note").count().collect()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[int, Counter] = {}
            for body, note in zip(batch.column(0), batch.column(1).to_pylist()):
                counts.setdefault(note, Counter()).update(terms_of(words_of(body.as_py())))
            for note, own in counts.items():
                yield pa.RecordBatch.from_arrays([pa.array(list(own), pa.binary()), pa.array([note] * len(own), pa.int32()),
                                                  pa.array(list(own.values()), pa.int64())], ["term", "note", "n"])

    counted = train.join(F.broadcast(ids), "_id").select("body", "note").mapInArrow(run, "term binary, note int, n long") \
        .groupBy("term").agg(F.sum("n").alias("n"), *[
            F.coalesce(F.sum(F.when(F.col("note") == k, F.col("n"))), F.lit(0)).alias(name) for k, name in ((1, "bad"), (0, "good"))])
    share = lambda c, k: F.log((F.col(c) + 0.5) / F.lit(rows.get(k, 0) + 1.0))
    top = counted.where(F.col("n") >= MIN_DOCS).withColumn("lift", share("bad", 1) - share("good", 0)) \
        .orderBy(F.desc(F.abs("lift") * F.sqrt(F.col("bad") + F.col("good"))), "term").limit(VOCABULARY).toPandas()
    top["term"] = [bytes(t) for t in top["term"]]
    strong = top[(top["bad"] >= max(MIN_DOCS, 0.002 * rows.get(1, 0))) & (top["lift"] > 2.5)].head(MINED)
    mined = {t: zlib.crc32(t) % MINED_VOTERS for t in strong["term"]}
    return Terms({t: i for i, t in enumerate(top["term"])}, mined), ids


def featurize(docs: DataFrame, terms: Terms, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, votes, columns of the vocabulary that occur) of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)  # at most VOCABULARY terms

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            votes, columns = [], []
            for body in batch.column(1):
                own = words_of(body.as_py())
                found = known(own)
                votes.append(fixed_votes(body.as_py(), own) | known.votes(own, found))
                columns.append(np.array(sorted(known.column[t] for t in found), np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(votes, pa.int32()), list_array(columns, pa.int32())],
                                             [key, "votes", "columns"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(qcol(key), utf8(qcol(text)).alias("body")).mapInArrow(
        run, f"`{key}` {kind}, votes int, columns array<int>")


def fit(features: DataFrame, labels: DataFrame, terms: Terms, sample_ids: DataFrame, key: str = "doc_id",
        label: str = "toxic") -> tuple[np.ndarray, np.ndarray, float]:
    """(term weights, vote weights, offset): the label model over all rows, the classifier on the sample."""
    rows = features.select(qcol(key).cast("long").alias("_id"), "votes", "columns")
    counts = rows.join(_annotated(labels, key, label), "_id", "left").groupBy(
        "votes", F.coalesce("note", F.lit(-1)).alias("note")).count().toPandas()  # at most 3 * 2 ** voters rows
    model = LabelModel().fit(counts["votes"].to_numpy(np.int64), counts["note"].to_numpy(np.int64), counts["count"].to_numpy())
    # the bounded sample: a row an id (of several the smallest), whatever repeats
    got = rows.join(F.broadcast(sample_ids), "_id").groupBy("_id", "note").agg(
        F.min(F.struct("votes", "columns")).alias("row")).select("_id", "note", "row.*").orderBy("_id").toArrow()
    note, codes = (got.column(c).to_numpy().astype(np.int64) for c in ("note", "votes"))
    target = model.posterior(codes, note)
    lengths = got.column("columns").combine_chunks().value_lengths().to_numpy().astype(np.int64)
    flat = got.column("columns").combine_chunks().flatten().to_numpy().astype(np.int64)
    n_terms, n_votes = len(terms.column), len(VOTERS)
    fired_row, fired = np.nonzero(_patterns(codes, n_votes))
    row_of = np.append(np.repeat(np.arange(len(lengths)), lengths), fired_row)
    column = np.append(flat, n_terms + fired)
    order = np.argsort(row_of, kind="stable")
    # the sample has as many rows of each note; weigh them as in the corpus
    share = counts.groupby("note")["count"].sum()
    weight = np.array([share.get(k, 0) / max(1, (note == k).sum()) for k in note]).reshape(-1)
    weight = np.minimum(weight, 20 * np.median(weight)) if len(weight) else weight
    w, offset = logistic(column[order], np.bincount(row_of, minlength=len(lengths)), n_terms + n_votes, target, weight)
    return w[:n_terms], w[n_terms:], offset


def score(features: DataFrame, model, key: str = "doc_id") -> DataFrame:
    """(key, score) of every row of ``featurize``."""
    shared = features.sparkSession.sparkContext.broadcast(model)  # at most VOCABULARY weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, vote_weights, offset = shared.value
        weights = np.append(weights, 0.0)
        for batch in batches:
            columns = batch.column(2)
            lengths = columns.value_lengths().to_numpy().astype(np.int64)
            z = np.bincount(np.repeat(np.arange(len(lengths)), lengths), weights[columns.flatten().to_numpy()], len(lengths))
            z = z + offset + _patterns(batch.column(1).to_numpy().astype(np.int64), len(VOTERS)) @ vote_weights
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-np.clip(z, -40, 40))))], [key, "score"])

    return features.select(qcol(key), "votes", "columns").mapInArrow(
        run, f"`{key}` {features.schema[key].dataType.simpleString()}, score double")


def op1_weak_supervision_toxicity(spark, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    learn = fold("doc_id", 5) != 0
    labels = table(spark, sf_dir, "labels").where(learn)
    terms, ids = learn_terms(docs.where(learn), labels)
    features = store(featurize(docs, terms), "toxic-features")
    model = fit(features.where(learn), labels, terms, ids)
    return score(features, model).select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score",
                                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
