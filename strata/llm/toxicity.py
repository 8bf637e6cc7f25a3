"""Toxicity by weak supervision (operator 5).

Many voters look at a document: fixed insult words, word stems and words that
a bounded sample of the labelled rows marks as toxic, and patterns over them.
A generative label model (a two-class latent model fitted by expectation
maximisation) estimates how often each voter fires in either class, without
labels; voters that fire together beyond what the class explains share their
weight.  A logistic classifier over word and stem features is trained on its
posterior labels, and isotonic regression calibrates it on the sample's labels.

The sample holds about SAMPLE labelled documents that aren't held out, each
text once; everything that reaches the driver is bounded by it, by VOTERS and
by FEATURES.  Scoring is one pass over the whole texts with no shuffle.

Defined results: null and empty texts get the score of a text without any
known word; without labelled rows every score is 0; repeated label rows of a
document count as its largest label.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .quality import pool_adjacent
from .textscan import LETTER, LOWER, Words, crc_class, map_texts, share_of, text_buffer

SAMPLE, VOTERS, FEATURES = 9_000, 160, 256
#: A mined word or stem occurs in LEAST toxic documents, and PURE of its documents are
#: toxic; of the CANDIDATES most frequent ones, those that explain more become voters.
LEAST, PURE, CANDIDATES = 4, 0.9, 2_000
ACCEPT = 0.3
#: Word stems are the first so many bytes of a word.
STEMS = (4, 6, 8)

# Words that insult, in four languages.
INSULTS = (
    "idiot idiots moron morons loser losers scum trash stupid pathetic worthless disgusting clown fool "
    "dumb dumbass imbecile jerk scumbag bastard bitch asshole crap shit fuck fucking bullshit retard "
    "vermin filth freak creep coward degenerate garbage "
    "idioten dummkopf arschloch abschaum scheisse scheiße trottel versager "
    "connard imbécile salaud ordure merde crétin abruti "
    "idiota estúpido imbécil basura mierda cabrón gilipollas tonto"
).split()

_SALT = np.random.default_rng(55).integers(1, 1 << 63, len(STEMS) + 1, dtype=np.uint64)


def _folded(data: np.ndarray) -> np.ndarray:
    """Lower-cased ASCII and Latin-1 letters (as UTF-8 bytes)."""
    out = LOWER[data]
    if len(out) > 1:
        after = np.zeros(len(out), bool)
        after[1:] = data[:-1] == 0xC3
        out[after & (out >= 0x80) & (out <= 0x9E) & (out != 0x97)] += 0x20
    return out


def word_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row and 64-bit feature of every word and stem, and the number of words of each row."""
    data, rows = text_buffer(texts)
    words = Words(_folded(data), rows, LETTER)
    row = np.repeat(np.arange(len(rows) - 1), np.diff(words.at))
    found_rows, found = [row], [words.hashes() ^ _SALT[0]]
    for k, size in enumerate(STEMS):
        long_enough = words.ends - words.starts >= size
        s = words.starts[long_enough]
        found_rows.append(row[long_enough])
        found.append(words.hashes(s, s + size) ^ _SALT[k + 1])
    return np.concatenate(found_rows), np.concatenate(found), np.diff(words.at)


def _insult_features() -> np.ndarray:
    rows, found, _ = word_features(pa.array(INSULTS))
    first = np.unique(rows, return_index=True)[1]  # whole words stand before their stems
    return np.unique(found[first])


def _sample_rows(piece: pa.RecordBatch) -> pa.RecordBatch:
    """Each document's distinct features, and a mark of its text."""
    row, found, _ = word_features(piece.column("text"))
    order = np.lexsort((found, row))
    row, found = row[order], found[order]
    first = np.ones(len(row), bool)
    first[1:] = (row[1:] != row[:-1]) | (found[1:] != found[:-1])
    row, found = row[first], found[first]
    at = np.searchsorted(row, np.arange(piece.num_rows + 1)).astype(np.int32)
    sums = np.concatenate([[0], np.cumsum(found)]).astype(np.uint64)
    return pa.RecordBatch.from_arrays(
        [piece.column("toxic"), pa.array((sums[at[1:]] - sums[at[:-1]]).view(np.int64)),
         pa.ListArray.from_arrays(at, pa.array(found.view(np.int64)))], ["toxic", "mark", "features"])


@dataclass
class ToxicityModel:
    features: np.ndarray | None = None  # sorted
    weights: np.ndarray | None = None
    bias: float = 0.0
    knots: np.ndarray | None = None
    values: np.ndarray | None = None

    def margins(self, n: int, row: np.ndarray, found: np.ndarray) -> np.ndarray:
        """Bias plus the weights of the known features that a row has (each once)."""
        known, at = _look_up(self.features, found)
        pair = np.unique(row[known] * len(self.features) + at)
        return self.bias + np.bincount(pair // len(self.features), self.weights[pair % len(self.features)], n)

    def score(self, n: int, row: np.ndarray, found: np.ndarray) -> np.ndarray:
        if self.features is None:
            return np.zeros(n)
        return np.interp(self.margins(n, row, found), self.knots, self.values)


def _look_up(table: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which values are in the sorted table (indices), and their places in it."""
    sieve = np.zeros(1 << 16, bool)
    sieve[table >> np.uint64(48)] = True
    maybe = np.flatnonzero(sieve[values >> np.uint64(48)])
    at = np.minimum(np.searchsorted(table, values[maybe]), len(table) - 1)
    hit = table[at] == values[maybe]
    return maybe[hit], at[hit]


def label_model(votes: np.ndarray, prior: float, steps: int = 40) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of the toxic class for each row of 0/1 votes, and each voter's share.

    A latent class of the given prior explains the votes.  A voter fires with
    one rate in each class and otherwise abstains; one more voter, for the
    clean class, fires where all others abstain.  After a first fit, the
    correlations of the voters within the classes give every voter the weight
    1 / (1 + mean positive correlation with the others that fire with it), and
    the fit is repeated with these weights.
    """
    silent = votes.sum(axis=1) == 0
    posterior = np.where(silent, prior / 4, 0.9)
    share = np.ones(votes.shape[1])
    for _ in range(2):
        for _ in range(steps):
            toxic, clean = posterior.sum() + 2, (1 - posterior).sum() + 2
            a = (posterior @ votes + 0.5) / toxic
            b = ((1 - posterior) @ votes + 0.01) / clean
            a = np.maximum(a, 2 * b)  # these voters vote for toxic, never against
            quiet = np.log((posterior[silent].sum() + 0.5) / toxic) \
                - np.log(((1 - posterior)[silent].sum() + 0.5) / clean)
            z = np.log(prior / (1 - prior)) + votes @ (share * np.log(a / b)) + silent * min(quiet, 0.0)
            posterior = 1 / (1 + np.exp(-np.clip(z, -50, 50)))
        rest = votes - (posterior[:, None] * a + (1 - posterior)[:, None] * b)
        size = np.maximum(np.sqrt((rest ** 2).mean(axis=0)), 1e-6)
        together = np.maximum((rest.T @ rest) / len(votes) / np.outer(size, size), 0)
        np.fill_diagonal(together, 0)
        share = 1 / (1 + together.sum(axis=1) / np.maximum(1, (together > 0.1).sum(axis=1)))
    return posterior, share


def _logistic(x: np.ndarray, p: np.ndarray, penalty: float = 2e-4, steps: int = 300) -> tuple[np.ndarray, float]:
    """Weights and bias for soft labels p by accelerated gradient descent."""
    n, d = x.shape
    x = np.hstack([x, np.ones((n, 1), x.dtype)])
    rate = 4.0 / max(1.0, float((x ** 2).sum(axis=1).mean()))
    w = ahead = np.zeros(d + 1)
    for k in range(steps):
        z = np.clip(x @ ahead, -30, 30)
        step = x.T @ (1 / (1 + np.exp(-z)) - p) / n + penalty * np.append(ahead[:d], 0)
        after = ahead - rate * step
        ahead = after + k / (k + 3) * (after - w)
        w = after
    return w[:d], float(w[d])


def _cover(has: np.ndarray, toxic: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Candidates (columns of ``has``) that explain toxic rows which no known word and no
    better candidate explains: a word that only goes along with another one adds none."""
    open_rows = (toxic > 0) & ~known.any(axis=1)
    chosen: list[int] = []
    while has.shape[1] and len(chosen) < VOTERS:
        adds = open_rows.astype(np.float32) @ has
        best = int(adds.argmax())
        if adds[best] < LEAST:
            break
        chosen.append(best)
        open_rows &= has[:, best] == 0
    return np.array(sorted(chosen), np.int64)


def _dense(rows: list[np.ndarray], table: np.ndarray) -> np.ndarray:
    """0/1 matrix: which of the table's features each row has."""
    out = np.zeros((len(rows), len(table)), np.float32)
    for i, r in enumerate(rows):
        if len(table) and len(r):
            out[i, _look_up(table, r)[1]] = 1
    return out


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> ToxicityModel:
    """Learn from ``docs(doc_id, text)`` and ``labels(doc_id, toxic)`` of the rows given."""
    known = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    total = known.count()
    if not total:
        return ToxicityModel()
    chosen = share_of(F.col("doc_id"), sample / total)
    some = docs.select("doc_id", "text").where(chosen).join(known.where(chosen), "doc_id").select("toxic", "text")
    rows = cut_lineage(map_texts(some, _sample_rows, "toxic int, mark long, features array<long>")
                       .dropDuplicates(["mark"]), "toxicity-sample")

    # stems and words that are nearly always in toxic documents
    candidates = (rows.select("toxic", F.explode("features").alias("f")).groupBy("f")
                  .agg(F.sum("toxic").alias("bad"), F.count("*").alias("n"))
                  .where((F.col("bad") >= LEAST) & (F.col("bad") >= PURE * F.col("n")))
                  .orderBy(F.desc("bad"), "f").limit(CANDIDATES).collect())
    table = rows.toArrow()
    if not table.num_rows:
        return ToxicityModel()
    toxic = table.column("toxic").to_numpy().astype(float)
    lists = table.column("features").combine_chunks()
    at, flat = lists.offsets.to_numpy(), lists.flatten().to_numpy().view(np.uint64)
    own = [flat[a:b] for a, b in zip(at[:-1], at[1:])]
    insults = _insult_features()
    mined = np.unique(np.array([r["f"] for r in candidates], np.int64).view(np.uint64))
    voters = np.unique(np.concatenate([insults, mined[_cover(_dense(own, mined), toxic, _dense(own, insults))]]))
    votes = _dense(own, voters)
    said = _dense(own, insults).sum(axis=1)
    patterns = np.stack([said >= 2, said >= 4, votes.sum(axis=1) >= 3], axis=1).astype(np.float32)
    posterior, _ = label_model(np.hstack([votes, patterns]),
                               float(np.clip(toxic.mean(), 0.01, 0.5)))
    # features whose rate differs most between the posterior classes
    features, which = np.unique(flat, return_inverse=True)
    in_row = np.repeat(posterior, np.diff(at))
    n = np.bincount(which, minlength=len(features))
    bad = np.bincount(which, in_row, len(features))
    base = posterior.mean()
    gap = np.abs(bad - n * base) / np.sqrt(n * base * (1 - base) + 1e-9)
    best = np.argsort(-np.where(n >= 3, gap, 0), kind="stable")[:FEATURES]
    model = ToxicityModel(np.unique(np.concatenate([features[best], voters])))
    x = _dense(own, model.features)
    model.weights, model.bias = _logistic(x, posterior)
    raw = x @ model.weights + model.bias
    step = np.rint(raw * 50) / 50
    model.knots, where, weight = np.unique(step, return_inverse=True, return_counts=True)
    model.values = pool_adjacent(np.bincount(where, toxic) / weight, weight.astype(float))
    return model


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        row, found, _ = word_features(piece.column("text"))
        s = model.score(piece.num_rows, row, found)
        return pa.RecordBatch.from_arrays(
            [piece.column("doc_id").cast(pa.int64()), piece.column("held_out"), pa.array(s),
             pa.array((s >= ACCEPT).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select("doc_id", (crc_class(F.col("doc_id"), 4) == 2).alias("held_out"), "text")
    return map_texts(rows, work, "doc_id long, held_out boolean, score double, predicted int")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score every document; learn from the labels that aren't held out."""
    return score(docs, fit(docs.where(crc_class(F.col("doc_id"), 4) != 2),
                           labels.where(crc_class(F.col("doc_id"), 4) != 2)))
