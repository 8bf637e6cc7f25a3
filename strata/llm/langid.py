"""Hierarchical language identification (operator 1).

A softmax model over hashed byte trigrams predicts the language family; inside
the family, one-versus-one linear support vector machines (squared hinge loss)
separate the closely related languages by vote.  Everything is learned from
``text`` and ``lang`` of the training rows; prediction reads the text alone.

The training sample is bounded: about ``per_language`` rows of each language
(a hash of doc_id chooses them, all rows where there are fewer), as sparse
counts.  Prediction is one pass over the whole texts with no shuffle.

Defined results: null text or text without a letter: ``und`` with score 0;
no training rows: ``und`` with score 0 everywhere; a single language: that
one; ties between languages go to the one first in alphabetical order.

The pipeline stage also asks whether the text looks like the language that the
model chose, since every choice is the best of the learned ones even for junk:
the mean log probability of its trigrams under the language's own counts must
reach a cut halfway between what the language's training rows reach, each left
out of the counts in turn, and what evenly spread trigrams reach.  A language
with fewer than ``CALIBRATION_ROWS`` rows has no cut.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textscan import LOWER, crc_class, map_texts, text_buffer

#: Training rows of each language, and of all languages together, at most (about): beyond 20
#: languages each gets fewer.  Every language is learned, from its LEAST_ROWS rows at the least.
PER_LANGUAGE, ALL_LANGUAGES, LEAST_ROWS = 1200, 24_000, 8
#: Languages up to this many go to every task with their shares.
BROADCAST_LANGUAGES = 100_000
DIMENSIONS = 1 << 12
UNKNOWN = "und"
#: Score below which the pipeline stage rejects a document.
REJECT_BELOW = 0.2
#: Rows of a language that its cut needs; share of them that may lie below the start of the margin.
CALIBRATION_ROWS, LOW_SHARE = 20, 0.005

# Language codes by family (ISO 639-1).
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is fy af lb yi",
    "romance": "fr es it pt ro ca gl oc la",
    "slavic": "ru uk be pl cs sk sl hr sr bs bg mk",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz ky tk",
    "indic": "hi bn mr gu pa ur ne sa",
    "semitic": "ar he mt am",
    "sinitic": "zh yue wuu",
}
_FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

_FOLD = LOWER.copy()
_FOLD[:128][~((LOWER[:128] >= 97) & (LOWER[:128] <= 122))] = 32
_LETTER = re.compile(r"[^\W\d_]")


def family_of(lang: str) -> str:
    """The family of a language code; a code outside the table is its own family."""
    return _FAMILY.get(lang.split("-")[0].lower(), f"lang:{lang}")


def trigram_counts(texts: pa.Array) -> np.ndarray:
    """Hashed counts of byte trigrams (case folded, non-letters as blanks), one row per text."""
    data, rows = text_buffer(texts)
    b = _FOLD[data].astype(np.uint32)
    n = max(0, len(b) - 2)
    code = (b[:n] << np.uint32(16)) | (b[1:n + 1] << np.uint32(8)) | b[2:n + 2]
    slot = ((code * np.uint32(0x9E3779B1)) >> np.uint32(20)).astype(np.int16)
    blank = code == np.uint32(0x202020)
    out = np.zeros((len(rows) - 1, DIMENSIONS), np.float32)
    for i, (a, z) in enumerate(zip(rows[:-1].tolist(), rows[1:].tolist())):
        if z - a > 2:
            out[i] = np.bincount(slot[a:z - 2][~blank[a:z - 2]], minlength=DIMENSIONS)
    return out


def scaled(counts: np.ndarray) -> np.ndarray:
    """Square roots of the counts, each row at length one."""
    x = np.sqrt(counts)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def _descend(gradient, start: np.ndarray, steps: int, rate: float) -> np.ndarray:
    """Nesterov's accelerated gradient descent."""
    w, ahead = start, start
    for k in range(steps):
        after = ahead - rate * gradient(ahead)
        ahead = after + k / (k + 3) * (after - w)
        w = after
    return w


def fit_svm(x: np.ndarray, y: np.ndarray, penalty: float = 1e-4, steps: int = 120) -> np.ndarray:
    """Linear SVM weights (bias last) for y in {-1, 1}; classes weigh the same."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(x.dtype)

    def gradient(w):
        slack = np.maximum(0, 1 - y * (x @ w))
        return penalty * w - 2 * (x.T @ (share * y * slack))
    return _descend(gradient, np.zeros(x.shape[1], x.dtype), steps, 0.25)


def fit_softmax(x: np.ndarray, y: np.ndarray, classes: int, penalty: float = 1e-5,
                steps: int = 150) -> np.ndarray:
    """Multinomial logistic weights (classes x dimensions, bias last); classes weigh the same."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    hot = np.eye(classes, dtype=x.dtype)[y]
    share = (hot / np.maximum(1, hot.sum(axis=0)) / classes).sum(axis=1, keepdims=True).astype(x.dtype)

    def gradient(w):
        return penalty * w + ((_softmax(x @ w.T) - hot) * share).T @ x
    return _descend(gradient, np.zeros((classes, x.shape[1]), x.dtype), steps, 1.0)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


@dataclass
class LanguageModel:
    families: list[str] = field(default_factory=list)
    family_weights: np.ndarray | None = None
    #: languages of each family, and SVM weights of each pair (first against second)
    members: dict[str, list[str]] = field(default_factory=dict)
    pairs: dict[tuple[str, str], np.ndarray] = field(default_factory=dict)
    #: of each language: log probability of each trigram slot, its variance, and the cut
    profiles: dict[str, tuple[np.ndarray, float, float]] = field(default_factory=dict)

    def typical(self, counts: np.ndarray, lang: np.ndarray) -> np.ndarray:
        """Whether each text looks like its language; no trigram or no cut: yes."""
        out = np.ones(len(counts), bool)
        for name, (logs, variance, cut) in self.profiles.items():
            rows = np.flatnonzero((lang == name) & (counts.sum(axis=1) > 0))
            out[rows] = _typicality(counts[rows] @ logs, counts[rows].sum(axis=1), variance) >= cut
        return out

    def predict(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Languages and scores (the family's probability times the language's in it)."""
        n = len(counts)
        lang, score = np.full(n, UNKNOWN, object), np.zeros(n)
        if not self.families or n == 0:
            return lang, score
        x = scaled(counts)
        x = np.hstack([x, np.ones((n, 1), x.dtype)])
        if len(self.families) == 1:
            chance = np.ones((n, 1))
        else:
            chance = _softmax((x @ self.family_weights.T).astype(float))
        chosen = chance.argmax(axis=1)
        for f, name in enumerate(self.families):
            rows = np.flatnonzero(chosen == f)
            langs = self.members[name]
            if len(rows) == 0:
                continue
            votes = np.zeros((len(rows), len(langs)))
            belief = np.zeros((len(rows), len(langs)))
            for (p, q), w in ((k, w) for k, w in self.pairs.items() if k[0] in langs):
                i, j = langs.index(p), langs.index(q)
                sure = 1 / (1 + np.exp(-4.0 * (x[rows] @ w).astype(float)))
                votes[:, i] += sure >= 0.5
                votes[:, j] += sure < 0.5
                belief[:, i] += sure
                belief[:, j] += 1 - sure
            best = (votes + belief / (len(langs) + 1)).argmax(axis=1)
            inside = belief[np.arange(len(rows)), best] / max(1, len(langs) - 1) if len(langs) > 1 else 1.0
            lang[rows] = np.array(langs, object)[best]
            score[rows] = chance[rows, f] * inside
        return lang, score


def _typicality(total: np.ndarray, n: np.ndarray, variance: float) -> np.ndarray:
    """Mean log probability of n trigrams, plus two standard deviations of the mean for short texts."""
    return total / n + 2 * np.sqrt(variance / n)


def _profile(counts: np.ndarray) -> tuple[np.ndarray, float, float] | None:
    """Trigram log probabilities of a language's rows, their variance and the cut; None if it can't be set."""
    counts = counts[counts.sum(axis=1) > 0].astype(np.float32)
    if len(counts) < CALIBRATION_ROWS:
        return None
    total, n = counts.sum(axis=0, dtype=float) + 0.5, counts.sum(axis=1, dtype=float)
    chance = total / total.sum()
    logs = np.log(chance)
    variance = float(chance @ logs ** 2 - (chance @ logs) ** 2)
    others = np.array([c @ np.log(total - c) for c in counts]) - n * np.log(total.sum() - n)
    low, junk = np.quantile(_typicality(others, n, variance), LOW_SHARE), logs.mean()
    return (logs, variance, float(low + junk) / 2) if low > junk else None


def _sparse_counts(piece: pa.RecordBatch) -> pa.RecordBatch:
    counts = trigram_counts(piece.column("text"))
    row, slot = np.nonzero(counts)
    at = np.searchsorted(row, np.arange(len(counts) + 1)).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [piece.column("lang"), pa.ListArray.from_arrays(at, pa.array(slot.astype(np.int32))),
         pa.ListArray.from_arrays(at, pa.array(counts[row, slot]))], ["lang", "slots", "counts"])


def fit(rows: DataFrame, per_language: int = PER_LANGUAGE) -> LanguageModel:
    """Learn from ``rows(doc_id, text, lang)``; rows without text or lang are left out."""
    rows = rows.select("doc_id", "text", "lang").where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n"))
    languages = sizes.count()
    model = LanguageModel()
    if not languages:
        return model
    most = min(per_language, max(LEAST_ROWS, ALL_LANGUAGES // languages))
    chosen = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) < F.col("share")
    shares = sizes.select("lang", F.least(F.lit(1.0), most / F.col("n")).alias("share"))
    shares = shares.withColumn("share", F.floor(F.col("share") * (1 << 30)))  # one row a language
    if languages <= BROADCAST_LANGUAGES:  # else by a shuffle, which AQE splits at hot languages
        shares = F.broadcast(shares)
    sample = map_texts(rows.join(shares, "lang").where(chosen).select("doc_id", "text", "lang"), _sparse_counts,
                       "lang string, slots array<int>, counts array<float>").toArrow()
    lang = np.array(sample.column("lang").to_pylist(), object)
    lists = sample.column("slots").combine_chunks()
    at = lists.offsets.to_numpy()
    x = np.zeros((len(lang), DIMENSIONS), np.float32)
    x[np.repeat(np.arange(len(lang)), np.diff(at)), lists.flatten().to_numpy()] = \
        sample.column("counts").combine_chunks().flatten().to_numpy()
    langs = sorted(set(lang))
    model.profiles = {name: p for name in langs if (p := _profile(x[lang == name])) is not None}
    x = scaled(x)
    family = {name: family_of(name) for name in langs}
    model.families = sorted(set(family.values()))
    model.members = {f: [name for name in langs if family[name] == f] for f in model.families}
    if len(model.families) > 1:
        y = np.array([model.families.index(family[name]) for name in lang])
        model.family_weights = fit_softmax(x, y, len(model.families))
    for names in model.members.values():
        for i, p in enumerate(names):
            for q in names[i + 1:]:
                rows_pq = np.flatnonzero((lang == p) | (lang == q))
                y = np.where(lang[rows_pq] == p, 1, -1).astype(np.float32)
                model.pairs[(p, q)] = fit_svm(x[rows_pq], y)
    return model


def predict(docs: DataFrame, model: LanguageModel, extra: list[str] | None = None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row of ``docs(doc_id, text)``."""
    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        lang, score = model.predict(trigram_counts(piece.column("text")))
        said = np.array([bool(t and _LETTER.search(t)) for t in piece.column("text").to_pylist()], bool)
        lang[~said], score[~said] = UNKNOWN, 0.0
        return pa.RecordBatch.from_arrays(
            [piece.column("doc_id").cast(pa.int64()), piece.column("held_out"),
             pa.array(lang, pa.string()), pa.array(score, pa.float64())],
            ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select("doc_id", (crc_class(F.col("doc_id"), 3) == 1).alias("held_out"), "text")
    return map_texts(rows, work, "doc_id long, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    """Learn on the rows that aren't held out, then predict every row."""
    return predict(docs, fit(docs.where(crc_class(F.col("doc_id"), 3) != 1)))


def keep_identified(docs: DataFrame, below: float = REJECT_BELOW) -> DataFrame:
    """Drop documents without an identifiable language; all columns unchanged."""
    model = fit(docs.where(crc_class(F.col("doc_id"), 3) != 1))

    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        counts = trigram_counts(piece.column("text"))
        lang, score = model.predict(counts)
        said = np.array([bool(t and _LETTER.search(t)) for t in piece.column("text").to_pylist()], bool)
        return piece.filter(pa.array(said & (lang != UNKNOWN) & (score >= below) & model.typical(counts, lang)))

    return map_texts(docs, work, docs.schema)
