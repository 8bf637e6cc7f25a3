"""URL verdicts by rules and a character language-model ratio (operator 9).

Host, path and rule are plain column expressions.  Urls that a rule fits are
the examples: two variable-order Markov models (contexts of up to ORDER
symbols, each smoothed towards the next shorter one in the manner of Witten
and Bell; unseen contexts fall back on it) are counted over all accepted and
all rejected ones.  A url's score is the log-likelihood difference of the two
divided by its length; the threshold is calibrated on examples kept aside, as
the cut of least balanced error.  Urls without a rule get the method's verdict.

Symbols are 32 (letters without case, one digit class, a few marks), so the
tables have a fixed size (about a million cells) whatever the data hold.

Defined results: a null url, or one without "://", has an empty host and path
and no rule; it is scored by its text (null: allowed).  If examples of either
kind are missing, urls without a rule are allowed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .textscan import bounded_batches, map_texts, slices, text_buffer

# The rules (host and path), with their verdicts.
RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
ORDER, SYMBOLS = 3, 32
#: Examples whose hash falls in one of KEPT parts out of FOLDS set the threshold.
FOLDS, KEPT = 5, 1
STEP = 0.01

_EDGE = SYMBOLS - 1
_SYMBOL = np.full(256, 30, np.uint8)
_SYMBOL[97:123] = np.arange(26)
_SYMBOL[65:91] = np.arange(26)
_SYMBOL[48:58] = 26
for _mark, _value in ((".", 27), ("/", 28), ("-", 29), ("_", 29)):
    _SYMBOL[ord(_mark)] = _value
_OFFSET = np.cumsum([0, *(SYMBOLS ** (k + 1) for k in range(ORDER + 1))])


def _after_scheme(url: Column) -> Column:
    return F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))


def host_of(url: Column) -> Column:
    host = F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: dict[str, str] | None = None) -> Column:
    """The longest rule that fits, else null."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules or RULES, key=len):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def _contexts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Index (context and symbol, base SYMBOLS) at full order of every symbol, an edge
    symbol at the end included; and where each text's begin (one more at the end)."""
    data, rows = text_buffer(texts)
    n = len(rows) - 1
    at = rows + np.arange(n + 1)  # each text has one more symbol
    s = np.full(len(data) + n, _EDGE, np.int64)
    inside = np.ones(len(s), bool)
    inside[at[1:] - 1] = False
    s[inside] = _SYMBOL[data]
    place = np.arange(len(s)) - np.repeat(at[:-1], np.diff(at))
    index = s.copy()
    for k in range(1, ORDER + 1):
        before = np.concatenate([np.full(k, _EDGE, np.int64), s[:-k]])[:len(s)]
        index += np.where(place >= k, before, _EDGE) * SYMBOLS ** k
    return index, at


def _counted(rows: DataFrame) -> DataFrame:
    """(cell, allowed, blocked): counts of every order over ``rows(url, verdict)``."""
    bounded_batches(rows.sparkSession)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, SYMBOLS ** (ORDER + 1)), np.int64)
        for batch in batches:
            for piece in slices(batch, "url"):
                index, at = _contexts(piece.column("url"))
                good = np.repeat(np.array(piece.column("verdict").to_pylist()) == "allow", np.diff(at))
                for into, keys in zip(total, (index[good], index[~good])):
                    distinct, count = np.unique(keys, return_counts=True)
                    into[distinct] += count
        some = np.flatnonzero(total.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[0, some]), pa.array(total[1, some])],
                                         ["cell", "allowed", "blocked"])

    return (rows.select("url", "verdict").mapInArrow(part, "cell long, allowed long, blocked long")
            .groupBy("cell").agg(F.sum("allowed").alias("allowed"), F.sum("blocked").alias("blocked")))


def _log_model(counts: np.ndarray) -> np.ndarray:
    """log P(symbol | longest context) for every full-order cell."""
    lower = np.full(SYMBOLS, 1 / SYMBOLS)
    for k in range(ORDER + 1):
        # shorter contexts are the last k symbols, so longer histories are summed out
        table = counts.reshape(-1, SYMBOLS ** k, SYMBOLS).sum(axis=0)
        n, kinds = table.sum(axis=1, keepdims=True), (table > 0).sum(axis=1, keepdims=True)
        back = np.broadcast_to(lower, (SYMBOLS, *lower.shape)).reshape(-1, SYMBOLS) if k else lower[None, :]
        lower = np.where(n > 0, (table + kinds * back) / np.maximum(n + kinds, 1), back)
    return np.log(lower + 1e-12).ravel()


@dataclass
class UrlModel:
    ratio: np.ndarray | None = None
    threshold: float = -np.inf

    def score(self, texts: pa.Array) -> np.ndarray:
        if self.ratio is None:
            return np.zeros(len(texts))
        index, at = _contexts(texts)
        sums = np.concatenate([[0], np.cumsum(self.ratio[index].astype(float))])
        return (sums[at[1:]] - sums[at[:-1]]) / np.diff(at)


def _scored(rows: DataFrame, model: UrlModel) -> DataFrame:
    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        return piece.append_column("score", pa.array(model.score(piece.column("url"))))

    schema = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes) + ", score double"
    return map_texts(rows, work, schema, column="url")


def fit(rows: DataFrame) -> UrlModel:
    """Learn from ``rows(page_id, url, verdict)``, the examples."""
    rows = rows.where(F.col("url").isNotNull()).select(
        "url", "verdict", (F.pmod(F.xxhash64("url"), F.lit(FOLDS)) < KEPT).alias("aside"))
    counts = _counted(rows.where(~F.col("aside"))).toArrow()
    total = np.zeros((2, SYMBOLS ** (ORDER + 1)))
    cell = counts.column("cell").to_numpy()
    total[0, cell] = counts.column("allowed").to_numpy()
    total[1, cell] = counts.column("blocked").to_numpy()
    if not total[0].any() or not total[1].any():
        return UrlModel()
    model = UrlModel((_log_model(total[0]) - _log_model(total[1])).astype(np.float32))
    grid = (_scored(rows.where("aside"), model)
            .groupBy(F.round(F.col("score") / STEP).cast("long").alias("step"))
            .agg(F.sum((F.col("verdict") == "allow").cast("long")).alias("good"), F.count("*").alias("n"))
            .orderBy("step").collect())
    good = np.array([r["good"] for r in grid], float)
    bad = np.array([r["n"] for r in grid], float) - good
    if good.sum() == 0 or bad.sum() == 0:
        model.threshold = 0.0
        return model
    # blocking all steps below a cut: accepted urls lost, rejected ones let through
    wrong = (np.concatenate([[0], np.cumsum(good)]) / good.sum()
             + 1 - np.concatenate([[0], np.cumsum(bad)]) / bad.sum())
    best = np.flatnonzero(wrong == wrong.min())
    steps = np.array([r["step"] for r in grid], float)
    edges = np.concatenate([[steps[0] - 1], (steps[1:] + steps[:-1]) / 2, [steps[-1] + 1]])
    model.threshold = float(edges[best[len(best) // 2]] * STEP)
    return model


def judge(pages: DataFrame, rules: dict[str, str] | None = None) -> DataFrame:
    """``pages(page_id, url, ...)`` to (page_id, host, path, rule, verdict, score)."""
    rules = rules or RULES
    rows = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rows = rows.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    said = F.lit(None).cast("string")
    for rule, verdict in rules.items():
        said = F.when(F.col("rule") == rule, F.lit(verdict)).otherwise(said)
    rows = rows.withColumn("verdict", said)
    model = fit(rows.where(F.col("verdict").isNotNull()))
    own = F.when((F.col("score") >= F.lit(model.threshold)) | F.col("url").isNull(), "allow").otherwise("block")
    return (_scored(rows, model)
            .select("page_id", "host", "path", "rule", F.coalesce("verdict", own).alias("verdict"), "score"))
