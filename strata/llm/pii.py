"""Personal data by candidate gradient boosting (operator 2).

Base rules find emails, IP addresses, card and phone numbers exactly as
stated, in time linear in the text.  Beside them, high-recall generators
propose overlapping spans (obfuscated mails, loose digit groups); boosted
trees score each proposal from its format and its context, and a proposal is
added if its score passes a threshold calibrated for its kind.

The trees learn without labels, from all documents: a proposal
that a base rule also found is positive, any other negative.  What the rules
themselves decide by (check digits, ranges, the at and plus signs) is hidden from
the features, and every base match is also shown rewritten into forms that no
rule finds (``rewritten``: spelt-out at signs and dots, no plus sign or country
code, other separators) in its own context, as a positive.  For counter-examples
plain words are joined by a spelt-out at and dot.  Proposals of equal features and
label are one row of a written table with their number, half of which is held out;
a level of a tree is one pass that adds up its histograms in the tasks.  A threshold is the
lowest of ``STEPS`` even scores from which on (positive + 1) / (all + 2) of the kind's held-out
proposals is at least ``PRECISION``, and 0.5 at least; a kind without one adds nothing.

Defined results: null or empty text has no spans; spans count code points.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_left
from collections import Counter
from dataclasses import dataclass, field
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import discard, written
from .textscan import map_texts

KINDS = ("email", "ip", "card", "phone")
PRECISION = 0.9
TREES, DEPTH, BINS, SHRINK = 30, 3, 16, 0.3
#: Scores that a threshold is chosen from, and rows that a task of a pass takes together.
STEPS, TASK_ROWS = 4096, 50_000

# The base patterns (kinds as listed).  Each is the stated one,
# written so that a start inside a run that has already failed isn't tried.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# high-recall generators
_AT = re.compile(r"@|＠|[\[({] ?at ?[\])}]|(?<= )at(?= )(?=.{1,40}?(?: dot |\[dot\]|\(dot\)))", re.I)
_LOOSE_DIGITS = re.compile(r"[0-9](?:[ ().\-/]{0,3}[0-9])++")
_DIGIT = re.compile(r"[0-9]")
# context words that hint at a kind
_HINTS = (re.compile(r"mail|contact|write|kontakt|correo", re.I), re.compile(r"\bip\b|host|server|addr", re.I),
          re.compile(r"card|visa|credit|karte|tarjeta|carte", re.I),
          re.compile(r"phone|call|tel|fax|mobile|fon\b", re.I))


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    # a mail's local part is the run before an @, from the last match on
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    return out


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    """(start, kind, end) of every base match, in order."""
    if not text:
        return []
    out = [(s, 0, e) for s, e in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        if "." in text:
            out += [(m.start(), 1, m.end()) for m in _IP.finditer(text)
                    if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255
                           for p in m.group().split("."))]
        for m in _CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text)
                    if 9 <= sum(c.isdigit() for c in m.group()) <= 15]
    return sorted(out)


def proposals(text: str | None) -> list[tuple[int, int, int]]:
    """(start, kind, end) of high-recall, possibly overlapping proposals."""
    if not text:
        return []
    out = []
    if "@" in text or "＠" in text or "at" in text and "dot" in text or "(at" in text or "[at" in text:
        for m in _AT.finditer(text):
            before = re.search(r"[^\s<>\"(),;:]{1,64} ?$", text[max(0, m.start() - 65):m.start()])
            after = re.match(r" ?[^\s<>\"(),;:]{1,80}(?: (?:dot|\[dot\]|\(dot\)) [^\s<>\"(),;:]{2,20})*",
                             text[m.end():m.end() + 200])
            if before and after:
                start = max(0, m.start() - 65) + before.start()
                out.append((start, 0, m.end() + len(after.group().rstrip(".!?"))))
    if _DIGIT.search(text):
        for m in _LOOSE_DIGITS.finditer(text):
            n = sum(c.isdigit() for c in m.group())
            if n < 7 or n > 24:
                continue
            start = m.start() - (m.start() > 0 and text[m.start() - 1] in "+(")
            if m.group().count(".") == 3 and n <= 12:
                out.append((m.start(), 1, m.end()))
            if 12 <= n <= 19:
                out.append((m.start(), 2, m.end()))
            if n <= 15:
                out.append((start, 3, m.end()))
    return out


FEATURES = 19
#: Signs that stand for an at sign or a dot in an obfuscated mail.
_SPELT_AT = re.compile(r" ?[\[({] ?at ?[\])}] ?| at |[@＠]", re.I)
_SPELT_DOT = re.compile(r" ?[\[(]dot[\])] ?| dot ", re.I)


def _features(text: str, start: int, kind: int, end: int) -> list[float]:
    body = text[start:end].lstrip("+(")
    if kind == 0:  # the address, however it is spelt
        body = _SPELT_DOT.sub(".", _SPELT_AT.sub("", body, count=1))
    digits = sum(c.isdigit() for c in body)
    groups = [len(g) for g in re.split(r"[^0-9]+", body) if g] or [0]
    before, after = text[max(0, start - 24):start], text[end:end + 12]
    prev, nxt = (before[-1:] or " ").lstrip("+("), after[:1] or " "
    return [float(v) for v in (
        kind, len(body), digits, len(groups), max(groups), min(groups), groups[0], groups[-1],
        body.count(" "), body.count("-"), body.count("."), body.count("(") + body.count(")"),
        sum(c.isalpha() for c in body), prev.isalpha(), prev.isdigit(),
        nxt.isalpha(), nxt.isdigit(), sum(c in "#*%&$=|" for c in before[-4:] + after[:4]),
        bool(_HINTS[kind].search(before)))]


def rewritten(kind: int, body: str) -> list[str]:
    """A base match in forms that mean the same and that the rules don't find."""
    if kind == 0:
        local, host = body.split("@", 1)
        dots = host.replace(".", " dot ")
        return [f"{local} (at) {dots}", f"{local} [at] {host}", f"{local} at {dots}", f"{local}＠{host}"]
    groups = re.findall(r"[0-9]+", body)
    if kind == 1:
        return [". ".join(groups), " .".join(groups)]
    if kind == 2:
        digits = "".join(groups)
        return [sign.join(digits[i:i + 4] for i in range(0, len(digits), 4)) for sign in (".", " - ", "/")]
    rest = body[1:].lstrip("0123456789").lstrip(" .-") if len(groups) > 1 else body[1:]
    return [body[1:], rest, "-".join(groups[1:] or groups), ".".join(groups), " ".join(groups[1:] or groups)]


def _examples(text: str, base: list[tuple[int, int, int]]) -> list[tuple[list[float], int]]:
    """Features and labels of rewritten base matches, and of plain words made to look like a mail."""
    new = [(s, kind, e, form) for s, kind, e in base for form in rewritten(kind, text[s:e])]
    words = list(_PLAIN.finditer(text, zlib.crc32(text[:64].encode("utf-8", "replace")) % max(1, len(text))))[:1]
    new += [(m.start(), -1, m.end(), f"{m[1]} {at} {m[2]} dot {m[3]}") for m in words for at in ("at", "(at)")]
    out = []
    for s, kind, e, form in new:
        shown = text[max(0, s - 90):s] + form + text[e:e + 30]
        start = min(s, 90)
        for a, k, b in proposals(shown):
            if a < start + len(form) and b > start:
                whole = a <= start + 1 and b >= start + len(form) - 1
                if whole or k != kind:
                    out.append((_features(shown, a, k, b), int(k == kind)))
    return out


#: Three plain words in a row.
_PLAIN = re.compile(r"\b([a-z]{2,12}) ([a-z]{2,12}) ([a-z]{2,12})\b")


def labelled_proposals(text: str | None) -> tuple[list[tuple[int, int, int]], list[list[float]], list[int]]:
    """Proposals with features, and whether a base rule found the same thing."""
    spans = proposals(text)
    if not spans:
        return [], [], []
    base = base_spans(text)
    found = [_Cover([b for b in base if b[1] == k]) for k in range(len(KINDS))]
    same = [int(found[kind].meets(s, e)) for s, kind, e in spans]
    return spans, [_features(text, *s) for s in spans], same


class _Cover:
    """Whether a span meets any of the given ones, in logarithmic time."""

    def __init__(self, spans: list[tuple[int, int, int]]):
        self.starts = [s for s, _, _ in spans]  # in order
        self.reach = list(accumulate((e for _, _, e in spans), max))

    def meets(self, start: int, end: int) -> bool:
        i = bisect_left(self.starts, end)
        return i > 0 and self.reach[i - 1] > start


@dataclass
class BoostedTrees:
    """Gradient-boosted trees of one depth for the logistic loss, as arrays."""
    prior: float = 0.0
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        f = np.full(len(x), self.prior)
        for feature, cut, leaf in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[np.arange(len(x)), feature[node]] > cut[node])
            f += leaf[node - (2 ** DEPTH - 1)]
        return 1 / (1 + np.exp(-f))


def _histograms(x: np.ndarray, y: np.ndarray, n: np.ndarray, cuts: list[np.ndarray], model: BoostedTrees,
                feature: np.ndarray, cut: np.ndarray, level: int) -> np.ndarray:
    """Rows, gradients and curvatures by (node of the level, feature, bin), each row ``n`` times."""
    p = model.score(x)
    node = np.zeros(len(x), np.int64)
    for _ in range(level):
        node = 2 * node + 1 + (x[np.arange(len(x)), feature[node]] > cut[node])
    start = (node - (2 ** level - 1)) * BINS
    out = np.zeros((3, 2 ** level, len(cuts), BINS))
    for j, q in enumerate(cuts):
        at = start + np.searchsorted(q, x[:, j], side="left")
        for i, weight in enumerate((n, n * (y - p), n * p * (1 - p))):
            out[i, :, j] = np.bincount(at, weight, 2 ** level * BINS).reshape(-1, BINS)
    return out


def _grow(rate: float, cuts: list[np.ndarray], sums_of) -> BoostedTrees:
    """Second-order boosting on bins; every tree is complete to DEPTH.

    ``sums_of(model, feature, cut, level)`` gives ``_histograms`` of all rows, one pass a level.
    """
    rate = min(max(rate, 1e-3), 1 - 1e-3)
    model = BoostedTrees(float(np.log(rate / (1 - rate))))
    inner = 2 ** DEPTH - 1
    for _ in range(TREES):
        feature, cut, leaf = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(inner + 1)
        for level in range(DEPTH):
            rows, grad, hess = sums_of(model, feature, cut, level)
            for i in range(2 ** level):
                n = 2 ** level - 1 + i
                best = (1e-6, 0, np.inf)
                whole_g, whole_h = grad[i, 0].sum(), hess[i, 0].sum()
                left_g, left_h = whole_g, whole_h
                for j, q in enumerate(cuts):
                    if rows[i, 0].sum() < 20 or len(q) == 0:
                        continue
                    g, h = np.cumsum(grad[i, j])[:len(q)], np.cumsum(hess[i, j])[:len(q)]
                    gain = (g ** 2 / (h + 1) + (whole_g - g) ** 2 / (whole_h - h + 1)) - whole_g ** 2 / (whole_h + 1)
                    k = int(gain.argmax())
                    if gain[k] > best[0]:
                        best = (float(gain[k]), j, float(q[k]))
                        left_g, left_h = g[k], h[k]
                _, feature[n], cut[n] = best
                if level == DEPTH - 1:
                    leaf[2 * i] = SHRINK * left_g / (left_h + 1)
                    leaf[2 * i + 1] = SHRINK * (whole_g - left_g) / (whole_h - left_h + 1)
        model.trees.append((feature, cut, leaf))
    return model


def fit_trees(x: np.ndarray, y: np.ndarray) -> BoostedTrees:
    """Trees over rows in memory, cut at quantiles."""
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    return _grow(float(y.mean()), cuts, lambda *state: _histograms(x, y, np.ones(len(x)), cuts, *state))


def _quantile_cuts(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The cuts that ``fit_trees`` makes of values that occur ``counts`` times each."""
    order = np.argsort(values)
    values, upto = values[order], np.cumsum(counts[order])
    at = np.linspace(0, 1, BINS + 1)[1:-1] * (upto[-1] - 1)
    low, high = (values[np.searchsorted(upto, f(at), side="right")] for f in (np.floor, np.ceil))
    return np.unique(low + (high - low) * (at - np.floor(at)))


@dataclass
class PiiModel:
    trees: BoostedTrees = field(default_factory=BoostedTrees)
    threshold: tuple[float, ...] = (2.0,) * len(KINDS)

    def extra(self, text: str | None, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """Proposals that pass their kind's threshold and that no base span holds or meets."""
        cover = _Cover(base)
        spans = [s for s in proposals(text) if not cover.meets(s[0], s[2])]
        if not spans or min(self.threshold) > 1:
            return []
        score = self.trees.score(np.array([_features(text, *s) for s in spans]))
        good = {s for s, p in zip(spans, score) if p >= self.threshold[s[1]]}
        return sorted(good)


def counted_proposals(docs: DataFrame) -> DataFrame:
    """(x, y, n, n_learn) of every document's proposals and examples: how many have features x and label y.

    ``n_learn`` of them are learnt from, the other half is held out.
    """
    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        found: Counter = Counter()
        for t in piece.column("text").to_pylist():
            _, rows, same = labelled_proposals(t)
            examples = _examples(t, base_spans(t)) if t else []
            found.update((tuple(map(int, x)), y) for x, y in [*zip(rows, same), *examples])
        return pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in found], pa.list_(pa.int32())), pa.array([k[1] for k in found], pa.int32()),
             pa.array(list(found.values()), pa.int64())], ["x", "y", "n"])

    odd = F.pmod(F.xxhash64("x", "y"), F.lit(2))
    return (map_texts(docs.select("text").where(F.col("text").isNotNull()), work, "x array<int>, y int, n long")
            .groupBy("x", "y").agg(F.sum("n").alias("n"))
            .withColumn("n_learn", F.floor((F.col("n") + odd) / 2)))


def _added(table: DataFrame, shape: tuple[int, ...], measure) -> np.ndarray:
    """``measure(x, y, n, n_learn)`` of all rows: summed up batch by batch in each task, then over the tasks."""
    def part(batches):
        rows = pa.Table.from_batches(batches).combine_chunks()
        x = rows.column("x").combine_chunks().flatten().to_numpy().astype(float).reshape(-1, FEATURES)
        return measure(x, *(rows.column(c).to_numpy().astype(float) for c in ("y", "n", "n_learn")))

    def run(batches):
        total, some = np.zeros(shape), []
        for batch in batches:
            some.append(batch)
            if sum(b.num_rows for b in some) >= TASK_ROWS:
                total += part(some)
                some = []
        if some:
            total += part(some)
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel()])], ["sums"])

    sums = table.mapInArrow(run, "sums array<double>").toArrow().column("sums")  # a few thousand numbers a task
    return sum((np.asarray(s.as_py()) for s in sums), np.zeros(int(np.prod(shape)))).reshape(shape)


def fit(docs: DataFrame) -> PiiModel:
    """Learn trees and thresholds from the proposals of all documents."""
    table, path = written(counted_proposals(docs), "pii-proposals")
    n_rows, least, most = table.select(F.count("*"), F.min("y"), F.max("y")).first()
    if n_rows < 2 or least == most:
        discard(docs.sparkSession, path)
        return PiiModel()
    table = table.coalesce(-(-n_rows // TASK_ROWS))
    total = F.sum("n_learn").alias("n")
    rate = table.select((F.sum(F.col("y") * F.col("n_learn")) / F.greatest(F.sum("n_learn"), F.lit(1)))).first()[0]
    # format features are small whole numbers, bounded by the length of a proposal
    values = (table.where("n_learn > 0").select(F.posexplode("x").alias("at", "value"), "n_learn")
              .groupBy("at", "value").agg(total).toArrow())
    at, value, n = (values.column(c).to_numpy() for c in ("at", "value", "n"))
    cuts = [_quantile_cuts(value[at == j].astype(float), n[at == j]) if (at == j).any() else np.zeros(0)
            for j in range(FEATURES)]

    def sums_of(model, feature, cut, level):
        return _added(table, (3, 2 ** level, FEATURES, BINS),
                      lambda x, y, n, n_learn: _histograms(x, y, n_learn, cuts, model, feature, cut, level))

    trees = _grow(float(rate), cuts, sums_of)

    def by_score(x, y, n, n_learn):
        slot = x[:, 0].astype(int) * (STEPS + 1) + np.floor(trees.score(x) * STEPS).astype(int)
        return np.stack([np.bincount(slot, w, len(KINDS) * (STEPS + 1)) for w in ((n - n_learn) * y, n - n_learn)])

    positive, every = _added(table, (2, len(KINDS), STEPS + 1), lambda *rows: by_score(*rows).reshape(2, -1, STEPS + 1))
    discard(docs.sparkSession, path)
    steps = np.arange(STEPS + 1) / STEPS
    return PiiModel(trees, tuple(_threshold(steps[n > 0], y[n > 0], n[n > 0]) for y, n in zip(positive, every)))


def _threshold(score: np.ndarray, y: np.ndarray, n: np.ndarray | None = None) -> float:
    """The lowest score, 0.5 at least, from which on PRECISION of the proposals are positive (with one more of either).

    ``y`` counts the positive ones of the ``n`` (one each by default) that have a score.
    """
    if len(y) == 0:
        return 2.0
    order = np.argsort(-score, kind="stable")
    n = np.ones(len(y)) if n is None else n
    good = (np.cumsum(y[order]) + 1) / (np.cumsum(n[order]) + 2)
    last = np.append(score[order][1:] != score[order][:-1], True)  # equal scores stand together
    fit_here = np.flatnonzero((good >= PRECISION) & last)
    return max(0.5, float(score[order][fit_here[-1]])) if len(fit_here) else 2.0


def _said(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def find_pii(docs: DataFrame, model: PiiModel | None = None) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of every document."""
    model = model or fit(docs)

    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        counts, sha, said = [[] for _ in KINDS], [], []
        for t in piece.column("text").to_pylist():
            base = base_spans(t)
            for k, c in enumerate(counts):
                c.append(sum(b[1] == k for b in base))
            sha.append(hashlib.sha256(_said(base).encode()).hexdigest())
            said.append(_said(sorted(base + model.extra(t, base))))
        return pa.RecordBatch.from_arrays(
            [piece.column("doc_id").cast(pa.int64()), *(pa.array(c, pa.int64()) for c in counts),
             pa.array(sha, pa.string()), pa.array(said, pa.string())],
            ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    return map_texts(docs.select("doc_id", "text"), work,
                     "doc_id long, n_email long, n_ip long, n_card long, n_phone long, "
                     "base_sha256 string, spans string")


def redact_text(text: str | None, spans: list[tuple[int, int, int]]) -> str | None:
    """Replace spans by their kind's mark; spans that meet become one, named by the first."""
    if not spans:
        return text
    out, done, end = [], 0, -1
    for s, k, e in sorted(spans):
        if s < end:
            end = max(end, e)
            continue
        if end >= 0:
            done = end
        out += [text[done:s], f"[{KINDS[k].upper()}]"]
        end = e
    return "".join(out) + text[end:]


def redact(docs: DataFrame, model: PiiModel | None = None) -> DataFrame:
    """``docs`` with personal data replaced in ``text`` (and n_chars, if any, counted anew)."""
    model = model or fit(docs)

    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        texts = []
        for t in piece.column("text").to_pylist():
            base = base_spans(t)
            texts.append(redact_text(t, base + model.extra(t, base)))
        at = piece.schema.get_field_index("text")
        piece = piece.set_column(at, piece.schema.field(at), pa.array(texts, piece.schema.field(at).type))
        at = piece.schema.get_field_index("n_chars")
        if at >= 0:
            size = pa.array([None if t is None else len(t) for t in texts], piece.schema.field(at).type)
            piece = piece.set_column(at, piece.schema.field(at), size)
        return piece

    return map_texts(docs, work, docs.schema)
