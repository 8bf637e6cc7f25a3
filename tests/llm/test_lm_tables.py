"""Bigram tables of operator 7 against a brute-force model over real words."""

import math
import re
from collections import Counter

from strata.llm import lm_score, lm_tables

from .helpers import PROSE, SMALL, doc, frame, odd_rows


def plain_scores(rows, targets):
    """(n, target loss, background loss) of each (doc_id, text), by dictionaries of words."""
    found = [(i, re.findall(rb"[a-z0-9\x80-\xff]+", re.sub(rb"[A-Z]", lambda m: m.group().lower(),
                                                           (t or "").encode()))) for i, t in rows]
    words = {w for _, ws in found for w in ws}
    models = []
    for chosen in ([ws for i, ws in found if i in targets], [ws for _, ws in found]):
        pair = Counter(p for ws in chosen for p in zip([b""] + ws, ws))
        one, context, kinds = Counter(), Counter(), Counter()
        for (v, w), n in pair.items():
            one[w] += n
            context[v] += n
            kinds[v] += 1
        models.append((pair, one, context, kinds, sum(one.values()) + 0.1 * len(words)))
    out = []
    for _, ws in found:
        losses = []
        for pair, one, context, kinds, total in models:
            logs = [math.log((pair[v, w] + (kinds[v] + 1) * (one[w] + 0.1) / total) / (context[v] + kinds[v] + 1))
                    for v, w in zip([b""] + ws, ws)]
            losses.append(-sum(logs) / len(logs) if logs else None)
        out.append((len(ws), *losses))
    return out


def agree(spark, rows, targets):
    ids = spark.createDataFrame([(i,) for i in targets], "doc_id long")
    got = lm_score.cross_entropy_difference(frame(spark, rows), ids).collect()
    want = plain_scores([r[:2] for r in rows], set(targets))
    key = lambda r: tuple(-1e9 if x is None else round(x, 9) for x in r)
    got = sorted((key((r["doc_id"], r["n_tokens"], r["target_loss"], r["background_loss"])) for r in got))
    want = sorted(key((r[0], *w)) for r, w in zip(rows, want))
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:2] == w[:2] and all(math.isclose(a, b, rel_tol=1e-7, abs_tol=1e-7) for a, b in zip(g, w))


def test_scores_equal_brute_force(spark, monkeypatch):
    agree(spark, odd_rows(), [7, 9])
    table = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    rows = [doc(r["doc_id"], r["text"]) for r in table]
    agree(spark, rows, [r[0] for r in rows if r[0] % 3 == 0])
    # ranks and parts say where a count is looked up, not what it is
    monkeypatch.setattr(lm_tables, "HEAD_WORDS", 40)
    monkeypatch.setattr(lm_tables, "PART_TOKENS", 300)
    agree(spark, rows[:60], [r[0] for r in rows[:60:2]])
    monkeypatch.setattr(lm_tables, "MOST_BUCKETS", 3)
    monkeypatch.setattr(lm_score, "BROADCAST_IDS", 2)
    monkeypatch.setattr(lm_tables, "HEAD_WORDS", 2000)
    agree(spark, rows[:40] + rows[:7], [r[0] for r in rows[:40:2]])


def test_no_rows_no_targets_equal_slices(spark):
    agree(spark, [], [1])
    agree(spark, [doc(1, None), doc(None, "")], [1])
    agree(spark, odd_rows()[:11], [])
    # equal rows in several partitions make slices of one name
    ids = spark.createDataFrame([(1,)], "doc_id long")
    rows = [doc(1, "a b c"), doc(2, "b c d")]
    several = frame(spark, rows).coalesce(1).union(frame(spark, rows).coalesce(1))
    got = sorted((r["doc_id"], r["n_tokens"], r["score"]) for r in lm_score.cross_entropy_difference(several, ids).collect())
    assert len(got) == 4 and got[0] == got[1] and got[2] == got[3] and got[0][2] < got[2][2]


def test_rare_words_keep_their_bigrams(spark):
    """The same rare words in another order: only their bigrams tell the documents apart."""
    common = " ".join(f"c{i}" for i in range(2000))
    rows = [doc(i, common) for i in range(3)]
    rows += [doc(10 + i, "zarf quon mibble trosk") for i in range(4)]
    rows += [doc(20 + i, "trosk mibble quon zarf") for i in range(4)] + [doc(30, PROSE)]
    ids = spark.createDataFrame([(10 + i,) for i in range(4)], "doc_id long")
    said = {r["doc_id"]: r for r in lm_score.cross_entropy_difference(frame(spark, rows), ids).collect()}
    assert said[10]["target_loss"] < said[20]["target_loss"] - 0.5
