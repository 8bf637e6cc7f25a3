"""Language ID, PII, decontamination and BPE against brute force or held-out rows."""

import hashlib
import itertools
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.llm import bpe, decontaminate, langid, pii

from .helpers import MEDIUM, PROSE, SMALL, doc, frame, odd_rows

# ---------------------------------------------------------------- language ID


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    truth = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    got = [r for r in langid.identify(docs).collect()]
    held = [r for r in got if r["held_out"]]
    assert len(got) == len(truth) and 200 < len(held) < 500
    assert np.mean([truth[r["doc_id"]] == r["lang_pred"] for r in held]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_odd_rows(spark):
    rows = odd_rows()
    got = langid.identify(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    said = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in got}
    for i in (1, 2, 3, 6):
        assert said[i] == ("und", 0.0)
    assert said[7] == ("en", 1.0)  # the only language there is
    assert langid.identify(frame(spark, [])).collect() == []
    unlabelled = frame(spark, [doc(1, PROSE, None), doc(2, PROSE, None)])
    assert {r["lang_pred"] for r in langid.identify(unlabelled).collect()} == {"und"}
    kept = langid.keep_identified(frame(spark, rows))
    assert kept.columns == frame(spark, []).columns
    assert {r["doc_id"] for r in kept.collect()} == {4, 5, 7, 8, 9, None, 11, 12, 13, 14}


# ---------------------------------------------------------------- PII


def luhn_ok(d):
    t = 0
    for i, c in enumerate(d[::-1]):
        x = int(c) * (1 + i % 2)
        t += x - 9 if x > 9 else x
    return t % 10 == 0


def plain_base(text):
    """The stated patterns as they stand, with finditer."""
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[ -]", "", m.group())
        if 12 <= len(d) <= 19 and luhn_ok(d):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


@settings(max_examples=600, deadline=None)
@given(st.text(alphabet="ab.@%-+ 0123456789()é_", max_size=60))
def test_base_spans_match_the_patterns(text):
    assert pii.base_spans(text) == plain_base(text)


def test_base_spans_of_planted_values():
    text = ("mail a.b+c%d@x-y.example.org, é 10.0.255.1 and 256.1.1.1; 4111 1111 1111 1111 or "
            "4111-1111-1111-1112, +1 (017) 555-7713. a@b.co%x@y.z 1.2.3.4.5.6.7.8")
    assert pii.base_spans(text) == plain_base(text)
    assert [k for _, k, _ in pii.base_spans(text)] == [0, 1, 2, 3, 0, 0, 1, 1]


@pytest.mark.parametrize("text", ["1" * 200_000, "a" * 200_000 + "@", "1." * 100_000, "+1" + "(" * 200_000,
                                  "@" * 100_000, "a@" * 50_000, "1 " * 100_000])
def test_long_runs_take_linear_time(text):
    pii.base_spans(text)
    pii.proposals(text)


def test_redaction_merges_spans_that_meet():
    text = "x a@b.co 4111 1111 1111 1111 y"
    base = pii.base_spans(text)
    assert pii.redact_text(text, base) == "x [EMAIL] [CARD] y"
    assert pii.redact_text(text, base + [(2, 3, 12)]) == "x [EMAIL] y"
    assert pii.redact_text(None, []) is None and pii.redact_text("", []) == ""


def test_trees_and_thresholds():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, pii.FEATURES))
    y = ((x[:, 3] > 0.2) & (x[:, 5] < 0.5)).astype(float)
    score = pii.fit_trees(x[:1000], y[:1000]).score(x[1000:])
    assert np.mean((score > 0.5) == (y[1000:] > 0.5)) > 0.95
    assert pii._threshold(np.array([.9, .2]), np.array([1., 0.])) == 2.0  # too few to judge
    s, t = np.linspace(1, 0, 100), np.array([1.0] * 60 + [0.0] * 40)
    cut = pii._threshold(s, t)
    assert t[s >= cut].mean() >= pii.PRECISION and cut >= 0.5


def test_learned_proposals_add_to_the_base(spark):
    """Phones in one format are the rule's but for a few without the plus sign."""
    rng = np.random.default_rng(5)
    rows = []
    for i in range(400):
        phone = f"({rng.integers(100, 999)}) 555-{rng.integers(1000, 9999)}"
        rows.append(doc(i, f"call me on phone {'+1 ' if i % 25 else ''}{phone} today"))
        rows.append(doc(1000 + i, f"ratio {rng.integers(10, 99)}/{rng.integers(1000, 9999)}/{rng.integers(10, 99)}"))
    got = {r["doc_id"]: r for r in pii.find_pii(frame(spark, rows)).collect()}
    assert all(got[i]["n_phone"] == (1 if i % 25 else 0) for i in range(400))
    added = [i for i in range(0, 400, 25) if got[i]["spans"]]
    assert len(added) >= 12
    assert not any(got[1000 + i]["spans"] for i in range(400))


def test_obfuscated_mails_are_added(spark):
    """No rule finds a spelt-out mail; the trees know its form and context from rewritten ones."""
    rng = np.random.default_rng(6)
    plain = "the look of old stones and the dot we saw later stays with us for long "
    rows = [doc(i, f"{plain}please write to mail user{rng.integers(10, 9999)}@host{i % 7}.example.com soon")
            for i in range(300)]
    spelt = ["name77 (at) host3 dot example dot com", "name77 [at] host3.example.com", "name77＠host3.example.com"]
    rows += [doc(1000 + i, f"{plain}please write to mail {form} soon") for i, form in enumerate(spelt)]
    rows += [doc(2000 + i, f"{plain}we look at stones dot nothing else {i}") for i in range(50)]
    got = {r["doc_id"]: r for r in pii.find_pii(frame(spark, rows)).collect()}
    assert all(got[i]["n_email"] == 1 and got[i]["spans"].count("email") == 1 for i in range(300))
    assert all(got[1000 + i]["n_email"] == 0 and got[1000 + i]["spans"].startswith("email:") for i in range(3))
    assert not any(got[2000 + i]["spans"] for i in range(50))


def test_every_document_teaches_the_trees(spark):
    """Counts of all proposals, however many documents hold them, and the cuts of all their values."""
    text = F.concat(F.lit("card "), F.col("id") % 3 + 1000, F.lit(" 5678 9012 3456 or write to a@b"), F.col("id") % 3, F.lit(".org"))
    docs = spark.range(45_000).select(F.col("id").alias("doc_id"), text.alias("text"))
    got = pii.counted_proposals(docs).agg(F.sum("n").alias("n"), F.sum("n_learn").alias("learn"), F.count("*").alias("rows"))
    one = [f"card {1000 + i} 5678 9012 3456 or write to a@b{i}.org" for i in range(3)]
    each = sum(len(pii.labelled_proposals(t)[0]) + len(pii._examples(t, pii.base_spans(t))) for t in one)
    got = got.first()
    assert got["n"] == 15_000 * each and abs(got["learn"] - got["n"] / 2) <= got["rows"]
    rng = np.random.default_rng(3)
    values, counts = np.arange(40.0), rng.integers(1, 9, 40)
    want = np.unique(np.quantile(np.repeat(values, counts), np.linspace(0, 1, pii.BINS + 1)[1:-1]))
    assert np.allclose(pii._quantile_cuts(values, counts), want)


def test_passes_over_a_table_grow_the_trees_of_rows_in_memory(spark):
    rng = np.random.default_rng(4)
    x = rng.integers(0, 9, (600, pii.FEATURES))
    x[:, 0] %= 4
    y = ((x[:, 3] > 4) & (x[:, 5] < 6)).astype(int)
    table = spark.createDataFrame([(r.tolist(), int(t), 2, 1) for r, t in zip(x, y)],
                                  "x array<int>, y int, n long, n_learn long").repartition(3)
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, pii.BINS + 1)[1:-1])) for c in x.T]
    state = pii.BoostedTrees(), np.array([3] + [0] * 6), np.array([4.0] + [np.inf] * 6), 1
    got = pii._added(table, (3, 2, pii.FEATURES, pii.BINS),
                     lambda x, y, n, n_learn: pii._histograms(x, y, n_learn, cuts, *state))
    assert np.allclose(got, pii._histograms(x.astype(float), y.astype(float), np.ones(600), cuts, *state))


def test_pii_query_matches_the_patterns(spark):
    rows = odd_rows() + [doc(50, "é a@b.co"), doc(51, "4111111111111111")]
    table = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    rows += [doc(10_000 + i, t) for i, t in table]
    found = pii.find_pii(frame(spark, rows)).collect()
    assert len(found) == len(rows)
    text = {r[0]: r[1] for r in rows}
    for r in found:
        base = plain_base(text[r["doc_id"]] or "")
        said = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in base)
        assert r["base_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [sum(b[1] == k for b in base) for k in range(4)]
        assert set(said.split(",")) <= set(r["spans"].split(","))
    assert pii.find_pii(frame(spark, [])).collect() == []
    clean = pii.redact(frame(spark, rows))
    assert clean.schema.simpleString() == frame(spark, []).schema.simpleString()
    new = {r["doc_id"]: r for r in clean.collect()}
    assert new[50]["text"] == "é [EMAIL]" and new[50]["n_chars"] == 9 and new[1]["text"] is None
    assert new[7]["text"] == PROSE


# ---------------------------------------------------------------- decontamination


def test_masks_hit_every_tolerated_window():
    ones = [[i for i, c in enumerate(m) if c == "1"] for m in decontaminate.MASKS]
    for window in range(decontaminate.SHORTEST, decontaminate.WINDOW + 1):
        for spoiled in itertools.combinations(range(window), decontaminate.tolerated(window)):
            assert any(all(at + o not in spoiled for o in mask)
                       for mask in ones for at in range(window - mask[-1]))


def plain_words(text):
    return re.findall(rb"[a-z0-9\x80-\xff]+", (text or "").encode().lower())


def plain_matches(docs, items):
    out = set()
    for d, text in docs:
        a = plain_words(text)
        for i, item in items:
            b = plain_words(item)
            w = min(decontaminate.WINDOW, len(b))
            if w < decontaminate.SHORTEST:
                continue
            known = set(b)
            sums = list(itertools.accumulate((t in known for t in a), initial=0))
            need = w - decontaminate.tolerated(w)
            for x in (x for x in range(len(a) - w + 1) if sums[x + w] - sums[x] >= need):
                if any(sum(p == q for p, q in zip(a[x:x + w], b[y:y + w])) >= w - decontaminate.tolerated(w)
                       for y in range(len(b) - w + 1)):
                    out.add((d, i))
                    break
    return out


def test_contamination_matches_brute_force(spark):
    words = PROSE.split()
    swapped = list(words)
    for at in (5, 11, 17, 23):
        swapped[at] = "other"
    far = [w if i % 3 else "no" for i, w in enumerate(words)]
    items = [(1, PROSE), (2, "three words only"), (3, None), (4, ""), (5, "Exactly five words stand here."),
             (6, PROSE), (None, PROSE), (7, "alpha beta gamma delta epsilon zeta eta theta iota")]
    docs = odd_rows() + [
        doc(30, "before " + " ".join(swapped) + " after"), doc(31, " ".join(far)), doc(32, " ".join(words[:15])),
        doc(33, "x exactly, FIVE words - stand here y"), doc(34, "exactly five words stood here"),
        doc(35, "three words only"), doc(36, "alpha beta gamma delta epsilon zeta eta theta kappa iota"),
        doc(37, " ".join(words[4:24])), doc(38, "alpha\nbeta gamma delta epsilon zeta eta, theta iota")]
    table = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    bench = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    docs += [doc(10_000 + i, t) for i, t in table]
    items += [(10_000 + i, t) for i, t in bench]
    benchmark = spark.createDataFrame([(i, t, 1.5) for i, t in items], "item_id long, text string, doc_id double")
    want = plain_matches([(d[0], d[1]) for d in docs], [(i, t) for i, t in items if i is not None])
    frame_ = frame(spark, docs)
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(frame_, benchmark).collect()}
    assert got == want and (30, 1) in got and (32, 1) not in got
    blocks = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(frame_, benchmark, 1500).collect()}
    assert blocks == want
    left = decontaminate.decontaminate(frame_, benchmark, 1500)
    assert left.columns == frame_.columns
    gone = {d for d, _ in want}
    assert sorted(str(r["doc_id"]) for r in left.collect()) == sorted(str(d[0]) for d in docs if d[0] not in gone)


def test_contamination_of_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = frame(spark, odd_rows())
    assert decontaminate.contaminated(docs, none).collect() == []
    assert decontaminate.decontaminate(docs, none).count() == len(odd_rows())
    one = spark.createDataFrame([(1, PROSE)], "item_id long, text string")
    assert decontaminate.contaminated(frame(spark, []), one).collect() == []


# ---------------------------------------------------------------- BPE


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.Bpe())


def check(library, encoder, texts):
    flat, at = encoder.encode(texts)
    numbers = encoder.joined(flat, at, encoder.numbers)
    tokens = encoder.joined(flat, at, encoder.tokens)
    for i, t in enumerate(texts):
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert flat[at[i]:at[i + 1]].tolist() == ids
        assert bytes(numbers[i]).decode() == " ".join(map(str, ids))
        want = library.decode(ids, skip_special_tokens=False)
        assert bytes(tokens[i]).decode() == want == bpe.decode(encoder.bpe, ids)


def test_bpe_of_chosen_texts(library, encoder):
    check(library, encoder, [
        None, "", " ", "Hello, World's  don't 123 éÉß ñ！", "<|startoftext|>a <|endoftext|> b<|ENDOFTEXT|><|x",
        "a\x1cb\x85c\x00d\x0be", "Σας ΑΣ Σ", "''s 'Re don't'll 'S's x'", "'", "'s", "1²½७", "ab" * 4000 + "the" * 700,
        "x" * 30_000, "İstanbul ﬁ ́a"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="abdelmrstvABÉéñß0129 '\n\t.,;!<>|-漢ёΩ😀", max_size=40), max_size=5))
def test_bpe_matches_the_library(library, encoder, texts):
    check(library, encoder, texts)


def test_bpe_forgets_when_full(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 20)
    small = bpe.Encoder(bpe.Bpe())
    for k in range(4):
        check(library, small, [f"{PROSE} {k} word{k}", PROSE[::-1]])


def test_decoding_of_ids(spark, library):
    """Decoded lists equal the library's text; null lists, null and unknown ids are defined."""
    table = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    rows = odd_rows() + [doc(100 + i, t) for i, t in table] + [doc(99, "a <unk> b")]
    for r in bpe.decode_ids(bpe.encode(frame(spark, rows))).collect():
        assert r["decoded"] == library.decode(r["ids"], skip_special_tokens=False)
    few = library.encode("two words", add_special_tokens=False).ids
    odd = [(1, None), (2, []), (3, [None, *few, None]), (4, [*few, -5, 10 ** 9]), (5, few * 200_000), (6, [None])]
    got = {r["doc_id"]: r["decoded"] for r in
           bpe.decode_ids(spark.createDataFrame(odd, "doc_id long, ids array<int>")).collect()}
    said = library.decode(few, skip_special_tokens=False)
    assert (got[1], got[2], got[3], got[4], got[6]) == (None, "", said, said, "")
    assert got[5] == library.decode(few * 200_000, skip_special_tokens=False)


def test_bpe_queries(spark, library):
    rows = odd_rows()
    got = bpe.digests(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    text = {r[0]: r[1] for r in rows}
    for r in got:
        ids = library.encode(text[r["doc_id"]] or "", add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        decoded = library.decode(ids, skip_special_tokens=False)
        assert r["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()
    ids = {r["doc_id"]: r["ids"] for r in bpe.encode(frame(spark, rows)).collect()}
    assert ids[1] == [] and ids[4] == library.encode("word", add_special_tokens=False).ids
    assert bpe.digests(frame(spark, [])).collect() == []


def test_segment_tree_takes_the_leftmost_lowest_rank():
    model = bpe.Bpe()
    rank = {int(k): (int(r), int(m)) for k, r, m in zip(model.keys, model.ranks, model.merged)}

    def plain(word):
        s = [int(model.inner[b]) for b in word[:-1]] + [int(model.last[word[-1]])]
        while True:
            best = min(((rank[(a << 20) | b][0], i) for i, (a, b) in enumerate(zip(s, s[1:]))
                        if (a << 20) | b in rank), default=None)
            if best is None:
                return s
            i = best[1]
            s[i:i + 2] = [rank[(s[i] << 20) | s[i + 1]][1]]

    rng = np.random.default_rng(3)
    words = [bytes(rng.choice(list(b"abcdeinorst"), rng.integers(1, 90))) for _ in range(300)]
    flat, count = model.merge(words)
    ends = np.cumsum(count)
    assert [flat[e - c:e].tolist() for e, c in zip(ends, count)] == [plain(w) for w in words]
    assert pa.array(words) is not None
