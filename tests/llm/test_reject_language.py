"""The language stage of the pipeline rejects what no learned language looks like."""

import random
import zlib

from strata.llm import langid

from .helpers import MEDIUM

UNLEARNED = {
    "fi": "kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan heille on annettu järki "
          "ja omatunto ja heidän on toimittava toisiaan kohtaan veljeyden hengessä",
    "pl": "wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw są oni obdarzeni "
          "rozumem i sumieniem i powinni postępować wobec innych w duchu braterstwa",
    "ru": "все люди рождаются свободными и равными в своем достоинстве и правах они наделены разумом и совестью",
}


def test_unlearned_languages_and_junk_are_rejected(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "text", "lang")
    rng = random.Random(3)
    junk = [" ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(60))
            for _ in range(30)]
    texts = list(UNLEARNED.values()) + junk
    # ids of held-out rows, so that nothing is learned from them
    ids = [i for i in range(10_000_000, 10_001_000) if zlib.crc32(str(i).encode()) % 3 == 1]
    odd = spark.createDataFrame([(i, t, "en") for i, t in zip(ids, texts)], docs.schema)
    kept = {r["doc_id"] for r in langid.keep_identified(docs.unionByName(odd)).select("doc_id").collect()}
    assert not kept & set(ids)
    assert len(kept) == docs.count()  # every learned-language document stays, held out or not


def test_every_language_is_learned(spark):
    """Seventy languages of made-up words: each is told from the others."""
    import numpy as np

    from strata.llm import langid

    rng = np.random.default_rng(70)
    letters = list("abcdefghijklmnopqrstuvwxyz")
    rows = []
    for k in range(70):
        syllables = ["".join(rng.choice(letters, 3)) for _ in range(12)]
        rows += [(len(rows) + i, " ".join("".join(rng.choice(syllables, 2)) for _ in range(60)), f"q{k:02d}", "s", 1)
                 for i in range(24)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = langid.identify(df).where("held_out").join(df.select("doc_id", "lang"), "doc_id").collect()
    assert len({r.lang_pred for r in got}) == 70
    assert sum(r.lang_pred == r.lang for r in got) / len(got) > 0.95
