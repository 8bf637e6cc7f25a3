"""Inputs shared by the tests of the training-data operators."""

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          # clashing names: columns that operators use inside or return
          "score double, component_id long, rep long, key string, features string, kept boolean")

PROSE = ("the quick brown fox jumps over the lazy dog while seven wizards mix potions near an old "
         "stone bridge under pale moonlight and nobody hears the quiet river moving south tonight")


def doc(doc_id, text, lang="en", source="s"):
    return (doc_id, text, lang, source, None if text is None else len(text),
            0.5, -7, -8, "k", "f", False)


def odd_rows():
    """Null and empty texts, no words, one word, ties, repeated rows, null ids, a long text."""
    long_text = " ".join(f"w{i % 977}x{i // 977}" for i in range(60_000))
    return [
        doc(1, None), doc(2, ""), doc(3, " \t\n "), doc(4, "word"), doc(5, "word"), doc(6, "1234 !!"),
        doc(7, PROSE), doc(8, PROSE.upper()), doc(9, PROSE + " indeed"), doc(9, PROSE + " indeed"),
        doc(None, PROSE), doc(11, "x" * 20_000), doc(12, long_text), doc(13, long_text + " end"),
        doc(14, "Ünïcode ß ñandú 漢字 \U0001f600", None),
    ]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)
