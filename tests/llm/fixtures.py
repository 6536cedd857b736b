"""Small tables with the awkward rows: nulls, empty and long texts, repeats, extra columns with clashing names."""

SCHEMA = "doc_id bigint, text string, lang string, n int, rank string, h bigint, part int"


def docs(spark, texts, first=1):
    rows = [(first + i if not isinstance(t, tuple) else t[0], t if not isinstance(t, tuple) else t[1], "en", 7, "x", 3, 9) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


ODD = [None, "", " ", "a", "the cat sat on the mat", "the cat sat on the mat", "x  y  z w\n\n v", "naïve ﬁ ́x İSTANBUL ςΣ", "it's <|endoftext|> here  <|endoftext|>x", "tab\tand\r\nline\x0bfeed\x0c\x1c\x85end", "long " * 5000, "x" * 9000, "😀 𝔘nicode 漢字"]
