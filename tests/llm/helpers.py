"""Small documents with every awkward case: nulls, empty, long, ties, repeats, clashing names."""

LONG = " ".join(f"word{i % 977}" for i in range(30_000))
PASSAGE = "".join(f"shared passage number {i} of many; " for i in range(20))

TEXTS = [
    "The quick brown fox jumps over the lazy dog again and again", None, "", "   \n\t", "the quick brown fox jumps over the lazy dog AGAIN and again",
    "É ü straße 日本語 😀", "É ü straße 日本語 😀", LONG, LONG + " tail", "one", "two words", "A" * 3000, "a" * 3000,
    "before " + PASSAGE + " after", "other start, " + PASSAGE, "<|endoftext|> x<|endoftext|>", "x\x00y z\x0bw\x1c v", PASSAGE,
]


def documents(spark, texts=None, ids=None):
    """documents with extra columns whose names the operators use themselves."""
    texts = TEXTS if texts is None else texts
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, "en", None if k % 5 == 0 else f"src{k % 3}", None if t is None else len(t), k, b"k", 1.5, "z")
            for k, (i, t) in enumerate(zip(ids, texts, strict=True))]
    return spark.createDataFrame(rows, (
        "doc_id long, text string, lang string, source string, n_chars long, row long, key binary, score double, raw string"))


def odd(spark):
    """The texts, one row repeated, one with a null id."""
    df = documents(spark, [*TEXTS, "null id text here " + PASSAGE], [*range(len(TEXTS)), None])
    return df.union(df.filter("doc_id = 0"))
