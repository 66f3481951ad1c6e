"""Small documents with every awkward case, and columns whose names clash with inner ones."""

import random

SCHEMA = ("doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, id STRING, `row` STRING, "
          "hash STRING, h1 STRING, o STRING, key STRING")


def prose(rng, n):
    return " ".join("".join(rng.choice("aeioulrnst") for _ in range(rng.randint(1, 6))) for _ in range(n))


def texts():
    rng = random.Random(5)
    passage, line = prose(rng, 60), "Licensed under the Same License."
    out = [None, "", " ", "\n", "one", "two words", "Ünïcödé ßtraße 日本語 😀 x\x1cy", "a\n\n b\r\n", "x" * 5000,
           "it's we'll 'tis  \t 12345 !!! ", "<|endoftext|> and <|startoftext|>mid", "the the the the the the the the the"]
    out += [f"{prose(rng, 40)} {passage} {prose(rng, 20)}" for _ in range(4)]
    base = prose(rng, 120)
    out += [base, base, base + " tail", base.replace("a", "e", 2), base]
    out += [f"{prose(rng, 12)}\n  {line.upper() if i % 2 else line} \n{prose(rng, 9)}" for i in range(12)]
    out += [prose(rng, 9000)]
    return out


def rows():
    out = [(i, t) for i, t in enumerate(texts())]
    out += [out[7], out[15], (3, "another text with id three"), (None, "no id"), (None, "no id"), (None, out[12][1])]
    return out


def frame(spark, pairs=None):
    pairs = rows() if pairs is None else pairs
    data = [(i, t, "en", "s", None if t is None else len(t), *["clash"] * 6) for i, t in pairs]
    return spark.createDataFrame(data, SCHEMA)
