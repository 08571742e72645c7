"""A small corpus with what the operators must bear: nulls, empty and long texts, repeated rows, ties, clashing columns."""

import random

WORDS = "the of and river stone light under walking nobody seven harbour quiet market thunder paper window copper garden".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, tk int, pos string, n long, line string, j int"


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "ing", "s", "é"]) for _ in range(n))


def texts(seed=1):
    rng = random.Random(seed)
    passage, line = sentence(rng, 90), sentence(rng, 12)
    out = [sentence(rng, rng.randint(1, 120)) + "\n" + sentence(rng, 30) for _ in range(25)]
    out += [out[3], out[3], out[4] + "\n" + line, line + "\n" + out[5], out[6].replace("the", "tha", 1), line[:-1] + "x\n" + sentence(rng, 20)]
    out += [sentence(rng, 70) + " " + passage + " " + sentence(rng, 40), passage + "\n" + sentence(rng, 60), sentence(rng, 200) + " " + passage]
    out += ["", "   \n\t ", "one", "a b c", "!!! ??? ...", "ab" * 700, "na " * 700, "<|endoftext|> x <|endoftext|>", "漢字かな交じり文" * 90, "x\u00a0y\u3000z   \r\n w\x1cq"]
    out += [sentence(rng, 4000), sentence(rng, 300) + passage]
    return out


def rows(seed=1):
    found = [(i * 3, t, "en", "s", len(t)) for i, t in enumerate(texts(seed))]
    found += [found[7], found[31], (None, found[8][1], None, None, None), (None, None, None, None, None), (1000, None, "fr", "s", None), (1001, None, None, None, 5)]
    return [(*r, "k", 1, "p", 2, "l", 3) for r in found]


def frame(spark, seed=1):
    return spark.createDataFrame(rows(seed), SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
