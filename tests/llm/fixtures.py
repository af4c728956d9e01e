"""Small tables with what is hard: nulls, empty and long texts, copies, repeated rows, shared passages, more columns."""

import random

VOCABULARY = [f"{a}{b}" for a in "ka to mi re su vo né ßa".split() for b in "lin dor pes tam que".split()]


def words(rng, n):
    return [rng.choice(VOCABULARY) for _ in range(n)]


def texts(seed=1, n=60):
    rng = random.Random(seed)
    passage, line = words(rng, 70), words(rng, 14)
    out = []
    for i in range(n):
        w = words(rng, rng.choice([3, 20, 80, 200]))
        if i % 5 == 0:
            at = rng.randrange(len(w) + 1)
            w[at:at] = passage
        if i % 3 == 0:
            w += line
        if i % 7 == 1 and out:
            w = out[rng.randrange(len(out))].split()
            for _ in range(len(w) // 60):
                w[rng.randrange(len(w))] = "changed"
        text = ""
        for j, x in enumerate(w):
            text += x.capitalize() if j % 9 == 0 else x
            text += ".\n" if j % 27 == 26 else ". " if j % 9 == 8 else "  " if j % 31 == 5 else "\t" if j % 37 == 3 else " "
        out.append(text)
    out += [out[4], out[4], "", " \n\t ", "one", "one two", "a a a a a a a a a a a a a a a a a a a a a", "x" * 500, "ab" * 400, ("lorem ipsum " * 3000), "\x00\x1f nul", "é" * 120]
    return out


def rows(seed=1, n=60):
    """(doc_id, text, lang, source, n_chars), with null texts and a repeated row."""
    found = [(3 * i + 7, t, "en", None if i % 11 == 0 else f"src{i % 3}", len(t)) for i, t in enumerate(texts(seed, n))]
    found.append((1000, None, None, "src1", None))
    found.append((1001, None, "en", None, 0))
    found.append(found[5])
    random.Random(seed).shuffle(found)
    return found


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, seed=1, n=60, extra=True):
    df = spark.createDataFrame(rows(seed, n), SCHEMA).repartition(3)
    if extra:  # names that operators use themselves
        from pyspark.sql import functions as F

        df = df.withColumns({"bucket": F.lit(1), "keep": F.lit("k"), "slot": F.lit(2.5), "chunk": F.lit("c"), "group": F.lit(3), "rest": F.lit(b"r"), "cluster": F.lit(1), "quality": F.lit("q")})
    return df


def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
