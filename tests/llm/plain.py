"""Small tables, and plain versions of what the operators compute."""

import random
import re

from pyspark.sql import types as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that operators use themselves
        T.StructField("score", T.DoubleType()),
        T.StructField("batch", T.StringType()),
        T.StructField("word", T.StringType()),
        T.StructField("rank", T.IntegerType()),
    ]
)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def sentence(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}{'é' * (rng.random() < 0.1)}" for _ in range(n))


def texts(seed=3):
    """Plain, copied, edited, overlapping, empty, null, short, odd and very long texts."""
    rng = random.Random(seed)
    base = [sentence(rng, rng.randrange(20, 120)) for _ in range(30)]
    out = list(base)
    out += [base[0], base[0], base[1].upper()]
    for i in range(12):  # near copies, some of them near copies of each other only
        words = base[2].split()
        for _ in range(rng.randrange(1, 6)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(9)}"
        out.append(" ".join(words))
    passage = sentence(rng, 30)
    out += [sentence(rng, 40) + "\n" + passage + "\n" + sentence(rng, 25) for _ in range(6)]
    out += [passage + "\n\n" + passage, None, "", "", " \n\t ", "one", "one", "two words", "日本 語 　 x  y", "a\r\nb\n"]
    out.append(" ".join(sentence(rng, 50) for _ in range(400)))
    return out


def documents(spark, rows=None):
    """Texts with ids in an order of their own, one null id, one repeated row."""
    if rows is None:
        all_texts = texts()
        ids = [(7 * i) % len(all_texts) * 3 for i in range(len(all_texts))]
        rows = list(zip(ids, all_texts))
        rows.append((None, all_texts[3]))
        rows.append(rows[5])
    full = [(i, t, "en", "s", len(t or ""), 0.5, "b", "w", 1) for i, t in rows]
    return spark.createDataFrame(full, DOCS).repartition(3), rows


def empty(spark):
    return spark.createDataFrame([], DOCS)


def shingles(text, n=5):
    words = WORD.findall(lower(text or ""))
    if len(words) < n:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(zip(*[words[i:] for i in range(n)]))


def jaccard(a, b):
    return len(a & b) / len(a | b) if a or b else 0.0
