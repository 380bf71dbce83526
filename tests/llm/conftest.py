import random

import pytest
from pyspark.sql import functions as F

def thue_morse(n):
    """A word that sums modulo a power of two cannot tell from the one with its letters exchanged."""
    return "".join("ab"[bin(i).count("1") % 2] for i in range(n))

@pytest.fixture(scope="session")
def odd_rows():
    """(doc_id, text): copies, near copies, shared passages, nulls, empty, blank, long and repeated rows."""
    r = random.Random(7)
    vocabulary = ["ab", "c", "dé", "ef,", "Gh", "ijk", "l0", "m", "no!", "ñ", "日本", "x" * 30]
    text = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    base = [text(r.randrange(1, 160)) for _ in range(12)]
    passage, rows = text(60), [(i * 37 + 3, t) for i, t in enumerate(base)]
    rows += [(1000 + i, t) for i, t in enumerate(base[:5])]
    rows += [(2000 + i, t[:len(t) // 2] + " edit " + t[len(t) // 2:]) for i, t in enumerate(base)]
    rows += [(300 + i, f"{text(20)} {passage}\n\n{text(9)}") for i in range(6)]
    rows += [(7, None), (8, ""), (9, " \n\t"), (None, base[0]), (None, None), (None, text(40)),
             (50, "a" * 1500), (51, "ab " * 400), (52, "a" * 700), (53, (passage + "\n") * 20),
             (54, "x\x00y\x00" * 80), (-4, text(50) + " " + passage), (-4, text(30) + " " + passage),
             (60, thue_morse(1024)), (61, thue_morse(1024)[::-1].translate({97: 98, 98: 97})), (62, thue_morse(1024).translate({97: 98, 98: 97})),
             (63, " ".join([thue_morse(1024)] * 14)), (64, " ".join([thue_morse(1024).translate({97: 98, 98: 97})] * 14)),
             (300, base[2]), (300, base[2]), (55, text(4000)), (56, "\x85   " + passage), (10**12, base[3])]
    return rows

@pytest.fixture
def odd_docs(spark, odd_rows):
    """The rows as documents with columns whose names clash with the operators' own."""
    df = spark.createDataFrame([(i, t, "en", "s", n) for n, (i, t) in enumerate(odd_rows)],
                               "doc_id long, text string, lang string, source string, n_chars long")
    return df.select("*", *(F.lit("clash").alias(c) for c in
                            ("chunk", "bucket", "words", "n_words", "kept", "score", "shard", "h", "kind", "path", "_key", "_class", "_digest", "_KEY_", "row")))

@pytest.fixture
def no_docs(odd_docs):
    return odd_docs.limit(0)
