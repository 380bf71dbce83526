import random
import re
import zlib
from collections import Counter

import pytest
from brute import SF

from tradelake.llm import queries, spelling


def words_by_hand(rows, slip=199, length=6, count=5):
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if slip and h % slip == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= length and n >= count}


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def grouped_by_hand(words):
    close = {w: [v for v in words if abs(len(v) - len(w)) < 2 and near(w, v)] for w in words}
    form = {}
    for w, others in close.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        if best is not None and words[best] >= 5 * words[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, form.get(w), root(w), n, len(close[w]), words.get(form.get(w))) for w, n in words.items()}


def got(df):
    out = [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(out) == len(set(out))
    return set(out)


def edited(r, word):
    i, kind = r.randrange(len(word) + 1), r.randrange(3)
    c = r.choice("abcé÷")
    return word[:i] + c + word[i + (kind == 0):] if kind < 2 else word[:i] + word[i + 1:]


def family(seed, size):
    """Words with many near words, of few letters, with chains of forms and equal counts."""
    r = random.Random(seed)
    words = {"".join(r.choice("abé") for _ in range(r.randrange(6, 12))) for _ in range(size)}
    for _ in range(2):
        words |= {edited(r, w) for w in list(words)}
    return {w: 5 ** r.randrange(1, 6) + r.randrange(2) for w in words if len(w) >= 6}


@pytest.mark.parametrize("long_list, entries", [(32, 200_000), (2, 200_000), (10**9, 200_000), (2, 40)])
def test_near_words_against_brute_force(spark, long_list, entries):
    words = family(3, 150)
    words |= {"a" * n: n for n in (6, 7, 8, 30, 31, 32, 2000, 2001)}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    frequent = spelling.dictionary(df, least=min(long_list, 32), entries=entries)
    assert len(frequent) <= entries
    assert got(spelling.grouped(df, spelling.near_pairs(df, frequent, long_list=long_list))) == grouped_by_hand(words)


def test_a_gram_depends_on_its_own_characters_alone():
    """The bound holds for each single edit, and what stays is found at the place it has moved to."""
    r = random.Random(9)
    for _ in range(400):
        word = "".join(r.choice("ab") for _ in range(r.randrange(6, 14)))
        frequent = {"".join(r.choice("ab\x01\x02") for _ in range(r.randrange(2, 6))) for _ in range(30)}
        other = edited(r, word)
        a, bound = spelling.grams_of(word, frequent)
        b, _ = spelling.grams_of(other, frequent)
        left = sum((Counter(a) - Counter(b)).values())
        assert left <= bound < len(a)


def test_grams_grow_while_they_are_frequent():
    assert spelling.grams_of("abc", {"ab", "abc"}) == (["\x01a", "abc\x02", "bc", "c\x02"], 3)


def test_words_that_could_lose_every_gram_are_refused(spark):
    with pytest.raises(ValueError):
        spelling.near_pairs(spark.createDataFrame([("abc", 1)], "word string, n long"), set(), least_length=3)


def test_chain_of_forms(spark):
    chain = {"abcdef": 5, "abcdefg": 25, "abcdefgh": 125, "abcdefghi": 625, "abcdefghij": 3125, "xbcdefghij": 3125}
    df = spark.createDataFrame(list(chain.items()), "word string, n long")
    out = got(spelling.grouped(df, spelling.near_pairs(df, set())))
    assert out == grouped_by_hand(chain)
    assert ("abcdef", "abcdefg", "abcdefghij", 5, 1, 25) in out


def test_odd_rows(spark, odd_docs, odd_rows):
    want = grouped_by_hand(words_by_hand(odd_rows, 5, 6, 2))
    assert got(spelling.variants(odd_docs, 6, 2, slip=5)) == want and want


def test_empty_table_and_texts_without_words(spark, no_docs):
    assert spelling.variants(no_docs).collect() == []
    blank = spark.createDataFrame([(1, None), (2, ""), (None, "12 日本")], "doc_id long, text string")
    assert spelling.variants(blank).collect() == []


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert got(queries.op12_spelling_variants(spark, SF)) == grouped_by_hand(words_by_hand(rows))
