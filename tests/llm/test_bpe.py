import random
from collections import Counter

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from brute import SF

from tradelake.llm import bpe, queries
from tradelake.llm import bytetext as bt

NAMES = ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"]


@pytest.fixture(scope="module", params=NAMES)
def pair(request):
    """Our vocabulary and the library's encoding over the same ranks."""
    own = bpe.Vocabulary(bpe.read_ranks(public_tokenizers.path(request.param)))
    return own, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={})


def texts():
    r = random.Random(3)
    signs = "ab 's're'\n\t  1２!?é日😀  lvmtd"
    out = ["", "a", "it's they're I'll 'sabc ''s '  's", "  a", "   ", "a  ", "\n\n a\n", "x\x00y", "a" * 5000,
           " " * 3000 + "b", "'re've'll'd'm'x", "!'s", "\n's", " 's", "'S", "1's", "é'sé", "don't'll", "<|endoftext|>"]
    out += ["".join(r.choice(signs) for _ in range(r.randrange(1, 60))) for _ in range(1500)]
    out += ["".join(r.choice("etaoinsh") for _ in range(2000)) for _ in range(4)]
    return out + ["".join(map(chr, range(a, a + 512))) for a in range(0, 0xD800, 512)]


def test_equals_the_library_and_round_trips(pair):
    own, library = pair
    tokens, offsets = own.encode_column(pa.array(texts()))
    for i, text in enumerate(texts()):
        assert tokens[offsets[i]:offsets[i + 1]].tolist() == library.encode_ordinary(text), text[:40]
    assert own.decode(tokens).tobytes() == "".join(texts()).encode()


def test_any_cut_joins_to_the_same(pair):
    own, library = pair
    r = random.Random(1)
    for _ in range(300):
        piece = "".join(r.choice("thersaino") for _ in range(r.randrange(2, 40))).encode()
        cut = r.randrange(len(piece) + 1)
        assert own.join(own.tree(piece[:cut]), own.tree(piece[cut:])) == own.merge(piece)


def test_operator_on_odd_rows(odd_docs, odd_rows, pair):
    own, library = pair
    name = next(n for n in NAMES if len(bpe.Vocabulary(bpe.read_ranks(public_tokenizers.path(n))).ranks) and
                bpe.Vocabulary(bpe.read_ranks(public_tokenizers.path(n))).ranks == own.ranks)
    got = Counter((r.doc_id, tuple(r.tokens), r.n_tokens, r.ids_sha256, bytes(r.decoded))
                  for r in bpe.encode_decode(odd_docs, public_tokenizers.path(name)).collect())
    want = Counter()
    for doc_id, text in odd_rows:
        ids = library.encode_ordinary(text or "")
        want[doc_id, tuple(ids), len(ids), brute.sha(np.array(ids, "<u4").tobytes()), (text or "").encode()] += 1
    assert got == want


def test_empty_table(no_docs):
    assert bpe.encode_decode(no_docs, public_tokenizers.path(NAMES[0])).collect() == []


def test_query(spark):
    own = bpe.Vocabulary(bpe.read_ranks(queries.ranks_path()))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={})
    want = set()
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        ids = library.encode_ordinary(r.text or "")
        want.add((r.doc_id, len(ids), brute.sha(np.array(ids, "<u4").tobytes()), brute.sha(r.text or "")))
    assert {tuple(r) for r in queries.op1_byte_bpe(spark, SF).collect()} == want


def test_equal_hashes_are_compared(pair, monkeypatch):
    """Words that a sum modulo a power of two cannot tell apart, and a hash that takes all words of a length for one."""
    own, library = pair
    odd = ["".join("ab"[bin(i).count("1") % 2 ^ turn] for i in range(1024)) for turn in (0, 1)]
    words = [*odd, *odd[::-1], "one two six ten", " ".join(odd)]

    def check():
        tokens, offsets = own.encode_column(pa.array(words))
        assert [tokens[i:j].tolist() for i, j in zip(offsets[:-1], offsets[1:])] == [library.encode_ordinary(w) for w in words]

    check()
    monkeypatch.setattr(bt.Rolling, "of", lambda self, starts, ends: np.zeros(len(starts), np.uint64))
    check()


def test_ranges_that_differ_from_their_representative():
    data = np.frombuffer(b"abcabdabcab" + b"x" * 40 + b"x" * 39 + b"y", np.uint8)
    begin, end = np.array([0, 3, 6, 9, 11, 51]), np.array([3, 6, 9, 11, 51, 91])
    assert bt.unlike(data, begin, end, np.array([0, 0, 0, 0, 4, 4])).tolist() == [1, 3, 5]
