import itertools
import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from weftline.llm.packing import Line, encoder, hilbert_keys, pack

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_hilbert_is_a_curve():
    for bits, d in ((1, 2), (3, 2), (2, 4), (3, 3)):
        grid = np.array(list(itertools.product(range(1 << bits), repeat=d)))
        keys = hilbert_keys(grid, bits)
        assert sorted(keys.tolist()) == list(range(len(grid)))
        assert (np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(1) == 1).all()


TOKENIZER = Tokenizer.from_file(PATH)


@settings(max_examples=150, deadline=None)
@given(st.one_of(st.text(max_size=80), st.text(alphabet="a 'sté\n\t1<|endoftext>½", max_size=60), st.lists(st.sampled_from(["<|endoftext|>", "abc", " ", "\n ", "<|endof", "text|>"]), max_size=8).map("".join)))
def test_ids_equal_the_tokenizer(text):
    assert encoder(PATH)(text) == TOKENIZER.encode(text, add_special_tokens=False).ids


def check(rows, docs):
    left = {}
    for key, text in docs:
        ids = tuple([*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 0])
        left.setdefault(key, []).append(ids)
    for key, group in itertools.groupby(sorted(rows, key=lambda r: (r.doc_id is None, r.doc_id, r.start)), key=lambda r: r.doc_id):
        pieces = list(group)
        for ids in left[key][:1]:
            starts = sorted({r.start for r in pieces})
            assert starts[0] == 0 and sum(r.length for r in pieces) == sum(len(x) for x in left[key])
            for r in pieces:
                if len(set(left[key])) == 1:
                    assert r.doc_tokens == len(ids)
                    assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append(r)
    for own in by.values():
        own.sort(key=lambda r: r.offset)
        n = 0
        for r in own:
            assert r.offset == n
            n += r.length
        assert n <= 1024 and n & (n - 1) == 0


def test_round_trip(spark, odd, empty):
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    rows = pack(odd).collect()
    check(rows, docs)
    assert pack(empty).count() == 0
    assert sorted(map(tuple, pack(odd).collect()), key=str) == sorted(map(tuple, rows), key=str)


def test_remainder_is_cut_into_powers_of_two():
    line = Line(16, 0)
    for i, n in enumerate([5, 30, 1, 7]):
        line.add(i, np.arange(n, dtype="<u4"))
    line.finish()
    sizes = {}
    for r in line.done:
        sizes[r[5]] = sizes.get(r[5], 0) + r[2]
    assert list(sizes.values()) == [16, 16, 8, 2, 1]


def test_long_runs_of_white_space():
    own = encoder(PATH)
    for text in (" " * 1_000_000, "a" + "\n" * 1_200_000 + "b", "x\t \u3000" * 3 + "\t" * 1500 + "<|endoftext|>" + " " * 2000 + "<|endoftext|>" + "\n" * 1000, " " * 1500 + "'s" + " \n" * 800 + "1", "\u2003" * 1100 + " é" + " " * 999 + "!"):
        assert own(text) == TOKENIZER.encode(text, add_special_tokens=False).ids


def test_texts_of_one_letter_or_of_spaces(spark):
    rows = [(1, " " * 1_000_000), (2, "a" * 5_000_000), (3, "\n" * 600_000 + "end")]
    out = pack(spark.createDataFrame(rows, "doc_id long, text string")).groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("of")).collect()
    for r in out:
        n = len(TOKENIZER.encode(dict(rows)[r.doc_id], add_special_tokens=False).ids) + 1
        assert r.n == n and r.of == n
