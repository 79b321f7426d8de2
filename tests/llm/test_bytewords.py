import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from public_tokenizers import path
from tokenizers import Tokenizer

from titrant.llm import bpe_automaton, minhash, quality, token_shards
from titrant.llm import bytewords as bw

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab Z9\n\té日-.", max_size=30)), max_size=8)


@settings(max_examples=80, deadline=None)
@given(TEXTS, st.integers(1, 40))
def test_words(texts, limit):
    for table, pattern in ((bw.PLAIN, r"[^\x20\x09-\x0D]+"), (bw.NORMAL, r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")):
        got = []
        for part in bw.slices(pa.array(texts, pa.string()), limit):
            starts, ends, places = part.words(table)
            words = [part.buf[a:b].tobytes().decode() for a, b in zip(starts, ends)]
            got += [words[places[i] : places[i + 1]] for i in range(part.n)]
        assert got == [re.findall(pattern, t or "") for t in texts]


@settings(max_examples=50, deadline=None)
@given(st.lists(st.text(alphabet="abC", max_size=12), min_size=1, max_size=6))
def test_hashes_follow_content(texts):
    (part,) = bw.slices(pa.array(["-".join(texts)]))
    starts, ends, _ = part.words(bw.NORMAL)
    hashes = part.span_hash(part.prefix_hash(), starts, ends)
    words = [part.buf[a:b].tobytes() for a, b in zip(starts, ends)]
    assert len(set(words)) == len(set(hashes.tolist())) == len(set(zip(words, hashes.tolist())))


def test_windows():
    first, rows = bw.windows(np.array([0, 2, 2, 5]), 2)
    assert first.tolist() == [0, 2, 3] and rows.tolist() == [0, 2, 2]


def test_slices_of_slices():
    column = pa.array(["a", None, "bcd", ""]).slice(1)
    parts = list(bw.slices(column, 2))
    assert [p.text(i) for p in parts for i in range(p.n)] == [b"", b"bcd", b""] and [bool(x) for p in parts for x in p.null] == [True, False, False]


def twins(length, a="a", b="b"):
    """A Thue-Morse string and its complement: equal under any polynomial hash modulo a power of two, from 1,024 letters on."""
    bits = [bin(i).count("1") & 1 for i in range(length)]
    return "".join((a, b)[x] for x in bits), "".join((b, a)[x] for x in bits)


def test_twins_are_told_apart(spark, tmp_path):
    """As spans, as words whose repeats are counted, as pieces of both tokenizers, and as texts of words."""
    for length in (1024, 2048, 8192):
        one, two = twins(length)
        for bases in (bw.SHARED, bw.OWN):
            (part,) = bw.slices(pa.array([f"{one} {two}"]))
            starts, ends, _ = part.words(bw.PLAIN)
            hashes = part.span_hash(part.prefix_hash(bases=bases), starts, ends)
            assert hashes[0] != hashes[1]
    rows = [(i, f"{x} {y} {x}\n{y} {y}") for i, length in enumerate((1024, 2048, 4096, 8192)) for x, y in [twins(length)]]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert [r.n_repeat_words for r in quality.judge(docs).collect()] == [0] * 4
    words, stops = zip(*[twins(4096, "lorem ", "ipsum ")])
    two_texts = spark.createDataFrame([(0, words[0]), (1, stops[0])], "doc_id long, text string")
    part = next(iter(bw.slices(pa.array([r.text for r in two_texts.collect()]))))
    *_, k1, k2 = minhash.vectors(part, np.ones((2, minhash.BUCKETS)))
    assert k1[0] != k1[1] and k2[0] != k2[1]
    library = Tokenizer.from_file(path("word_bpe_49k.json"))
    got = {r.doc_id: r.ids_sha256 for r in bpe_automaton.digests(docs).collect()}
    assert got == {d: hashlib.sha256(" ".join(map(str, library.encode(t, add_special_tokens=False).ids)).encode()).hexdigest() for d, t in rows}
    library = Tokenizer.from_file(path("byte_bpe_50k.json"))
    token_shards.write_shards(docs, f"file://{tmp_path}/shards")
    want = {d: zlib.crc32(np.array([*library.encode(t, add_special_tokens=False).ids, 2], "<u4").tobytes()) for d, t in rows}
    assert {r.doc_id: r.ids_crc32 for r in token_shards.read_documents(spark, f"file://{tmp_path}/shards").collect()} == want
