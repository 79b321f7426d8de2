import random
import re
import zlib

import numpy as np
import plain_more as plain
import pytest
from pyspark.sql import functions as F

from titrant.llm import dialogue_repair, exact_dedup, spelling

CONVERSATIONS = "conv_id long, turn long, role string, text string, cost int"


def marked(df, **more):
    got = exact_dedup.mark(df, **more).select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("text_digest")))
    return sorted((tuple(r) for r in got.collect()), key=repr)


def test_copies_of_awkward_texts(spark, awkward, empty):
    got = marked(awkward)
    assert got == plain.exact_copies([(r.doc_id, r.text) for r in awkward.collect()])
    assert sum(r[3] for r in got) == len({r[4] for r in got}), "one row of each group stays, repeated rows included"
    assert marked(empty) == [] and exact_dedup.keep_first(empty).count() == 0


def test_copies_of_a_hot_group_and_weak_digests(spark, monkeypatch):
    """Half of the rows are one text; with a digest of two values, whole texts still tell groups apart; heavy groups or not, the rows are the same."""
    rng = random.Random(5)
    rows = [(i, "the  same\ttext" if i % 2 else f"text {rng.randrange(40)}" + rng.choice(["", " ", "\n"])) for i in range(2000)]
    rows += [(7, "the same text")] * 3 + [(None, "the same\x0btext"), (None, "alone"), (None, "alone")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    want = plain.exact_copies(rows)
    assert marked(df) == want
    weak = lambda t: F.when(F.length(t) > 13, F.lit(b"b")).otherwise(F.lit(b"a"))
    assert sorted((r[:4] for r in marked(df, digest=weak)), key=repr) == sorted((r[:4] for r in want), key=repr)
    monkeypatch.setattr(exact_dedup, "HEAVY", 1)
    assert marked(df) == want
    monkeypatch.setattr(exact_dedup, "UNFOLD", 2)
    assert marked(df) == want


def test_copies_keep_their_columns(spark):
    rows = [(2, "a b", "x"), (1, "a  b", "y"), (1, "a  b", "y"), (3, "c", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, `d` string")
    assert sorted(map(tuple, exact_dedup.keep_first(df).collect())) == [(1, "a  b", "y"), (3, "c", "z")]
    weak = lambda t: F.lit(b"w")
    assert sorted(map(tuple, exact_dedup.keep_first(df, digest=weak).collect())) == [(1, "a  b", "y"), (3, "c", "z")]


def test_copies_stay_in_built_in_functions(tables):
    plan = exact_dedup.query(tables("documents").sparkSession, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def repair(df, damage=True):
    return {r[0]: tuple(r[1:]) for r in dialogue_repair.repair((dialogue_repair.damaged if damage else dialogue_repair.intact)(df)).collect()}


def test_given_conversations_are_repaired_as_by_the_plain_model(spark, tables):
    df = tables("conversations")
    assert repair(df) == plain.repaired([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])


def test_a_conversation_over_many_partitions(spark):
    """Three quarters of the rows are one conversation; null turns, roles, texts and conv_ids, ties and repeated rows."""
    rng = random.Random(3)
    rows = []
    for _ in range(1200):
        conv = rng.choice([1] * 12 + [2, 3, None, 4])
        text = rng.choice(["ok.", "ok", "", " \n", None, "what? yes", "A.B!", f"é{rng.random()}", f"{rng.randrange(30)}."])
        rows.append((conv, rng.choice([None, *range(400)]), rng.choice(["user", "assistant", "system", "tool", "", None, "user"]), text, 1))
    rows += rows[:60]
    df = spark.createDataFrame(rows, CONVERSATIONS).repartition(3)
    assert repair(df) == plain.repaired([r[:4] for r in rows])
    assert repair(df, damage=False) == plain.repaired([r[:4] for r in rows], damage=False)


def test_literal_repairs(spark):
    """Ties go to the least letter: a lone user is deleted (4) rather than answered only where that costs no more."""
    cases = {
        1: [("user", "Hi."), ("assistant", "Yes.")], 2: [("user", "Hi.")], 3: [("assistant", "Yes.")], 4: [("system", "Be.")], 5: [("user", "a."), ("user", "b.")],
        6: [("user", "Hi."), ("assistant", "cut")], 7: [("user", ""), ("user", "Hi."), ("user", "Hi."), ("assistant", "Yes.")], 8: [("tool", "x.")],
    }
    rows = [(c, k, r, t, 0) for c, turns in cases.items() for k, (r, t) in enumerate(turns)]
    got = {c: (x[5], x[6]) for c, x in repair(spark.createDataFrame(rows, CONVERSATIONS), damage=False).items()}
    assert got == {1: (0, "KK"), 2: (3, "KI"), 3: (3, "IK"), 4: (4, "D"), 5: (3, "KR"), 6: (3, "KK"), 7: (8, "DKDK"), 8: (4, "D")}


def test_no_conversations(spark):
    assert repair(spark.createDataFrame([], CONVERSATIONS)) == {}
    dropped = next(t for t in range(1000) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    assert repair(spark.createDataFrame([(5, dropped, "user", "x.", 1)], CONVERSATIONS)) == {5: (0, 0, 0, 0, 0, 0, "", "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855")}


def variants(df):
    return {r[0]: tuple(r[1:]) for r in spelling.variants(df).select("word", "form", "root", "n", "n_near", "form_n").collect()}


def test_spelling_of_given_documents(spark, tables, empty):
    df = tables("documents")
    assert variants(df) == plain.spelling([tuple(r) for r in df.select("doc_id", "text").collect()])
    assert variants(empty) == {}


def test_spelling_of_dense_words_and_long_ones(spark, monkeypatch):
    """Few letters, so that most words are near many; runs of letters, words beyond ASCII, nulls, and tasks that empty their tables early."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abéA×÷ÿß") for _ in range(rng.choice([4, 5, 5, 6])))[: rng.choice([5, 6])]
    pool = [word() for _ in range(400)]
    rows = [(rng.choice([1, 2, None, 3]), None if rng.random() < 0.02 else " ".join(rng.choice(pool) for _ in range(60)), 1) for _ in range(120)]
    long = "x" * 400 + "ab" * 200
    rows += [(i, f"{long} {long}y {'x' * 300} {'x' * 301}", 1) for i in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n int").repartition(3)
    assert variants(df) == plain.spelling([r[:2] for r in rows])


def test_words_of_hundreds_of_thousands_of_letters(spark):
    long = "x" * 200_000 + "abc" * 50_000
    got = variants(spark.createDataFrame([(i, f"{long} {long}", 1) for i in range(4)], "doc_id long, text string, n int"))
    assert got[long][1] == long and got[long][2] >= 3


@pytest.mark.parametrize("length", [1, 5, 9])
def test_deletion_keys_are_those_of_what_is_left(length):
    rng = np.random.default_rng(1)
    bases = (123_456_789, 987_654_321)
    letters = rng.integers(97, 100, (20, length)).astype("<u4")
    keys = spelling.deletion_keys(letters, bases)
    for row, got in zip(letters, keys):
        assert got[0] == (spelling.deletion_keys(row[None], bases)[0, 0])
        for i in range(length):
            if length > 1:
                assert got[1 + i] == spelling.deletion_keys(np.delete(row, i)[None], bases)[0, 0]


@pytest.mark.parametrize("a, b, near", [("abcde", "abcde1", True), ("abcde", "xabcde", True), ("abcde", "abXde", True), ("abcde", "abdce", False), ("abcde", "abcd", True), ("abcde", "abc", False), ("aabbb", "aaabb", True), ("abcde", "bcdea", False)])
def test_one_apart(a, b, near):
    assert spelling.one_apart(a, b) is near and spelling.one_apart(b, a) is near
