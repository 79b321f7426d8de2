"""Spelling variants: words one edit apart, found by a symmetric-delete join, and the commoner form that each belongs to.

Every word emits itself and its distinct single deletions; words that share one of these keys meet in an equi-join, and
pairs with an edit distance of exactly one are near. A word's form is its near word with the most occurrences (ties: the
least in order of code points) if it has at least ``FACTOR`` times the word's own. Forms are strictly commoner, so chains
of forms end; their last members are joined by doubling.

Keys travel as 62-bit hashes of what is left after a deletion, computed for all places of a word from the sums of its
letters, and words as numbers of the written vocabulary: a word of a million letters emits a million small rows, not a
million copies of itself. A hash only makes candidates; each pair is verified on the words themselves. Its bases are drawn
anew for each job and sent to the tasks, so no text can be made to collide. Words that share a key are that key or have one
letter more, so a key joins at most one word for each of its places and letters of the alphabet.

Runs are counted per task in a table of bounded size that is emptied into the shuffle when it is full; Spark sums the rest.

Edge cases: a null text has no runs, a null doc_id is empty in the key of the changed letter. Runs of any length are
words, equal texts and repeated rows count each time. An empty table gives no rows. Further columns don't matter,
whatever they are called.
"""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import released, settled

RUN = re.compile(r"[A-Za-zÀ-ÿ]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
CYCLE = 97
LEAST_LETTERS, LEAST_COUNT, FACTOR = 5, 3, 2
#: So many distinct words a task holds before it sends their counts, and so many characters of them.
HELD, HELD_CHARS = 200_000, 8 << 20
PRIMES = (2_147_483_647, 2_147_483_629)
#: So many letters of words are hashed at a time.
CELLS = 1 << 20


def changed(word: str, mark: int) -> str:
    """``word``, or one letter less where 97 divides the mark."""
    if mark % CYCLE:
        return word
    at = mark % len(word)
    return word[:at] + word[at + 1 :]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter[str] = Counter()
    size = 0

    def flush() -> pa.RecordBatch:
        nonlocal held, size
        out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
        held, size = Counter(), 0
        return out

    for batch in batches:
        for ident, text in zip(batch.column(0), batch.column(1), strict=True):
            if not text.is_valid:
                continue
            begin = zlib.crc32(f"{'' if (i := ident.as_py()) is None else i}:".encode())
            for run, n in Counter(RUN.findall(text.as_py().translate(LOWER))).items():
                word = changed(run, zlib.crc32(run.encode(), begin))
                if len(word) >= LEAST_LETTERS:
                    if word not in held:
                        size += len(word)
                    held[word] += n
            if len(held) >= HELD or size >= HELD_CHARS:
                yield flush()
    if held:
        yield flush()


def vocabulary(docs: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """``word, n``: the words of all documents with at least ``LEAST_COUNT`` occurrences."""
    counts = docs.select(F.col(f"`{ident}`"), F.col(f"`{text}`")).mapInArrow(_count, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def _powers(base: int, prime: int, n: int) -> np.ndarray:
    out = np.ones(1, np.int64)
    while len(out) < n:
        out = np.concatenate([out, out * pow(base, len(out), prime) % prime])
    return out[:n]


def deletion_keys(letters: np.ndarray, bases: tuple[int, int]) -> np.ndarray:
    """For words of one length (rows of code points): hashes of each word and of its deletions at every place, in columns."""
    m, length = letters.shape
    out = np.zeros((m, length + 1), np.int64)
    for prime, base in zip(PRIMES, bases, strict=True):
        ahead = np.zeros((m, length + 1), np.int64)  # the sum of the letters before each place, times powers of the base
        np.cumsum((letters + np.int64(1)) * _powers(base, prime, length) % prime, axis=1, out=ahead[:, 1:])
        # what stands behind a deleted letter moves ahead by one place
        moved = (ahead[:, length:] - ahead[:, 1:]) % prime * pow(base, -1, prime)
        out = out << 31 | np.concatenate([ahead[:, length:], ahead[:, :length] % prime + moved], 1) % prime
    return out


def _emit(bases: tuple[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            words = batch.column(1).to_pylist()
            lengths = np.array([len(w) for w in words], np.int64)
            for length in np.unique(lengths).tolist():
                of = np.flatnonzero(lengths == length)
                step = max(1, CELLS // length)
                for lo in range(0, len(of), step):
                    part = of[lo : lo + step]
                    letters = np.frombuffer("".join([words[i] for i in part]).encode("utf-32-le"), "<u4").reshape(len(part), length)
                    keys = deletion_keys(letters, bases)
                    # deleting any letter of a row of equal ones gives the same: only the first counts
                    new = np.ones(keys.shape, bool)
                    new[:, 2:] = letters[:, 1:] != letters[:, :-1]
                    rows, _ = np.nonzero(new)
                    yield pa.RecordBatch.from_arrays([pa.array(keys[new]), pa.array(ids[part][rows])], names=["key", "id"])

    return run


def one_apart(a: str, b: str) -> bool:
    """Whether two different words differ by one letter inserted, deleted or replaced: what follows their first difference must be equal."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > 1:
        return False
    i = 0
    for x, y in zip(a, b):  # noqa: B905  the longer one may have a letter more
        if x != y:
            break
        i += 1
    return a[i + 1 :] == b[i + (len(a) == len(b)) :]


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("a_word", "b_word")]
        yield batch.filter(pa.array([one_apart(a, b) for a, b in zip(*words, strict=True)], pa.bool_()))


def near_pairs(words: DataFrame) -> DataFrame:
    """``a, b, a_n, b_n, a_word, b_word`` of all near words of ``id, word, n``, both ways."""
    draw = random.SystemRandom()
    bases = tuple(draw.randrange(1 << 24, p) for p in PRIMES)
    keys = words.select("id", "word").mapInArrow(_emit(bases), "key long, id long")
    keys = settled(keys, "keys")
    meet = keys.select("key", F.col("id").alias("a")).join(keys.select("key", F.col("id").alias("b")), "key").filter("a < b").select("a", "b").distinct()
    left, right = (words.select(F.col("id").alias(x), F.col("word").alias(f"{x}_word"), F.col("n").alias(f"{x}_n")) for x in "ab")
    met = meet.join(left, "a").join(right, "b").select("a", "b", "a_n", "b_n", "a_word", "b_word")
    near = settled(met.mapInArrow(_verified, met.schema), "near")
    released(keys)
    return near


def roots(forms: DataFrame) -> DataFrame:
    """``id, root``: the last member of each chain of ``id, form_id``."""
    now = settled(forms.select("id", F.col("form_id").alias("root")), "roots")
    while True:
        further = now.select(F.col("id").alias("root"), F.col("root").alias("further"))
        step = settled(now.join(further, "root", "left").select("id", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        released(now)
        if step.filter("moved").isEmpty():
            return step.select("id", "root")
        now = step.select("id", "root")
        now.settled_at = step.settled_at


def variants(docs: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of every word of the vocabulary."""
    words = settled(vocabulary(docs, ident, text).withColumn("id", F.monotonically_increasing_id()), "words")
    near = near_pairs(words)
    both = near.select(F.col("a").alias("id"), F.col("a_n").alias("n"), F.col("b").alias("other"), F.col("b_n").alias("other_n"), F.col("b_word").alias("other_word"))
    both = both.unionByName(near.select(F.col("b").alias("id"), F.col("b_n").alias("n"), F.col("a").alias("other"), F.col("a_n").alias("other_n"), F.col("a_word").alias("other_word")))
    best = both.groupBy("id").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("minus"), F.col("other_word").alias("form"), F.col("other").alias("form_id"))).alias("best"))
    found = settled(words.join(best, "id", "left").select("id", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), *[F.when(-F.col("best.minus") >= FACTOR * F.col("n"), c).alias(name) for name, c in (("form", F.col("best.form")), ("form_n", -F.col("best.minus")), ("form_id", F.col("best.form_id")))]), "found")
    released(near)
    ends = roots(found.filter("form_id IS NOT NULL"))
    last = ends.join(words.select(F.col("id").alias("root"), F.col("word").alias("root_word")), "root").select("id", "root_word")
    return found.join(last, "id", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root_word", "word").alias("root"))


def query(spark, sf_dir: str) -> DataFrame:
    return variants(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("word", "form", "root", "n", "n_near", "form_n")
