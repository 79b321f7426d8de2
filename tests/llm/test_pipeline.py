import re
import shutil

import corpus_pipeline
import plain
import pytest
from pyspark.sql import functions as F

from titrant.llm import pii, quality

WINDOW = 10
BASE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), "phone": re.compile(r"\+[0-9][\x20().0-9-]{8,}[0-9]"),
}


def stages(spark, docs, sf_dir, folder):
    """The output of each stage, written and read again."""
    out = []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        out.append(docs)
    return out


def leaks(text, items):
    """Whether a window of an item stands in the text, word by word."""
    words = " " + " ".join(plain.words_of(text)) + " "
    for item in items:
        w = plain.words_of(item)
        if w and any(" " + " ".join(w[i : i + WINDOW]) + " " in words for i in range(max(1, len(w) - WINDOW + 1))):
            return True
    return False


def test_stages_against_a_plain_model(spark, tmp_path):
    """Quality by words and zstandard, near copies by all pairs, leaks by windows, each on what the model of the stage before keeps."""
    sf_dir = "/root/testdata/sf0.001"
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    out = stages(spark, documents, sf_dir, tmp_path)
    assert all(o.columns == documents.columns for o in out[:-1])
    kept = [{r.doc_id for r in o.collect()} for o in out]
    texts = dict(rows)
    good = [(d, t) for d, t in rows if plain.quality(t, quality.BANDS, quality.CHUNK_BAND, quality.CHUNK_SHARE)[0] is None]
    assert kept[0] == {d for d, _ in good}
    # words are counted in hash tables, which may move a similarity by a thousandth
    fewest, most = ({c for _, c in plain.near_classes(good, threshold)[0]} for threshold in (0.799, 0.801))
    assert fewest <= kept[1] <= most and len(most) < len(good)
    assert kept[2] == {d for d in kept[1] if not leaks(texts[d], items)} and kept[2] == kept[3] == kept[4]
    for r in out[3].collect():
        assert not any(p.search(r.text) for p in BASE.values()) and r.n_chars == len(r.text)
        assert r.text == texts[r.doc_id] or pii.base_spans(texts[r.doc_id]) or "[" in r.text
    assert {tuple(r) for r in corpus_pipeline.run(spark, sf_dir).collect()} == {tuple(r) for r in out[4].collect()}


@pytest.fixture
def awkward_tables(spark, tmp_path):
    """A folder with documents of every awkward kind, and the benchmark."""
    base = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("n_chars > 1200").orderBy("doc_id").limit(6).collect()]
    long = " ".join(r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").orderBy("doc_id").collect())
    rows = [(1, None), (2, ""), (3, " \n "), (4, base[0]), (4, base[0]), (5, base[0] + " more"), (None, base[1]), (None, base[1]), (6, long), (7, base[2] + " token=" + "aB3" * 3000 + "Z"), (8, base[3].upper())]
    names = ["__kept", "__CLEAN", "__count", "__rid", "class_id", "Kept", "n_words", "spans", "__hits", "ids"]
    frame = spark.createDataFrame([(d, t, "en", "s", len(t) if t else None) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    frame = frame.select("*", *[F.lit(i).alias(n) for i, n in enumerate(names)])
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    shutil.copy("/root/testdata/sf0.001/benchmark.parquet", tmp_path / "benchmark.parquet")
    return tmp_path, rows


def test_awkward_documents(spark, awkward_tables, tmp_path):
    """Nulls, blanks, repeated rows, a very long text, and columns that clash: no stage fails, and none loses a column."""
    sf_dir, rows = awkward_tables
    docs = spark.read.parquet(str(sf_dir / "documents.parquet"))
    out = stages(spark, docs, str(sf_dir), tmp_path / "out")
    assert all(o.columns == docs.columns for o in out[:-1])
    reasons = [(d, plain.quality(t, quality.BANDS, quality.CHUNK_BAND, quality.CHUNK_SHARE)[0]) for d, t in rows]
    good = sorted(str(d) for d, why in reasons if why is None)
    assert sorted(str(r.doc_id) for r in out[0].collect()) == good
    assert {str(r.doc_id) for r in out[1].collect()} <= set(good) and out[1].count() == len({str(r.doc_id) for r in out[1].collect()})
    for r in out[3].collect():
        assert "aB3aB3" not in r.text and r.n_chars == len(r.text)
        assert [r[c] for c in docs.columns[5:]] == list(range(10))
    assert out[4].count() == out[3].count()


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
