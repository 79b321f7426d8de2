"""Near-duplicates: improved consistent weighted sampling over TF-IDF shingles, banded, verified by weighted Jaccard similarity.

A shingle is ``SHINGLE`` consecutive words (A-Z lower-cased; a text with fewer words is one shingle). Its weight is its
count in the text times the mean inverse document frequency of its words. The frequency is that of words, not of whole
shingles: the shingles of a text with n copies all stand in n documents, so their own frequency would weigh down just
what near copies share. Words are counted over all documents in two hash tables of ``BUCKETS`` buckets, which bounds what
is broadcast; the lesser of a word's two counts holds, so only words that meet others in both tables seem more frequent.

Each of ``RUNS`` runs deals the shingles to ``BINS`` bins by hash and takes an improved consistent weighted sample in
each bin; an empty bin borrows from others by hash. Equal samples are as likely as the weighted Jaccard similarity.
``BANDS`` bands of ``ROWS`` samples give the candidates: a pair at 0.8 is missed with probability below 1e-4.

Texts with equal words are one node from the start. Most links are found cheaply: in a bucket, each member is held
against the hub, the member that shares most buckets, then against the ``NEAR`` before it in sketch order, another order
in each band, unless the sketch makes the similarity unlikely or both are similar to the same hub. The last round is
exact: in buckets whose members lie in several components of the links so far, every pair of members of different
components is verified, without regard to sketches, in the first band that the two share. It works in blocks of
a bucket: each pair of blocks meets in one task, with texts, and only links leave it. So no row stands for a pair, but
rows of a bucket with m members grow as m * m / ``BLOCK``, and the time to verify with the pairs that no link spares.
Verified links give components; a class is a component.

Edge cases: a null or wordless text is a class of its own (so is each of several such rows). Repeated rows are copies.
The class id is the least doc_id of the class; ``kept`` marks one row of each class (the first with that id). An empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytewords import NORMAL, ODD, Prefix, Slice, besides, halves, map_text, mix64, row_of, slices, window_hash, windows
from .components import components
from .storage import partitions_for, released, settled

SHINGLE, THRESHOLD = 5, 0.8
BUCKET_BITS = 17
BUCKETS = 1 << BUCKET_BITS
#: Both tables' counts travel in so many arrays.
PIECES = 64
RUNS, BINS = 4, 32
BANDS, ROWS = 25, 5
SKETCH_LONGS = RUNS * BINS * 4 // 64
#: The least similarity that a sketch may suggest for neighbours to be verified: over three deviations below the threshold.
SKETCH_LEAST = 0.67
NEAR = 2
#: For the exact round: about so many members, and bytes of text, of a bucket make a block.
BLOCK, BLOCK_BYTES = 256, 8 << 20
SIGNATURE = "__n long, __k1 long, __k2 long, __bands array<long>, __sketch array<long>"


def _buckets(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of each word in either table, from other bits of its hash."""
    first, second = hashes >> np.uint64(64 - BUCKET_BITS), hashes >> np.uint64(64 - 2 * BUCKET_BITS) & np.uint64(BUCKETS - 1)
    return first.astype(np.int64), second.astype(np.int64)


def word_weights(docs: DataFrame, text: str = "text") -> np.ndarray:
    """The inverse document frequency of each bucket of both tables, over all documents.

    A task sends its counts as ``PIECES`` arrays (and the number of its rows as one more); those of one place are summed
    as they arrive, so nothing grows with the number of tasks but what is read.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(2 * BUCKETS, np.int32)
        rows = 0
        for batch in batches:
            for part in slices(batch.column(0)):
                starts, ends, places = part.words(NORMAL)
                hashes = part.span_hash(part.prefix_hash(lower=True), starts, ends)
                key = row_of(places).astype(np.uint64) << np.uint64(48) | hashes >> np.uint64(16)
                key.sort()
                first = np.ones(len(key), bool)
                first[1:] = key[1:] != key[:-1]
                words = key[first] << np.uint64(16)  # the document's bits go, the buckets' stay
                for table, bucket in enumerate(_buckets(words)):
                    counts[table * BUCKETS : (table + 1) * BUCKETS] += np.bincount(bucket, minlength=BUCKETS).astype(np.int32)
                rows += part.n
        if rows:
            arrays = [*np.split(counts.astype("<i8"), PIECES), np.array([rows], "<i8")]
            yield pa.RecordBatch.from_arrays([pa.array(range(PIECES + 1), pa.int32()), pa.array([x.tobytes() for x in arrays], pa.binary())], names=["place", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for place, raw in zip(*[batch.column(i).to_pylist() for i in range(2)], strict=True):
                sums[place] = sums.get(place, 0) + np.frombuffer(raw, "<i8")
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], names=["place", "counts"])

    schema = "place int, counts binary"
    found = docs.select(F.col(f"`{text}`")).mapInArrow(count, schema).repartition("place").mapInArrow(add, schema)
    sums = {r.place: np.frombuffer(r.counts, "<i8") for r in found.collect()}
    if not sums:
        return np.zeros((2, BUCKETS))
    total, counts = sums.pop(PIECES)[0], np.concatenate([sums[k] for k in range(PIECES)])
    return np.log1p(total / np.maximum(counts, 1.0)).reshape(2, BUCKETS)


def word_idf(hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    first, second = _buckets(hashes)
    return np.maximum(weights[0][first], weights[1][second])


def vectors(part: Slice, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows, ids (48 bits, ascending by row) and weights of the distinct shingles; per row the words and a key of 128 bits."""
    starts, ends, places = part.words(NORMAL)
    hashes = part.span_hash(part.prefix_hash(lower=True), starts, ends)
    n_words = np.diff(places)
    keys = [Prefix(halves(salted)).spans(places[:-1], places[1:]) for salted in (hashes, mix64(hashes ^ ODD))]
    idf = word_idf(hashes, weights)
    first, rows = windows(places, SHINGLE)
    shingles = window_hash(hashes, first, SHINGLE)
    mean = sum((idf[first + k] for k in range(SHINGLE)), np.zeros(len(first))) / SHINGLE
    short = np.flatnonzero((n_words > 0) & (n_words < SHINGLE))
    if len(short):
        rows = np.concatenate([rows, short])
        shingles = np.concatenate([shingles, keys[0][short]])
        mean = np.concatenate([mean, [idf[places[i] : places[i + 1]].mean() for i in short]])
    key = (rows.astype(np.uint64) << np.uint64(48)) | (shingles >> np.uint64(16))
    order = np.argsort(key)
    key = key[order]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    at = np.flatnonzero(new)
    count = np.diff(np.append(at, len(key)))
    return (key[at] >> np.uint64(48)).astype(np.int64), key[at] & np.uint64((1 << 48) - 1), mean[order][at] * count, n_words, *keys


def samples(n: int, rows: np.ndarray, ids: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """``n`` x ``RUNS * BINS`` samples as 64-bit values; two rows' samples are equal as often as the rows are similar."""
    out = np.zeros((n, RUNS * BINS), np.uint64)
    log_weight = np.log(weights)
    half = np.uint64(0xFFFFFFFF)
    unit = lambda x: (x.astype(np.float64) + 0.5) / 2.0**32
    for run in range(RUNS):
        a = mix64(ids + np.uint64((3 * run + 1) * int(ODD) & 0xFFFFFFFFFFFFFFFF))
        b, c = mix64(a ^ np.uint64(0x5851F42D4C957F2D)), mix64(a + np.uint64(0x14057B7EF767814F))
        gamma = -np.log(unit(a >> np.uint64(32)) * unit(a & half))
        log_c = np.log(-np.log(unit(b >> np.uint64(32)) * unit(b & half)))
        beta = unit(c >> np.uint64(32))
        step = np.floor(log_weight / gamma + beta)
        value = log_c - gamma * (step - beta) - gamma
        least = np.full(n * BINS, np.inf)
        np.minimum.at(least, rows * BINS + (c & np.uint64(BINS - 1)).astype(np.int64), value)
        least = least.reshape(n, BINS)
        empty = np.argwhere(np.isinf(least))
        filled = least.copy()
        for attempt in range(12):
            if not len(empty):
                break
            other = mix64((empty[:, 1] * 64 + attempt + 4096 * run).astype(np.uint64) * ODD) % np.uint64(BINS)
            got = least[empty[:, 0], other.astype(np.int64)]
            ok = np.isfinite(got)
            filled[empty[ok, 0], empty[ok, 1]] = got[ok]
            empty = empty[~ok]
        if len(empty):  # the least over all bins is a sample of the whole text
            filled[empty[:, 0], empty[:, 1]] = least.min(1)[empty[:, 0]]
        out[:, run * BINS : (run + 1) * BINS] = mix64(filled.view(np.uint64) ^ np.uint64(run))
    return out


def signatures(docs: DataFrame, weights: np.ndarray, text: str = "text", keep: Sequence[str] = ("doc_id", "text")) -> DataFrame:
    """``keep`` and, per row, the number of words, the key of its words, its bands and its sketch."""
    held = docs.sparkSession.sparkContext.broadcast(weights)

    def make():
        def compute(part: Slice, _) -> dict:
            rows, ids, weight, n_words, k1, k2 = vectors(part, held.value)
            got = samples(part.n, rows, ids, weight)
            bands = np.stack([window_hash(np.ascontiguousarray(got[:, ROWS * b : ROWS * (b + 1)]).ravel(), np.arange(part.n) * ROWS, ROWS) for b in range(BANDS)], 1)
            nibbles = (got & np.uint64(15)).astype(np.uint8)
            sketch = (nibbles[:, ::2] | nibbles[:, 1::2] << 4).view(np.uint64)
            lists = lambda x: pa.ListArray.from_arrays(pa.array(np.arange(part.n + 1) * x.shape[1], pa.int32()), pa.array(np.ascontiguousarray(x).view(np.int64).ravel()))
            return {"__n": n_words, "__k1": k1.view(np.int64), "__k2": k2.view(np.int64), "__bands": lists(bands), "__sketch": lists(sketch)}

        return compute

    return map_text(docs, text, keep, SIGNATURE, make)


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Of two texts' ids (ascending) and weights."""
    common, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    least = np.minimum(a[1][i], b[1][j]).sum() if len(common) else 0.0
    return float(least / (a[1].sum() + b[1].sum() - least))


def similar(pairs: DataFrame, texts: DataFrame, weights: np.ndarray, threshold: float) -> DataFrame:
    """``a, b, linked`` for pairs of nodes ``a, b``; ``texts`` has ``rid, body``. Each pair's texts meet by two joins."""
    held = pairs.sparkSession.sparkContext.broadcast(weights)
    joined = pairs.join(texts.select(F.col("rid").alias("a"), F.col("body").alias("body_a")).hint("merge"), "a")
    joined = joined.join(texts.select(F.col("rid").alias("b"), F.col("body").alias("body_b")).hint("merge"), "b").select("a", "b", "body_a", "body_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[int, tuple] = (-1, ())
        for batch in batches:
            texts_a, linked = batch.column(2), []
            b_ids, texts_b = batch.column(1).to_pylist(), batch.column(3)
            for part in slices(texts_a):
                rows, ids, weight, *_ = vectors(part, held.value)
                edge = np.searchsorted(rows, np.arange(part.n + 1))
                for i in range(part.n):
                    at = part.lo + i
                    if seen[0] != b_ids[at]:
                        (other,) = slices(texts_b.slice(at, 1))
                        _, ids_b, weight_b, *_ = vectors(other, held.value)
                        seen = (b_ids[at], (ids_b, weight_b))
                    span = slice(edge[i], edge[i + 1])
                    linked.append(weighted_jaccard((ids[span], weight[span]), seen[1]) >= threshold)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(linked, pa.bool_())], names=["a", "b", "linked"])

    return joined.mapInArrow(run, "a long, b long, linked boolean")


def neighbours(labelled: DataFrame) -> DataFrame:
    """Pairs ``a < b`` of nodes that stand ``1..NEAR`` apart in a bucket sorted by sketch, have different roots and may be similar.

    The sketch is read from another place in each band, so that a node has other neighbours in each. Buckets are sorted
    by range, so that one with many members lies in several partitions.
    """
    turn = [F.get("sketch", (F.col("band") + i) % SKETCH_LONGS).alias(f"s{i}") for i in range(2)]
    rows = labelled.select("band", "h", *turn, "node", "root", "sketch")
    rows = rows.repartitionByRange(partitions_for(rows), "band", "h", "s0", "s1", "node").sortWithinPartitions("band", "h", "s0", "s1", "node").select("band", "h", "node", "root", "sketch")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[np.ndarray, np.ndarray] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in range(4)], 1)
            sketches = batch.column(4).flatten().to_numpy(zero_copy_only=False).reshape(-1, SKETCH_LONGS).view(np.uint64)
            if held is not None:  # the last rows of the batch before
                keys, sketches = np.concatenate([held[0], keys]), np.concatenate([held[1], sketches])
            done = 0 if held is None else len(held[0])
            for gap in range(1, NEAR + 1):
                i = np.arange(max(done, gap), len(keys))
                j = i - gap
                ok = (keys[i, :2] == keys[j, :2]).all(1) & (keys[i, 3] != keys[j, 3])
                i, j = i[ok], j[ok]
                apart = np.bitwise_count(sketches[i] ^ sketches[j]).sum(1, dtype=np.int64)
                ok = 1 - 2 * apart / (64 * SKETCH_LONGS) >= SKETCH_LEAST  # unequal samples have half of their bits in common
                a, b = keys[i[ok], 2], keys[j[ok], 2]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])
            held = keys[-NEAR:].copy(), sketches[-NEAR:].copy()

    return rows.mapInArrow(run, "a long, b long")


def block_links(band: int, mine: np.ndarray, nodes: np.ndarray, roots: np.ndarray, bands: np.ndarray, texts: pa.Array, weights: np.ndarray, threshold: float) -> list[tuple[int, int]]:
    """Links among members of one bucket that stand in different blocks, or in the only one (``mine``: each one's block).

    Every pair is verified but those in one component (by ``roots`` or links found here) and those that share an earlier band.
    """
    found = [(r + part.lo, ids, w) for part in slices(texts) for r, ids, w, *_ in [vectors(part, weights)]]
    rows, ids, weight = (np.concatenate(x) for x in zip(*found, strict=True))
    edge = np.searchsorted(rows, np.arange(len(nodes) + 1))
    kinds, at = np.unique(ids, return_inverse=True)
    total = np.bincount(rows, weight, len(nodes))
    label, dense, alone, out = roots.copy(), np.zeros(len(kinds)), len(np.unique(mine)) == 1, []
    for i in range(len(nodes)):
        j = np.arange(i + 1, len(nodes))
        # no two texts are more similar than their weights are
        j = j[(label[j] != label[i]) & (alone | (mine[j] != mine[i])) & (np.minimum(total[j], total[i]) >= (threshold - 1e-9) * np.maximum(total[j], total[i]))]
        j = j[~(bands[j, :band] == bands[i, :band]).any(1)]
        if not len(j):
            continue
        own = slice(edge[i], edge[i + 1])
        dense[at[own]] = weight[own]
        sizes = edge[j + 1] - edge[j]
        begin = np.cumsum(sizes) - sizes
        flat = np.repeat(edge[j] - begin, sizes) + np.arange(sizes.sum())
        common = np.add.reduceat(np.minimum(dense[at[flat]], weight[flat]), begin)
        dense[at[own]] = 0
        score = common / (total[i] + total[j] - common)
        for k in j[score >= threshold - 1e-9].tolist():
            other = slice(edge[k], edge[k + 1])
            if label[k] != label[i] and weighted_jaccard((ids[own], weight[own]), (ids[other], weight[other])) >= threshold:
                out.append((int(nodes[i]), int(nodes[k])))
                label[label == label[k]] = label[i]
    return out


def remaining(members: DataFrame, texts: DataFrame, roots: DataFrame, weights: np.ndarray, threshold: float) -> tuple[DataFrame, DataFrame]:
    """The links ``a, b`` that join what ``roots`` (``node, root``) leaves apart (see the exact round above), and the settled table that they are made from."""
    held = members.sparkSession.sparkContext.broadcast(weights)
    labelled = members.select("band", "h", "node").join(texts.select(F.col("rid").alias("node"), "size").hint("merge"), "node")
    labelled = settled(labelled.join(roots.hint("merge"), "node", "left").select("band", "h", "node", "size", F.coalesce("root", "node").alias("root")), "labelled")
    parts = F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("size") / BLOCK_BYTES)).cast("long")
    mixed = labelled.groupBy("band", "h").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), parts.alias("parts")).filter("lo < hi").select("band", "h", "parts")
    apart = labelled.join(mixed.hint("merge"), ["band", "h"]).withColumn("mine", F.expr("pmod(xxhash64(node, band), parts)"))
    apart = apart.join(texts.select(F.col("rid").alias("node"), "bands", "body").hint("merge"), "node")
    apart = apart.withColumn("other", F.explode(F.expr("sequence(0L, parts - 1)"))).withColumns({"x": F.least("mine", "other"), "y": F.greatest("mine", "other")})

    def run(key: tuple, table: pa.Table) -> pa.Table:
        column = lambda c: table.column(c).combine_chunks()
        bands = column("bands").flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, BANDS)
        mine = column("mine").to_numpy(zero_copy_only=False)
        first, second = key[2].as_py(), key[3].as_py()
        got: list = []
        if first == second or len(np.unique(mine)) == 2:
            got = block_links(key[0].as_py(), mine, column("node").to_numpy(zero_copy_only=False), column("root").to_numpy(zero_copy_only=False), bands, column("body"), held.value, threshold)
        return pa.table({"a": pa.array([a for a, _ in got], pa.int64()), "b": pa.array([b for _, b in got], pa.int64())})

    return apart.select("band", "h", "x", "y", "node", "root", "mine", "bands", "body").groupBy("band", "h", "x", "y").applyInArrow(run, "a long, b long"), labelled


def _roots(members: DataFrame, texts: DataFrame, weights: np.ndarray, threshold: float) -> DataFrame:
    """``node, root`` of the verified links among ``members`` (``band, h, node``, buckets of two or more); ``texts``: ``rid, body, size, sketch, bands``."""
    sizes = members.groupBy("band", "h").agg(F.count("*").alias("size"))
    score = members.select("band", "h", "node").join(sizes, ["band", "h"]).groupBy("node").agg(F.sum("size").alias("score"))
    scored = settled(members.select("band", "h", "node").join(score, "node"), "scored")
    hubs = scored.groupBy("band", "h").agg(F.max(F.struct("score", "node")).alias("top")).select("band", "h", F.col("top.node").alias("hub"), F.col("top.score").alias("rank"))
    pairs = settled(scored.join(hubs, ["band", "h"]).filter("node <> hub").groupBy(F.col("node").alias("a"), F.col("hub").alias("b")).agg(F.max("rank").alias("rank")), "pairs")
    first = settled(similar(pairs.select("a", "b"), texts, weights, threshold), "verified")
    links = first.filter("linked").select("a", "b")

    # then neighbours in the buckets' order, unless both are similar to the same chief hub
    chief = links.join(pairs, ["a", "b"]).groupBy("a").agg(F.max(F.struct("rank", "b")).alias("top")).select(F.col("a").alias("node"), F.col("top.b").alias("chief"))
    known = texts.select(F.col("rid").alias("node"), "sketch").join(chief, "node", "left").select("node", "sketch", F.coalesce("chief", "node").alias("root"))
    labelled = members.join(known, "node")
    near = neighbours(labelled).distinct().join(first.select("a", "b"), ["a", "b"], "left_anti")
    second = similar(near, texts, weights, threshold).filter("linked").select("a", "b")
    roots = settled(components(links.unionByName(second), "a", "b"), "joined")
    released(scored, pairs, first)
    rest, made_from = remaining(members, texts, roots, weights, threshold)
    out = components(roots.filter("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(rest), "a", "b")
    released(roots, made_from)
    return out


def classes(docs: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",), doc: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """``keep``, ``class_id`` and ``kept``, one row for each row of ``docs``. Of columns that share a name with a computed one, the computed one stays."""
    keep = besides(keep, ("class_id", "kept"))
    names = {c: f"c{i}" for i, c in enumerate(dict.fromkeys([*keep, doc, text]))}
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    body, number = names[text], names[doc]
    weights = word_weights(rows, body)
    signed = signatures(rows, weights, body, list(names.values()))
    signed = signed.withColumn("__rid", F.monotonically_increasing_id())
    signed = signed.withColumn("__k1", F.when(F.col("__n") > 0, F.col("__k1")).otherwise(F.col("__rid"))).withColumn("__k2", F.when(F.col("__n") > 0, F.col("__k2")).otherwise(F.lit(0)))
    signed = settled(signed, "signed")
    # texts with equal words are one node, named by its first row
    firsts = signed.select("__k1", "__k2", F.col("__rid"), F.col(number).cast("long").alias("__doc"), (F.col("__n") > 0).alias("__worded"))
    nodes = settled(firsts.groupBy("__k1", "__k2").agg(F.min("__rid").alias("node"), F.min(F.struct("__doc", "__rid")).alias("least"), F.max("__worded").alias("worded")), "nodes")
    bands = signed.select(F.col("__rid").alias("node"), "__bands").join(nodes.filter("worded").select("node").hint("merge"), "node")
    bands = bands.select("node", F.posexplode("__bands").alias("band", "h"))
    many = bands.groupBy("band", "h").agg(F.count("*").alias("size")).filter("size > 1").select("band", "h")
    # the same kind of join at every size: the buckets grow with the rows
    members = settled(bands.join(many.hint("merge"), ["band", "h"]), "members")
    # only members of buckets are ever compared; their texts are moved once, at every size by the same kind of join
    texts = signed.select(F.col("__rid").alias("rid"), F.col(body).alias("body"), F.octet_length(body).alias("size"), F.col("__sketch").alias("sketch"), F.col("__bands").alias("bands"))
    texts = settled(texts.join(members.select(F.col("node").alias("rid")).distinct().hint("merge"), "rid", "left_semi"), "texts")
    roots = _roots(members, texts, weights, threshold)
    rooted = settled(nodes.join(roots, "node", "left").select("__k1", "__k2", "least", F.coalesce("root", "node").alias("root")), "rooted")
    least = rooted.groupBy("root").agg(F.min("least").alias("top"))
    found = settled(rooted.join(least, "root").select("__k1", "__k2", F.col("top.__doc").alias("class_id"), F.col("top.__rid").alias("__first")), "classes")
    released(nodes, members, texts, rooted)
    out = signed.select(*[names[c] for c in keep], "__k1", "__k2", "__rid").join(found, ["__k1", "__k2"])
    return out.select(*[F.col(names[c]).alias(c) for c in keep], "class_id", (F.col("__rid") == F.col("__first")).alias("kept"))


def keep_one(docs: DataFrame, text: str = "text", doc: str = "doc_id") -> DataFrame:
    """One row of each class, with its own columns."""
    own = {c: f"own{i}" for i, c in enumerate(docs.columns)}
    marked = classes(docs.select(*[F.col(f"`{c}`").alias(n) for c, n in own.items()]), own[text], list(own.values()), own[doc])
    return marked.filter("kept").select(*[F.col(n).alias(c) for c, n in own.items()])


def query(spark, sf_dir: str) -> DataFrame:
    return classes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
