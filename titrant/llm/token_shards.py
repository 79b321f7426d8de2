"""Token-ID output: a wavelet matrix per shard.

A shard holds some consecutive documents' token ids. Its matrix has one bit plane per bit of an id, the highest first;
below each plane the ids stand stably partitioned by that plane's bit. With the number of ones before each block of 512
bits, ``access``, ``rank`` (how often a token stands in a prefix) and ``select`` (where its k-th occurrence stands) take
one step per plane. A shard's file is: ``WVM2``, a length, a JSON head (counts, zeros per plane, sizes of frames), then
zstandard frames: whether there is a document id, the document ids, their numbers of tokens, for every plane the ones
before its blocks, and for every plane its bits in chunks of ``CHUNK`` bytes. A frame is inflated when it is first
needed, so a step reads one list of blocks and one chunk of a plane.

Shards are rows of a Parquet table (``part``, ``shard``, ``first_token`` within the part, ``n_docs``, ``n_tokens``,
``blob``), so Spark's commit protocol covers them, any store that Spark writes to will do, and a lost executor's shards
are written again. Documents are range-partitioned and sorted by id (ties: by the text's hash, then as they come), so shards hold ascending ids; the
ids that stand before a part are a sum over earlier parts, of which there are as many as partitions.

Edge cases: a null or empty text is the end id alone; a null doc_id sorts first; repeated rows are documents of their
own; an empty table gives no shard. A document is never split over shards, so a very long one makes a long shard.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from . import presplit
from .bytewords import Slice, slices
from .storage import partitions_for, shared_folder

END_ID = 2
SHARD_TOKENS = 1 << 20
BLOCK = 512
#: Bytes of a plane in one frame; a multiple of a block's.
CHUNK = 1 << 15
_MAGIC = b"WVM2"


class Planes:
    """Bits of planes, whole ones in memory."""

    def __init__(self, bits: list[np.ndarray]):
        self.bits = bits
        self.counts: dict[int, np.ndarray] = {}

    def __len__(self) -> int:
        return len(self.bits)

    def whole(self, depth: int) -> np.ndarray:
        return self.bits[depth]

    def block(self, depth: int, at: int) -> np.ndarray:
        """The bytes of a block."""
        return self.bits[depth][at * BLOCK // 8 : (at + 1) * BLOCK // 8]

    def before(self, depth: int) -> np.ndarray:
        """The ones before each block, and all ones."""
        if depth not in self.counts:
            raw = self.bits[depth]
            ones = np.zeros(-(-len(raw) * 8 // BLOCK) * BLOCK // 8, np.uint8)
            np.bitwise_count(raw, out=ones[: len(raw)])
            total = ones.reshape(-1, BLOCK // 8).sum(1, dtype=np.uint32)
            self.counts[depth] = np.concatenate([np.zeros(1, np.uint32), np.cumsum(total, dtype=np.uint32)])
        return self.counts[depth]


class StoredPlanes(Planes):
    """Bits of planes in the frames of a file, inflated as they are needed."""

    def __init__(self, blob: memoryview, step: int, counts: list[tuple[int, int]], chunks: list[list[tuple[int, int]]]):
        super().__init__([np.zeros(0, np.uint8)] * len(chunks))
        self.blob, self.step, self.where, self.chunks, self.opener = blob, step, counts, chunks, zstandard.ZstdDecompressor()
        self.inflated: dict[tuple[int, int], np.ndarray] = {}

    def _frame(self, at: tuple[int, int], kind: str) -> np.ndarray:
        return np.frombuffer(self.opener.decompress(self.blob[at[0] : at[0] + at[1]]), kind)

    def whole(self, depth: int) -> np.ndarray:
        return np.concatenate([np.zeros(0, np.uint8), *[self._frame(c, np.uint8) for c in self.chunks[depth]]])

    def block(self, depth: int, at: int) -> np.ndarray:
        c, lo = divmod(at * BLOCK // 8, self.step)
        if (depth, c) not in self.inflated:
            self.inflated[depth, c] = self._frame(self.chunks[depth][c], np.uint8)
        return self.inflated[depth, c][lo : lo + BLOCK // 8]

    def before(self, depth: int) -> np.ndarray:
        if depth not in self.counts:
            self.counts[depth] = self._frame(self.where[depth], "<u4")
        return self.counts[depth]


class WaveletMatrix:
    """Over ``ids`` below ``2 ** planes``."""

    def __init__(self, bits: Planes, zeros: list[int], n: int):
        self.bits, self.zeros, self.n, self.planes = bits, zeros, n, len(bits)

    @classmethod
    def build(cls, ids: np.ndarray, planes: int) -> WaveletMatrix:
        kind = np.uint16 if planes <= 16 else np.uint32
        now, bits, zeros = np.asarray(ids).astype(kind), [], []
        for p in range(planes - 1, -1, -1):
            bit = (now & kind(1 << p)).astype(bool)
            bits.append(np.packbits(bit, bitorder="little"))
            # faster than masks, whose time hangs on how the bits alternate
            now = np.concatenate([low := np.compress(~bit, now), np.compress(bit, now)])
            zeros.append(len(low))
        return cls(Planes(bits), zeros, len(ids))

    def all_ids(self) -> np.ndarray:
        """Every id, from the lowest plane up."""
        kind = np.uint16 if self.planes <= 16 else np.uint32
        out = np.zeros(self.n, kind)
        for depth in range(self.planes - 1, -1, -1):
            bit = np.unpackbits(self.bits.whole(depth), count=self.n, bitorder="little").view(bool)
            back = np.empty_like(out)
            back[np.flatnonzero(~bit)] = out[: self.zeros[depth]]
            back[np.flatnonzero(bit)] = out[self.zeros[depth] :] | kind(1 << (self.planes - 1 - depth))
            out = back
        return out.astype(np.uint32)

    def _ones(self, depth: int, i: int) -> int:
        """Ones among the first ``i`` bits of a plane."""
        at, rest = divmod(i, BLOCK)
        count = int(self.bits.before(depth)[at])
        if rest:
            raw = self.bits.block(depth, at)[: -(-rest // 8)]
            count += int(np.bitwise_count(raw[: rest // 8]).sum()) + (int(raw[-1]) & ((1 << rest % 8) - 1)).bit_count() * (rest % 8 > 0)
        return count

    def _bit(self, depth: int, i: int) -> int:
        return int(self.bits.block(depth, i // BLOCK)[i % BLOCK // 8]) >> (i % 8) & 1

    def _place(self, depth: int, one: int, k: int) -> int:
        """Where the bit number ``k`` (from 0) of its kind stands in a plane."""
        before = self.bits.before(depth).astype(np.int64)
        if not one:
            before = np.arange(len(before)) * BLOCK - before
        at = int(np.searchsorted(before, k, "right")) - 1
        bit = np.unpackbits(self.bits.block(depth, at), bitorder="little")
        return at * BLOCK + int(np.flatnonzero(bit == one)[k - int(before[at])])

    def access(self, i: int) -> int:
        """The id at place ``i``."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        out = 0
        for depth in range(self.planes):
            bit = self._bit(depth, i)
            ones = self._ones(depth, i)
            i = self.zeros[depth] + ones if bit else i - ones
            out = out << 1 | bit
        return out

    def _span(self, token: int, i: int) -> tuple[int, int]:
        lo, hi = 0, i
        for depth in range(self.planes):
            a, b = self._ones(depth, lo), self._ones(depth, hi)
            if token >> (self.planes - 1 - depth) & 1:
                lo, hi = self.zeros[depth] + a, self.zeros[depth] + b
            else:
                lo, hi = lo - a, hi - b
        return lo, hi

    def rank(self, token: int, i: int | None = None) -> int:
        """How often ``token`` stands among the first ``i`` ids (all, if not given)."""
        if not 0 <= token < 1 << self.planes:
            return 0
        lo, hi = self._span(token, self.n if i is None else i)
        return hi - lo

    def select(self, token: int, k: int) -> int:
        """The place of the occurrence number ``k`` (from 0) of ``token``; -1 if it has fewer."""
        if not 0 <= k < self.rank(token):
            return -1
        at = self._span(token, 0)[0] + k
        for depth in range(self.planes - 1, -1, -1):
            one = token >> (self.planes - 1 - depth) & 1
            at = self._place(depth, one, at - self.zeros[depth] if one else at)
        return at

    def find(self, token: int) -> np.ndarray:
        """All places of ``token``, ascending: its range below the last plane, carried up a plane at a time."""
        if not self.rank(token):
            return np.zeros(0, np.int64)
        places = np.arange(*self._span(token, self.n))
        for depth in range(self.planes - 1, -1, -1):
            one = token >> (self.planes - 1 - depth) & 1
            bit = np.unpackbits(self.bits.whole(depth), count=self.n, bitorder="little")
            places = np.flatnonzero(bit == one)[places - self.zeros[depth] if one else places]
        return places


def pack(doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray, planes: int) -> bytes:
    matrix = WaveletMatrix.build(ids, planes)
    packer = zstandard.ZstdCompressor(level=1)
    known = np.array([d is not None for d in doc_ids], np.uint8)
    lists = [known, np.array([d or 0 for d in doc_ids], "<i8"), np.asarray(lengths, "<i8"), *[matrix.bits.before(p).astype("<u4") for p in range(planes)]]
    frames = [packer.compress(x.tobytes()) for x in lists]
    for p in range(planes):
        raw = matrix.bits.whole(p).tobytes()
        frames += [packer.compress(raw[at : at + CHUNK]) for at in range(0, len(raw), CHUNK)]
    head = json.dumps({"docs": len(doc_ids), "tokens": len(ids), "zeros": matrix.zeros, "chunk": CHUNK, "sizes": [len(f) for f in frames]}).encode()
    return b"".join([_MAGIC, struct.pack("<I", len(head)), head, *frames])


def unpack(blob: bytes) -> tuple[list[int | None], np.ndarray, WaveletMatrix]:
    """Document ids, their numbers of tokens, and the matrix, whose planes stay compressed until they are needed."""
    if blob[:4] != _MAGIC:
        raise ValueError("not a token shard")
    (size,) = struct.unpack_from("<I", blob, 4)
    head = json.loads(blob[8 : 8 + size])
    begin = 8 + size + np.cumsum([0, *head["sizes"]])
    frames = list(zip(begin[:-1].tolist(), head["sizes"], strict=True))
    planes = len(head["zeros"])
    each = (len(frames) - 3 - planes) // planes if planes else 0
    stored = StoredPlanes(memoryview(blob), head["chunk"], frames[3 : 3 + planes], [frames[3 + planes + p * each : 3 + planes + (p + 1) * each] for p in range(planes)])
    known, docs, lengths = (stored._frame(frames[i], kind) for i, kind in enumerate((np.uint8, "<i8", "<i8")))
    ids = [int(d) if k else None for d, k in zip(docs, known, strict=True)]
    return ids, lengths, WaveletMatrix(stored, head["zeros"], head["tokens"])


class ByteTokenizer:
    """The library's byte-level BPE, asked once per distinct piece of a text.

    Pieces go to the library's model as it is, in its byte alphabet: its whole pipeline would split each of them again,
    and make an object with all offsets for each.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.special = [t.content.encode() for t in self.library.get_added_tokens_decoder().values()]
        self.planes = max(1, (self.library.get_vocab_size(with_added_tokens=True) - 1).bit_length())
        self.pieces = presplit.Pieces(self._entries)
        self.shown = dict(enumerate(presplit.byte_alphabet()))

    def _entries(self, pieces: list[bytes]) -> list:
        tokenize = self.library.model.tokenize
        shown = b"".join(pieces).decode("latin-1").translate(self.shown)
        ends = list(accumulate(map(len, pieces)))
        return [tuple([t.id for t in tokenize(shown[a:b])]) for a, b in zip([0, *ends], ends, strict=False)]

    def encode_slice(self, part: Slice, end: int | None) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a slice, and the number of them by text."""
        narrow = presplit.narrow_rows(part)
        starts, ends, places = presplit.split(part, part.buf, spaced=True)
        whole = part.buf.tobytes()
        rare = any(s in whole for s in self.special)
        slow = [i for i in range(part.n) if not narrow[i] or rare and any(s in part.text(i) for s in self.special)]
        if slow:  # the library takes these whole; their pieces are left out here
            row = np.repeat(np.arange(part.n), np.diff(places))
            fast = ~np.isin(row, slow)
            starts, ends, row = starts[fast], ends[fast], row[fast]
            places = np.searchsorted(row, np.arange(part.n + 1))
        entries, back = self.pieces.entries(part, part.buf, starts, ends)
        extra = len(entries)
        entries = [*entries, *[tuple(self.library.encode(part.text(i).decode(), add_special_tokens=False).ids) for i in slow]]
        back = np.insert(back, places[np.array(slow, int)], extra + np.arange(len(slow)))
        per_row = np.diff(places)
        per_row[slow] += 1
        if end is not None:
            back = np.insert(back, np.cumsum(per_row), len(entries))
            entries.append((end,))
            per_row = per_row + 1
        size = np.fromiter(map(len, entries), np.int64, len(entries))
        flat = np.fromiter(chain.from_iterable(entries), np.uint32, int(size.sum()))
        at = np.cumsum(size) - size
        out = size[back]
        ids = flat[np.repeat(at[back] - (np.cumsum(out) - out), out) + np.arange(int(out.sum()))]
        total = np.concatenate([[0], np.cumsum(out)])
        edge = np.concatenate([[0], np.cumsum(per_row)])
        return ids, np.diff(total[edge])


_LOADED: dict[str, ByteTokenizer] = {}


def tokenizer(path: str) -> ByteTokenizer:
    if path not in _LOADED:
        _LOADED[path] = ByteTokenizer(path)
    return _LOADED[path]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


SHARDS = T.StructType([T.StructField(n, t) for n, t in (("part", T.IntegerType()), ("shard", T.IntegerType()), ("first_token", T.LongType()), ("n_docs", T.LongType()), ("n_tokens", T.LongType()), ("blob", T.BinaryType()))])


def write_shards(docs: DataFrame, folder: str, path: str | None = None, doc: str = "doc_id", text: str = "text", end: int | None = END_ID, shard_tokens: int = SHARD_TOKENS) -> None:
    """Encode all documents and write the shards to ``folder``, in ascending order of ``doc``."""
    rows = docs.select(F.col(f"`{doc}`").cast("long").alias("d"), F.col(f"`{text}`").alias("t"), F.xxhash64(F.col(f"`{text}`")).alias("h"), F.monotonically_increasing_id().alias("i"))
    # texts are no sort keys, as those of a sample go to the driver; the last key spreads rows that are equal
    ordered = rows.repartitionByRange(partitions_for(rows), "d", "h", "i").sortWithinPartitions("d", "h", "i").select("d", "t")
    arrow = to_arrow_schema(SHARDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = tokenizer(path or default_path())
        part, shard, first = TaskContext.get().partitionId(), 0, 0
        held: list[tuple[list, np.ndarray, np.ndarray]] = []
        count = 0

        def flush() -> pa.RecordBatch:
            nonlocal shard, first, count, held
            ids = np.concatenate([x[2] for x in held])
            docs_, lengths = list(chain.from_iterable(x[0] for x in held)), np.concatenate([x[1] for x in held])
            row = [part, shard, first, len(docs_), len(ids), pack(docs_, lengths, ids, model.planes)]
            shard, first, count, held = shard + 1, first + len(ids), 0, []
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, arrow, strict=True)], schema=arrow)

        for batch in batches:
            for s in slices(batch.column(1)):
                ids, lengths = model.encode_slice(s, end)
                held.append((batch.column(0).slice(s.lo, s.n).to_pylist(), lengths, ids))
                count += len(ids)
                if count >= shard_tokens:
                    yield flush()
        if held:
            yield flush()

    ordered.mapInArrow(run, SHARDS).write.mode("overwrite").parquet(folder)


def part_starts(shards: DataFrame) -> dict[int, int]:
    """The number of ids before each part: one row for each partition that was written."""
    totals = sorted((r.part, r.n) for r in shards.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect())
    out, before = {}, 0
    for p, n in totals:
        out[p] = before
        before += n
    return out


def read_documents(spark, folder: str) -> DataFrame:
    """From the shards alone: ``doc_id, start, n_tokens, ids_crc32``."""
    shards = spark.read.parquet(folder)
    starts = part_starts(shards)
    schema = T.StructType.fromDDL("doc_id long, start long, n_tokens long, ids_crc32 long")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, first, blob in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                docs, lengths, matrix = unpack(blob)
                ids = matrix.all_ids().astype("<u4", copy=False)
                edge = np.concatenate([[0], np.cumsum(lengths)])
                view = memoryview(ids).cast("B")
                crc = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(edge[:-1] + first + starts[part]), pa.array(lengths, pa.int64()), pa.array(crc, pa.int64())], schema=arrow)

    return shards.select("part", "first_token", "blob").mapInArrow(run, schema)


def count_tokens(spark, folder: str, tokens: list[int]) -> DataFrame:
    """``token, n``: how often each of the tokens stands in all shards, by rank alone."""
    schema = T.StructType.fromDDL("token long, n long")

    def run(batches):
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                matrix = unpack(blob)[2]
                yield pa.RecordBatch.from_arrays([pa.array(tokens, pa.int64()), pa.array([matrix.rank(t) for t in tokens], pa.int64())], names=["token", "n"])

    return spark.read.parquet(folder).select("blob").mapInArrow(run, schema).groupBy("token").agg(F.sum("n").alias("n"))


def find_token(spark, folder: str, token: int) -> DataFrame:
    """``place``: every place of a token, counted over all documents in order."""
    shards = spark.read.parquet(folder)
    starts = part_starts(shards)
    schema = T.StructType.fromDDL("place long")

    def run(batches):
        for batch in batches:
            for part, first, blob in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                yield pa.RecordBatch.from_arrays([pa.array(starts[part] + first + unpack(blob)[2].find(token), pa.int64())], names=["place"])

    return shards.select("part", "first_token", "blob").mapInArrow(run, schema)


def query(spark, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/token-shards-{uuid.uuid4().hex}"
    write_shards(spark.read.parquet(f"{sf_dir}/documents.parquet"), folder)
    return read_documents(spark, folder)
