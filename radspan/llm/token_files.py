"""Token ids in files: canonical length-limited Huffman codes, decoded by table in independent blocks.

Format: a folder with three Parquet tables, which any file system that Spark writes to can hold.

- `header`: one row: code_lengths (a byte per id, 0: the id does not occur), block (ids per block), longest.
- `segments`: one row per run of consecutive documents, in ascending order of the id column: part, inside (ids of the
  part before the segment), doc_ids, doc_lengths, n (ids), payload (the codes, first bit highest) and checkpoints (the
  bit offset of each block, little-endian unsigned 64-bit). Any block can be decoded alone from its checkpoint.
- `parts`: one row per range of documents: part, before (ids of all parts before it).

Documents are tokenised where they lie. Their ids, two bytes each for a vocabulary below 65,536, wait in a work table
while they are counted (a vector of the vocabulary's size per task, summed) and the code is made; then the ids, not the
texts, are sorted by range and written. Reading is a map over segments.

Defined cases: a null text is empty and has its end id alone; a null id sorts first; rows that repeat an id follow one
another, and are dealt to several ranges if there are many; an empty table gives files without segments and an empty
result; other columns are never read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from radspan.llm.common import sized, small_batches, work_dir, work_table
from radspan.llm.tokens import gathered, id_encoder

END_ID = 1
#: A segment is closed at so many ids; ids per block; bits of the longest code, and so of the decoder's table.
SEGMENT, BLOCK, LONGEST = 1 << 19, 128, 20


def code_lengths(counts: np.ndarray, longest: int = LONGEST) -> np.ndarray:
    """Optimal code lengths of at most `longest` bits for ids with these counts (0: no code), by package-merge."""
    out = np.zeros(len(counts), np.uint8)
    used = np.flatnonzero(counts)
    if len(used) < 2:
        out[used] = 1
        return out
    if len(used) > 1 << longest:
        raise ValueError("more ids than codes of this length")
    order = used[np.argsort(counts[used], kind="stable")]
    weights = counts[order].astype(np.int64)
    rows, own = weights, [np.ones(len(weights), bool)]
    for _ in range(longest - 1):
        packages = rows[: len(rows) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate([weights, packages])
        by = np.argsort(both, kind="stable")
        rows = both[by]
        own.append(by < len(weights))
    take, lengths = 2 * len(weights) - 2, np.zeros(len(weights), np.uint8)
    for flags in reversed(own):
        symbols = int(flags[:take].sum())
        lengths[:symbols] += 1
        take = 2 * (take - symbols)
    out[order] = lengths
    return out


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in ascending order of (length, id)."""
    codes, code, before = np.zeros(len(lengths), np.uint32), 0, 0
    order = np.lexsort((np.arange(len(lengths)), lengths))
    for i in order[lengths[order] > 0]:
        code <<= int(lengths[i]) - before
        codes[i], before = code, int(lengths[i])
        code += 1
    return codes


def encode(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray, block: int = BLOCK, at_once: int = SEGMENT) -> tuple[bytes, bytes]:
    """Payload and checkpoints. Works on `at_once` ids at a time, so that a long document takes little more than its codes."""
    bits = sum(int(lengths[ids[a : a + at_once]].sum(dtype=np.int64)) for a in range(0, len(ids), at_once))
    words, checkpoints, done = np.zeros((bits + 31) // 32 + 2, np.uint32), [], 0
    for a in range(0, len(ids), at_once):
        some = ids[a : a + at_once]
        size = lengths[some].astype(np.int64)
        end = np.cumsum(size) + done
        at = end - size
        wide = codes[some].astype(np.uint64) << (64 - (at & 31) - size).astype(np.uint64)  # in the two words from at // 32
        first = done >> 5
        word, n = (at >> 5) - first, int(end[-1] >> 5) - first + 1
        # no two codes share a bit, so sums are unions; sums below 2 ** 32 are exact as doubles
        high = np.bincount(word, (wide >> np.uint64(32)).astype(np.float64), n + 1)
        low = np.bincount(word + 1, (wide & np.uint64(0xFFFFFFFF)).astype(np.float64), n + 1)
        words[first : first + n + 1] |= (high + low).astype(np.uint64).astype(np.uint32)
        checkpoints.append(at[-a % block :: block])
        done = int(end[-1])
    return words.astype(">u4").tobytes()[: (bits + 7) // 8], np.concatenate([*checkpoints, np.zeros(0, np.int64)]).astype("<u8").tobytes()


class Decoder:
    """Decodes all blocks of a payload side by side: step i reads id i of every block."""

    def __init__(self, lengths: np.ndarray, block: int, longest: int = LONGEST):
        self.block, self.longest = block, longest
        used = np.flatnonzero(lengths)
        order = used[np.lexsort((used, lengths[used]))]
        spans = 1 << (longest - lengths[order].astype(np.int64))
        self.ids = np.zeros(1 << longest, np.uint32)
        self.sizes = np.zeros(1 << longest, np.uint8)
        total = int(spans.sum())
        self.ids[:total], self.sizes[:total] = np.repeat(order, spans), np.repeat(lengths[order], spans)

    def decode(self, payload: bytes, checkpoints: bytes, n: int) -> np.ndarray:
        at = np.frombuffer(checkpoints, "<u8").astype(np.int64)
        padded = np.frombuffer(payload + b"\0" * 8, np.uint8).astype(np.uint32)
        window = padded[:-3] << 24 | padded[1:-2] << 16 | padded[2:-1] << 8 | padded[3:]
        out = np.empty((len(at), min(self.block, n)), np.uint32)
        last, rest = len(window) * 8 - 1, np.uint32(32 - self.longest)
        for i in range(out.shape[1]):
            key = (window[at >> 3] << (at & 7).astype(np.uint32)) >> rest
            out[:, i] = self.ids[key]
            at = np.minimum(at + self.sizes[key], last)  # the last block may end early
        return out.reshape(-1)[:n]


def _tokenised(tokenizer_path: str, end_id: int):
    """id, row (a number of the row), n, ids (with the end id, little-endian, of `width` bytes each)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, row = id_encoder(tokenizer_path), TaskContext.get().partitionId() << 40
        kind = np.dtype("<u2" if max(encoder.vocabulary - 1, end_id) < 1 << 16 else "<u4")
        for batch in gathered(batches, 1):
            for first, found, sizes in encoder.encode_column(batch.column(1)):
                ids, sizes = np.insert(found, np.cumsum(sizes), end_id).astype(kind), sizes + 1
                offsets = np.concatenate([[0], np.cumsum(sizes * kind.itemsize)]).astype(np.int32)
                packed = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(sizes)), pa.array(np.arange(row, row + len(sizes))), pa.array(sizes), pa.array(np.full(len(sizes), kind.itemsize, np.int32)), packed], names=["id", "row", "n", "width", "ids"])
                row += len(sizes)

    return run


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each id occurs in the task's rows (width, ids)."""
    total = np.zeros(0, np.int64)
    for batch in batches:
        widths = batch.column(0).to_numpy()
        for width in np.unique(widths):
            some = batch.column(1).filter(pa.array(widths == width))
            n = np.bincount(np.frombuffer(b"".join(some.to_pylist()), f"<u{width}"), minlength=len(total))
            n[: len(total)] += total
            total = n
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_pydict({"id": pa.array(used, pa.int32()), "n": pa.array(total[used], pa.int64())})


def write(docs: DataFrame, tokenizer_path: str, path: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Writes the ids of docs, each document closed by end_id, to the folder `path`."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    ids = work_table(rows.mapInArrow(_tokenised(tokenizer_path, end_id), f"id {kind}, row long, n long, width int, ids binary"), "ids")
    # at most one number for each id of the vocabulary comes to the driver
    counts = {r.id: r.n for r in ids.select("width", "ids").mapInArrow(_counted, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()}
    vector = np.zeros(max(counts, default=-1) + 1, np.int64)
    vector[list(counts)] = list(counts.values())
    lengths = code_lengths(vector)
    packed = spark.sparkContext.broadcast(lengths.tobytes())

    def code(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own = np.frombuffer(packed.value, np.uint8)
        codes, part, inside = canonical_codes(own), TaskContext.get().partitionId(), 0
        of, sizes, held = [], [], []

        def segment() -> pa.RecordBatch:
            every = np.concatenate(held)
            payload, checkpoints = encode(every, own, codes)
            values = {"part": pa.array([part], pa.int32()), "inside": pa.array([inside - len(every)], pa.int64()), "doc_ids": pa.array([of], pa.list_(type_of)), "doc_lengths": pa.array([sizes], pa.list_(pa.int64())), "n": pa.array([len(every)], pa.int64()), "payload": pa.array([payload], pa.binary()), "checkpoints": pa.array([checkpoints], pa.binary())}
            return pa.RecordBatch.from_pydict(values)

        before = 0
        for batch in batches:
            type_of = batch.schema.field(0).type
            for i, n, width, raw in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                of.append(i)
                sizes.append(n)
                held.append(np.frombuffer(raw, f"<u{width}"))
                inside += n
                if inside - before >= SEGMENT:
                    yield segment()
                    of, sizes, held, before = [], [], [], inside
        if held:
            yield segment()

    ranges = ids.repartitionByRange("id", "row").sortWithinPartitions("id", "row").select("id", "n", "width", "ids")
    ranges.mapInArrow(code, f"part int, inside long, doc_ids array<{kind}>, doc_lengths array<long>, n long, payload binary, checkpoints binary").write.parquet(f"{path}/segments")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each range
    sums = spark.read.parquet(f"{path}/segments").groupBy("part").agg(F.sum("n").alias("n"))
    sums.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")).write.parquet(f"{path}/parts")
    header = spark.createDataFrame([(bytearray(lengths.tobytes()), BLOCK, LONGEST)], "code_lengths binary, block int, longest int")
    header.write.parquet(f"{path}/header")


def read(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """One row per document of the files: id, start (ids of all documents before it), n_tokens, ids (little-endian unsigned 32-bit)."""
    small_batches(spark)
    head = spark.read.parquet(f"{path}/header").first()
    lengths, block, longest = bytes(head.code_lengths), head.block, head.longest
    segments, parts = (spark.read.parquet(f"{path}/{x}") for x in ("segments", "parts"))
    rows = segments.join(sized(parts), "part").select((F.col("before") + F.col("inside")).alias("start"), "doc_ids", "doc_lengths", "n", "payload", "checkpoints")
    kind = rows.schema["doc_ids"].dataType.elementType.simpleString()

    def back(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(np.frombuffer(lengths, np.uint8), block, longest)
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                ids = decoder.decode(one.column("payload")[0].as_py(), one.column("checkpoints")[0].as_py(), one.column("n")[0].as_py())
                sizes = one.column("doc_lengths").flatten().to_numpy()
                ends = np.cumsum(sizes)
                raw = ids.astype("<u4").tobytes()
                parts = [raw[4 * a : 4 * b] for a, b in zip((ends - sizes).tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([one.column("doc_ids").flatten(), pa.array(ends - sizes + one.column("start")[0].as_py()), pa.array(sizes), pa.array(parts, pa.binary())], names=["id", "start", "n_tokens", "ids"])

    return rows.mapInArrow(back, f"id {kind}, start long, n_tokens long, ids binary").withColumnRenamed("id", id_col)


def fresh_path(spark: SparkSession) -> str:
    """A new folder for files in the shared work folder."""
    return f"{work_dir(spark)}/radspan-{uuid.uuid4().hex}/token-files"
