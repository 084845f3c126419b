"""Training-order materialisation: a keyed permutation gives every sequence a slot in fixed-stride shards."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import lean
from shelfcast.llm.tokens import PATTERN, Encoder, default_paths
from shelfcast.session import materialize, scratch_dir, shuffle_files_dropped

#: Tokens of a sequence; sequences of a shard; documents that the payload code is fitted on, at most.
LENGTH, SHARD, SAMPLE = 2048, 4096, 2_000
#: The id that fills up a short sequence, and the mark that ends a record.
PAD, MARK = 50_256, b"\x00\n"
KEY = 0x5EED
ROUNDS = 6
#: Copies of one row that are laid out together.
COPIES = 1_000


def stride(length: int = LENGTH) -> int:
    """Bytes of a record: 16-bit little-endian ids and the mark (itself 16 bits, so records stay aligned)."""
    return 2 * length + len(MARK)


class Feistel:
    """A keyed permutation of 0..n-1.

    A balanced Feistel network permutes the numbers of ``2 * half`` bits, the least
    even width that holds ``n``; a result beyond ``n`` is put through it again
    (cycle-walking), under four times on average.
    """

    def __init__(self, n: int, key: int = KEY, rounds: int = ROUNDS):
        self.n = n
        self.half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
        self.keys = np.random.default_rng([key, rounds]).integers(0, 2**63, rounds, dtype=np.uint64)

    def _f(self, x: np.ndarray, key: np.uint64) -> np.ndarray:
        u = np.uint64
        x = (x ^ key) * u(0x9E3779B97F4A7C15)
        x = (x ^ (x >> u(29))) * u(0xBF58476D1CE4E5B9)
        return (x ^ (x >> u(32))) & u((1 << self.half) - 1)

    def _pass(self, x: np.ndarray, keys) -> np.ndarray:
        left, right = x >> np.uint64(self.half), x & np.uint64((1 << self.half) - 1)
        for k in keys:
            left, right = right, left ^ self._f(right, k)
        return left << np.uint64(self.half) | right

    def forward(self, x: np.ndarray) -> np.ndarray:
        return self._walk(np.asarray(x).astype(np.uint64), lambda v: self._pass(v, self.keys))

    def backward(self, x: np.ndarray) -> np.ndarray:
        swap = lambda v: (v & np.uint64((1 << self.half) - 1)) << np.uint64(self.half) | v >> np.uint64(self.half)
        return self._walk(np.asarray(x).astype(np.uint64), lambda v: swap(self._pass(swap(v), self.keys[::-1])))

    def _walk(self, x: np.ndarray, step) -> np.ndarray:
        x = step(x)
        while (out := x >= self.n).any():
            x[out] = step(x[out])
        return x.astype(np.int64)


class Payload:
    """Reversible code for 16-bit ids on their way through tables and shuffles.

    Ids are replaced by their frequency rank (in a bounded sample), so most high
    bytes are 0; low and high bytes are set apart and compressed.  The sample
    changes the size of the payload only.
    """

    def __init__(self, counts: dict[int, int]):
        order = sorted(range(1 << 16), key=lambda i: (-counts.get(i, 0), i))
        self.ids = np.array(order, "<u2")
        self.ranks = np.empty(1 << 16, "<u2")
        self.ranks[self.ids] = np.arange(1 << 16, dtype="<u2")

        self._codec = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_codec": None}  # made anew where it is used

    def _code(self) -> tuple:
        if self._codec is None:
            self._codec = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
        return self._codec

    def pack(self, ids: np.ndarray) -> bytes:
        ranks = self.ranks.take(ids).view(np.uint8)
        planes = np.empty((2, len(ids)), np.uint8)
        planes[0], planes[1] = ranks[::2], ranks[1::2]
        return self._code()[0].compress(planes)

    def unpack(self, data: bytes) -> np.ndarray:
        planes = np.frombuffer(self._code()[1].decompress(data), np.uint8).reshape(2, -1)
        return self.ids[planes[0] | planes[1].astype("<u2") << 8]


def payload_code(docs: DataFrame, paths: tuple[str, str | None], sample: int = SAMPLE) -> Payload:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.shared(paths, PATTERN)
        for b in batches:
            ids = np.concatenate(list(encoder.all_ids(b.column(0)))) if b.num_rows else np.empty(0, "<u4")
            at, n = np.unique(ids, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64)), pa.array(n)], names=["id", "n"])

    n = max(1, docs.count())
    some = docs.where(F.pmod(F.xxhash64("doc_id", F.lit("op6")), F.lit(1 << 30)) < int(min(1.0, sample / n) * (1 << 30)))
    some = some.select(F.substring(F.col("text").cast("string"), 1, 4000).alias("text")).limit(2 * sample)
    rows = some.mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()  # at most the vocabulary
    return Payload({r["id"]: r["n"] for r in rows})


def ordered_documents(docs: DataFrame, paths: tuple[str, str | None], code: Payload) -> DataFrame:
    """(bucket, start, n, copies, doc_id, payload): the tokenised documents in an order that their contents alone decide.

    Rows are ordered by a hash of id and text, then id and digest; buckets are ranges of the hash, one to
    a task, and ``start`` is the row's place among its bucket's tokens.  Rows equal in id and text are
    one row with a number of ``copies``, collapsed before the shuffle as far as a batch goes.
    """
    shared = docs.sparkSession.sparkContext.broadcast(code)
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.shared(paths, PATTERN)
        for b in batches:
            keys, docs_, texts = (c.to_pylist() for c in b.columns)
            first: dict[tuple, int] = {}
            for k in zip(keys, docs_, texts, strict=True):
                first[k] = first.get(k, 0) + 1
            digests, sizes, payloads = [], [], []
            for _, _, text in first:
                ids = encoder.ids(text or "")
                if ids.max() >= 1 << 16:
                    raise ValueError("records hold 16-bit ids; this vocabulary has larger ones")
                ids = ids.astype("<u2")
                digests.append(blake2b(ids.tobytes(), digest_size=16).digest())
                sizes.append(len(ids))
                payloads.append(shared.value.pack(ids))
            yield pa.RecordBatch.from_arrays([
                pa.array([k[0] for k in first], pa.int64()), pa.array([k[1] for k in first], pa.int64()), pa.array(digests, pa.binary()),
                pa.array(sizes, pa.int64()), pa.array(list(first.values()), pa.int64()), pa.array(payloads, pa.binary())],
                names=["key", "doc_id", "digest", "n", "copies", "payload"])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Equal neighbours become one row; the last row waits for the next batch."""
        held, bucket, start = None, None, 0

        def laid(rows: list[tuple]) -> pa.RecordBatch:
            nonlocal bucket, start
            starts = []
            for r in rows:
                bucket, start = r[0], start if r[0] == bucket else 0
                starts.append(start)
                start += r[4] * r[5]
            columns = ([r[0] for r in rows], starts, [r[4] for r in rows], [r[5] for r in rows], [r[2] for r in rows], [r[6] for r in rows])
            kinds = {"bucket": pa.int32(), "start": pa.int64(), "n": pa.int64(), "copies": pa.int64(), "doc_id": pa.int64(), "payload": pa.binary()}
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values(), strict=True)], names=list(kinds))

        for b in batches:
            rows = []
            for r in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if held is not None and held[:4] == r[:4]:
                    held = (*held[:5], held[5] + r[5], held[6])
                    continue
                if held is not None:
                    rows.append(held)
                held = r
            yield laid(rows)
        if held is not None:
            yield laid([held])

    key = F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 1)  # 63 bits, so in the order of the numbers
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).select(key.alias("key"), "doc_id", "text")
    tokens = rows.mapInArrow(lean(tokenise), "key long, doc_id long, digest binary, n long, copies long, payload binary")
    bucket = F.shiftright(F.shiftright("key", 32) * F.lit(buckets), 31).cast("int")
    dealt = tokens.withColumn("bucket", bucket).repartitionById(buckets, F.col("bucket")).sortWithinPartitions("bucket", "key", "doc_id", "digest")
    placed = dealt.select("bucket", "key", "doc_id", "digest", "n", "copies", "payload").mapInArrow(
        lean(place), "bucket int, start long, n long, copies long, doc_id long, payload binary")
    return materialize(placed, "op6-documents")


def with_global_start(table: DataFrame) -> tuple[DataFrame, int]:
    """``table`` with ``start`` among all tokens, a row for every ``COPIES`` copies, and the number of tokens.

    One number for each bucket is summed up; buckets are as many as shuffle partitions.
    """
    sizes = table.groupBy("bucket").agg(F.sum(F.col("n") * F.col("copies")).alias("size"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = materialize(sizes.select("bucket", "size", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base")), "op6-bases")
    total = base.agg(F.sum("size")).first()[0] or 0
    own = table.join(F.broadcast(base.select("bucket", "base")), "bucket").withColumn("start", F.col("base") + F.col("start"))
    own = own.select("start", "n", "copies", "doc_id", "payload")
    runs = own.where("copies > 1").withColumn("first", F.explode(F.expr(f"sequence(0L, copies - 1, {COPIES}L)")))
    runs = runs.select((F.col("start") + F.col("first") * F.col("n")).alias("start"), "n",
                       F.least(F.col("copies") - F.col("first"), F.lit(COPIES)).alias("copies"), "doc_id", "payload")
    runs = runs.repartition("start").withColumn("copy", F.explode(F.expr("sequence(0L, copies - 1)")))
    each = runs.select((F.col("start") + F.col("copy") * F.col("n")).alias("start"), "doc_id", "payload")
    return own.where("copies = 1").select("start", "doc_id", "payload").union(each), int(total)


def _shifted(crc: int, zeros: bytes, of_zeros: np.ndarray) -> int:
    """What a checksum of leading bytes adds to that of the whole; ``zeros`` are as long as what follows them."""
    return zlib.crc32(zeros, crc) ^ int(of_zeros[len(zeros)])


def fragments(rows: DataFrame, code: Payload, total: int, length: int = LENGTH, key: int = KEY, with_payload: bool = True) -> DataFrame:
    """(slot, at, n, crc_part, doc_id, padding[, payload]): the parts of every sequence.

    Sequence ``s`` holds the tokens from ``s * length`` on and gets slot ``Feistel(s)``; a part has ``n`` ids
    at ``at`` of one document, or the padding of the last sequence.  The checksum of a record is the
    exclusive or of its parts' ``crc_part``.
    """
    spark, zeros = rows.sparkSession, bytes(2 * length)
    of_zeros = np.array([zlib.crc32(zeros[:n]) for n in range(2 * length + 1)], np.int64)
    shared = spark.sparkContext.broadcast((code, Feistel(-(-total // length), key)))
    names = ["slot", "at", "n", "crc_part", "doc_id", "padding"] + ["payload"] * with_payload
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.bool_()] + [pa.binary()] * with_payload

    def part(at: int, ids: np.ndarray) -> tuple:
        after = 2 * (length - at - len(ids))
        return at, len(ids), _shifted(zlib.crc32(ids), zeros[:after], of_zeros)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, order = shared.value

        def out() -> pa.RecordBatch:
            columns = list(zip(*found, strict=True)) or [[]] * (len(names))
            columns[0] = order.forward(np.array(columns[0], np.int64))
            batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)
            found.clear()
            return batch

        found: list[tuple] = []
        for b in batches:
            for start, doc_id, packed in zip(*(c.to_pylist() for c in b.columns), strict=True):
                ids, done = own.unpack(packed), 0
                while done < len(ids):
                    s, at = divmod(start + done, length)
                    piece = ids[done:done + length - at]
                    done += len(piece)
                    # a document that lies in one sequence goes on as it came
                    found.append((s, *part(at, piece), doc_id, False, *([packed if len(piece) == len(ids) else own.pack(piece)] if with_payload else [])))
                    if len(found) >= 4_000:
                        yield out()
        if found:
            yield out()

    schema = "slot long, at int, n int, crc_part long, doc_id long, padding boolean" + ", payload binary" * with_payload
    parts = rows.select("start", "doc_id", "payload").mapInArrow(lean(cut), schema)
    if total % length:
        ids = np.full(length - total % length, PAD, "<u2")
        last = int(Feistel(-(-total // length), key).forward(np.array([total // length]))[0])
        parts = parts.union(spark.createDataFrame([(last, *part(total % length, ids), None, True, *([code.pack(ids)] * with_payload))], schema))
    return parts


def write_shards(parts: DataFrame, path: str, code: Payload, total: int, length: int = LENGTH, per_shard: int = SHARD,
                 shards: DataFrame | None = None) -> None:
    """Write the sequences, in slot order, to ``path/shard=N/``: one file of fixed-stride records each.

    ``parts`` are the :func:`fragments` of ``total`` sequences.  A task gets a range of shards and sorts
    by slot and place.  Spark's committer moves a shard's file to its place when its task is
    done, so a lost executor leaves no half shard; slot ``s`` is record ``s % per_shard`` of shard
    ``s // per_shard``.  With ``shards(shard)``, just these are written, in place of what is there of them.
    """
    shared = parts.sparkSession.sparkContext.broadcast(code)

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, slot, held, size = [], None, [], 0
        done: list[bytes] = []

        def out() -> pa.RecordBatch:
            data = b"".join(done)
            bounds = np.arange(len(done) + 1, dtype=np.int32) * (stride(length) - 1)
            value = pa.StringArray.from_buffers(len(done), pa.py_buffer(bounds.tobytes()), pa.py_buffer(data))
            batch = pa.RecordBatch.from_arrays([pa.array(shard, pa.int64()), value], names=["shard", "value"])
            shard.clear()
            done.clear()
            return batch

        for b in batches:
            for own, s, at, packed in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if (s != slot and size) or at != size:
                    raise ValueError(f"slot {slot if s != slot and size else s} has a gap at {size}")
                ids = shared.value.unpack(packed)
                slot, size = s, size + len(ids)
                held.append(ids.tobytes())
                if size == length:
                    # the text sink ends each value with a line break, the mark's second byte
                    done.append(b"".join(held) + MARK[:1])
                    shard.append(own)
                    held, size = [], 0
                    if len(done) >= 1_000:
                        yield out()
        if size:
            raise ValueError(f"slot {slot} ends at {size}")
        if done:
            yield out()

    n_shards = max(1, -(-total // per_shard))
    tasks = min(n_shards, 100_000)
    rows = parts.select((F.col("slot") / per_shard).cast("long").alias("shard"), "slot", "at", "payload")
    if shards is not None:
        rows = rows.join(shards.select("shard").distinct(), "shard", "left_semi")
    task = (F.col("shard") * F.lit(tasks) / F.lit(n_shards)).cast("int")
    ranged = rows.repartitionById(tasks, task).sortWithinPartitions("shard", "slot", "at").select("shard", "slot", "at", "payload")
    with shuffle_files_dropped(parts.sparkSession):
        (ranged.mapInArrow(lean(records), "shard long, value string").sortWithinPartitions("shard")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("shard").text(path, lineSep=MARK[1:].decode()))


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").schema(
        "path string, modificationTime timestamp, length long, content binary, shard long").load(path)


def read_shards(spark: SparkSession, path: str, length: int = LENGTH, per_shard: int = SHARD, with_ids: bool = True,
                first_slot: int = 0) -> DataFrame:
    """(slot, shard, byte_offset, record_crc32[, ids]) of the records from ``first_slot`` on; the checksum is of its bytes without the mark.

    Shards before that slot's are not read, and in its shard reading starts at its record's offset.
    """
    step, names = stride(length), ["slot", "shard", "byte_offset", "record_crc32"] + ["ids"] * with_ids

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for shard, data in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                data = memoryview(data.as_buffer())
                if len(data) % step:
                    raise ValueError(f"shard {shard}: {len(data)} bytes are not a whole number of records")
                rows = np.frombuffer(data, "<u2").reshape(-1, step // 2)
                for a in range(max(0, first_slot - shard * per_shard), len(rows), 1_000):
                    some = np.arange(a, min(a + 1_000, len(rows)))
                    ids = np.ascontiguousarray(rows[some, :length])
                    columns = [pa.array(shard * per_shard + some), pa.array(np.full(len(some), shard, np.int64)), pa.array(some * step),
                               pa.array([zlib.crc32(r.tobytes()) for r in ids], pa.int64())]
                    if with_ids:
                        bounds = pa.array(np.arange(0, ids.size + 1, length, dtype=np.int32))
                        columns.append(pa.ListArray.from_arrays(bounds, pa.array(ids.astype(np.int32).reshape(-1))))
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    files = _files(spark, path).where(F.col("shard") >= first_slot // per_shard)
    return files.select("shard", "content").mapInArrow(
        lean(split), "slot long, shard long, byte_offset long, record_crc32 long" + ", ids array<int>" * with_ids)


def missing_shards(spark: SparkSession, path: str, total: int, length: int = LENGTH, per_shard: int = SHARD) -> DataFrame:
    """(shard): those of ``total`` sequences that are not there whole; a resumed run writes only these."""
    want = spark.range(max(0, -(-total // per_shard))).select(
        F.col("id").alias("shard"), (F.least(F.lit(per_shard), F.lit(total) - F.col("id") * per_shard) * stride(length)).alias("want"))
    fs = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not fs.getFileSystem(spark._jsc.hadoopConfiguration()).exists(fs):
        return want.select("shard")
    there = _files(spark, path).groupBy("shard").agg(F.sum("length").alias("there"))
    return want.join(there, "shard", "left").where(~F.col("there").eqNullSafe(F.col("want"))).select("shard")


def materialise(docs: DataFrame, path: str, paths: tuple[str, str | None] | None = None, length: int = LENGTH,
                per_shard: int = SHARD, key: int = KEY, resume: bool = False) -> tuple[DataFrame, int]:
    """Write ``docs`` as shards of permuted sequences under ``path``; the index (slot, n_tokens, record_crc32, doc_ids) and the number of sequences.

    Documents are laid end to end in the order of a hash of their id and text and cut every ``length`` ids,
    so what a slot holds follows from the documents and ``key`` alone, not from how the input is
    split or the cluster shaped: a repeated run gives the same bytes, and with ``resume`` only the
    shards that are missing or not whole are written.

    Defined results: null and empty texts are the one token that ends a document; repeated rows are
    written once for each time they stand there; null ids stay null in ``doc_ids``; an empty table writes
    no shard; ids that don't fit 16 bits are an error; other columns are ignored.
    """
    spark, paths = docs.sparkSession, paths or default_paths()
    code = payload_code(docs, paths)
    rows, tokens = with_global_start(ordered_documents(docs, paths, code))
    total = -(-tokens // length)
    if total:
        shards = materialize(missing_shards(spark, path, total, length, per_shard), "op6-missing") if resume else None
        write_shards(fragments(rows, code, tokens, length, key), path, code, total, length, per_shard, shards)
    parts = fragments(rows, code, tokens, length, key, with_payload=False) if total else fragments(rows.limit(0), code, 0, length, key, False)
    kept = F.when(~F.col("padding"), F.struct("at", "doc_id"))
    index = parts.groupBy("slot").agg(F.sum(F.when(F.col("padding"), 0).otherwise(F.col("n"))).cast("int").alias("n_tokens"),
                                      F.bit_xor("crc_part").alias("record_crc32"), F.array_sort(F.collect_list(kept)).alias("parts"))
    return index.select("slot", "n_tokens", "record_crc32", F.col("parts.doc_id").alias("doc_ids")), total


def op6_training_order(docs: DataFrame) -> DataFrame:
    """One row per record, as read back from the shards.

    (slot, shard, byte_offset, record_crc32, n_tokens, doc_ids): ``n_tokens`` without
    padding, ``doc_ids`` the documents that the record holds tokens of.  A record
    whose bytes differ from what was written is an error.
    """
    spark = docs.sparkSession
    path = scratch_dir(spark, "op6-shards")
    index, total = materialise(docs, path)
    fields = "slot long, shard long, byte_offset long, record_crc32 long, n_tokens long, doc_ids array<long>"
    if total == 0:
        return spark.createDataFrame([], fields)
    back = read_shards(spark, path, with_ids=False).join(index.withColumnRenamed("record_crc32", "_written"), "slot", "full")
    whole = F.col("record_crc32").eqNullSafe(F.col("_written"))
    checked = F.when(whole, F.col("record_crc32")).otherwise(F.raise_error(F.concat(F.lit("record differs: slot "), F.col("slot").cast("string"))).cast("long"))
    return back.select("slot", "shard", "byte_offset", checked.alias("record_crc32"), F.col("n_tokens").cast("long").alias("n_tokens"), "doc_ids")
