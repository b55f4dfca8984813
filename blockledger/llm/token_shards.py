"""Training-order materialisation of token sequences as fixed-stride shards.

1. Pack: every text is tokenised once; each input partition packs its texts,
   each followed by an end mark, into one stream, cut into sequences of
   ``length`` tokens, which are saved.  The prefix sums of the partitions'
   numbers of sequences number all sequences 0 .. N-1.
2. Order: a keyed Feistel permutation of the smallest even power of two that
   holds N, walked along its cycle until it lands below N, gives each sequence
   its global slot.  No shuffle or sort decides the order, and any slot can be
   traced back with the key alone.
3. Materialise: each sequence goes to the shard of its slot; one file is written
   for each shard, sorted, every record ``stride`` bytes long, so slot s is at
   byte ``(s % per_shard) * stride`` of shard ``s // per_shard``: readers go on
   from any slot with one seek.

A record is a little-endian uint32 number of tokens (less than ``length`` only
in the last sequence of a partition), ``length`` little-endian uint16 ids
(unused ones hold the end mark) and a newline, which the text writer adds.

Cases: a null text adds nothing, an empty one only its end mark; an empty table
gives no shard and no row; ids, repeated rows, ties and other columns do not
matter.  The numbering follows the input partitions: the same files and split
settings give the same order again.
"""

from __future__ import annotations

import base64
import heapq
import re

import numpy as np
import pyarrow as pa
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockledger.llm.common import saved
from blockledger.session import fresh_path

LENGTH = 2048
PER_SHARD = 2048  # sequences; 8 MB of ids
KEY = 20240229
ROUNDS = 6
LONG_SPACE = 5_000  # characters of white space that are merged apart

#: What the pattern calls white space.
_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_LONG_SPACE = re.compile(f"[{_SPACE}]{{{LONG_SPACE},}}")


# ------------------------------------------------------------------ the order

def _round(x: np.ndarray, key: int) -> np.ndarray:
    x = (x + np.uint64(key & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _feistel(x: np.ndarray, half: int, key: int, back: bool) -> np.ndarray:
    mask = np.uint64((1 << half) - 1)
    left, right = x >> np.uint64(half), x & mask
    for r in reversed(range(ROUNDS)) if back else range(ROUNDS):
        k = key * 1_000_003 + r * 0x632BE59BD9B4E019
        if back:
            left, right = right ^ (_round(left, k) & mask), left
        else:
            left, right = right, left ^ (_round(right, k) & mask)
    return (left << np.uint64(half)) | right


def slots(numbers: np.ndarray, total: int, key: int = KEY, back: bool = False) -> np.ndarray:
    """The slot of each sequence number below ``total``; with ``back`` the number of each slot."""
    half = max(1, -(-(max(1, total - 1)).bit_length() // 2))
    x = np.asarray(numbers, np.uint64)
    out, todo = x.copy(), np.arange(len(x))
    while len(todo):
        out[todo] = _feistel(out[todo], half, key, back)
        todo = todo[out[todo] >= total]
    return out.astype(np.int64)


# ------------------------------------------------------------------ tokenising

class Encoder:
    """Ids of whole texts as the tokenizer gives them.

    The tokenizer's pattern cannot match very long white space, so such runs are
    cut out by the pattern's own rule -- a run is one chunk, without its last
    character where a text goes on -- and merged here.
    """

    def __init__(self, ranks_file: str, pattern: str):
        with open(ranks_file, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.plain = tiktoken.Encoding("shards", pat_str=pattern, mergeable_ranks=self.ranks, special_tokens={})
        self.end = len(self.ranks)
        if self.end > 0xFFFF or max(self.ranks.values(), default=0) >= self.end:
            raise ValueError("ids and the end mark must fit 16 bits")

    def ids(self, text: str) -> bytes:
        out, at = [], 0
        for run in _LONG_SPACE.finditer(text):
            end = run.end() if run.end() == len(text) else run.end() - 1
            out += self.plain.encode_ordinary(text[at:run.start()])
            out += self.merged(text[run.start():end].encode())
            at = end
        out += self.plain.encode_ordinary(text[at:] if at else text)
        return np.array(out, "<u2").tobytes()

    def merged(self, chunk: bytes) -> list[int]:
        """One chunk's ids: the pair of lowest rank is merged first, the first of equal ones, as often as any has one."""
        ranks, n = self.ranks, len(chunk)
        end = list(range(1, n + 1))  # of the part that begins here
        before = list(range(-1, n - 1))
        heap = []

        def offer(i: int) -> None:
            j = end[i] if i >= 0 else n
            if j < n and (r := ranks.get(chunk[i:end[j]])) is not None:
                heap.append((r, i, end[j])) if filling else heapq.heappush(heap, (r, i, end[j]))

        filling = True
        for i in range(n - 1):
            offer(i)
        filling = False
        heapq.heapify(heap)
        alive = bytearray(b"\1") * n
        while heap:
            _, i, to = heapq.heappop(heap)
            j = end[i]
            if not alive[i] or j >= n or end[j] != to:
                continue  # one of the two parts has changed since
            alive[j] = 0
            end[i] = to
            if to < n:
                before[to] = i
            offer(i)
            offer(before[i])
        out, i = [], 0
        while i < n:
            out.append(ranks[chunk[i:end[i]]])
            i = end[i]
        return out


def _streams(batches, encoder: Encoder):
    """Bytes of ids of each text with its end mark."""
    end = np.array([encoder.end], "<u2").tobytes()
    for b in batches:
        for t in b.column("text"):
            if t.is_valid:
                yield encoder.ids(t.as_py())
                yield end


def _packed(batches, encoder: Encoder, length: int):
    """Sequences of ids, the last one possibly shorter."""
    size, held, have = 2 * length, [], 0
    for x in _streams(batches, encoder):
        held.append(x)
        have += len(x)
        if have >= size:
            x = b"".join(held)
            for lo in range(0, have - size + 1, size):
                yield x[lo:lo + size]
            held, have = [x[have - have % size:]], have % size
    if have:
        yield b"".join(held)


# -------------------------------------------------------------------- operator

def write_shards(docs: DataFrame, path: str, ranks_file: str, pattern: str, length: int = LENGTH,
                 per_shard: int = PER_SHARD, key: int = KEY) -> int:
    """Write the shards under ``path`` (``shard=<n>/``); the number of sequences."""
    end = Encoder(ranks_file, pattern).end

    def pack(batches):
        p, done, held = TaskContext.get().partitionId(), 0, []
        for x in _packed(batches, Encoder(ranks_file, pattern), length):
            held.append(x)
            if len(held) == 256:
                yield rows(p, done, held)
                done, held = done + 256, []
        if held:
            yield rows(p, done, held)

    def rows(p, done, held):
        return pa.RecordBatch.from_arrays(
            [pa.array([p] * len(held), pa.int32()), pa.array(range(done, done + len(held)), pa.int64()),
             pa.array(held, pa.binary())], ["p", "i", "ids"])

    packed = saved(docs.select(F.col("text").alias("text")).mapInArrow(pack, "p int, i long, ids binary"),
                   "packed", compression="zstd")
    counted = packed.groupBy("p").agg(F.count("*").alias("n")).orderBy("p").collect()  # one row a partition
    if not counted:
        return 0
    parts = np.array([r.p for r in counted])
    ends = np.cumsum([r.n for r in counted])
    first, total = ends - [r.n for r in counted], int(ends[-1])

    def place(batches):
        squeeze, pad = zstandard.ZstdCompressor(level=3), np.array([end], "<u2").tobytes()
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                s = b.slice(lo, 256)
                number = first[np.searchsorted(parts, s.column("p").to_numpy())] + s.column("i").to_numpy()
                slot, z = slots(number, total, key), []
                for x in s.column("ids").to_pylist():
                    n = len(x) // 2
                    z.append(squeeze.compress(np.array([n], "<u4").tobytes() + x + pad * (length - n)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(slot // per_shard), pa.array(slot), pa.array(z, pa.binary())], ["shard", "slot", "z"])

    def plain(batches):
        grow = zstandard.ZstdDecompressor()
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                s = b.slice(lo, 256)
                yield pa.RecordBatch.from_arrays(
                    [s.column("shard"), pa.array([grow.decompress(z.as_py()) for z in s.column("z")], pa.binary())],
                    ["shard", "record"])

    (packed.mapInArrow(place, "shard long, slot long, z binary")
     .repartitionById(-(-total // per_shard), F.col("shard").cast("int")).sortWithinPartitions("shard", "slot")
     .mapInArrow(plain, "shard long, record binary")
     .select("shard", F.col("record").cast("string").alias("value"))
     .write.partitionBy("shard").option("compression", "none").text(path))
    return total


def read_shards(spark, path: str, length: int = LENGTH, per_shard: int = PER_SHARD) -> DataFrame:
    """(slot, shard, byte_offset, n_tokens, record) of every record under ``path``."""
    stride = 4 + 2 * length + 1
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
             .select(F.regexp_extract("path", r"shard=(\d+)/", 1).cast("long").alias("shard"), "content",
                     (F.col("length") / stride).cast("int").alias("n")).filter("n > 0"))
    rows = files.select("shard", "content", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("i"))
    rows = rows.select("shard", "i", F.substring("content", F.col("i") * stride + 1, F.lit(stride - 1)).alias("record"))
    n = sum((F.conv(F.hex(F.substring("record", k + 1, 1)), 16, 10).cast("long") * 256 ** k for k in range(4)), F.lit(0))
    return rows.select((F.col("shard") * per_shard + F.col("i")).alias("slot"), "shard",
                       (F.col("i").cast("long") * stride).alias("byte_offset"), n.alias("n_tokens"), "record")


def materialise(docs: DataFrame, ranks_file: str, pattern: str, length: int = LENGTH, per_shard: int = PER_SHARD,
                key: int = KEY) -> DataFrame:
    """Write the shards under the shared folder; (slot, shard, path, byte_offset, n_tokens, sha256) of each sequence."""
    spark = docs.sparkSession
    path = fresh_path(spark, "llm/shards")
    if not write_shards(docs, path, ranks_file, pattern, length, per_shard, key):
        return spark.createDataFrame([], "slot long, shard long, path string, byte_offset long, n_tokens long, sha256 string")
    return read_shards(spark, path, length, per_shard).select(
        "slot", "shard", F.concat(F.lit(f"{path}/shard="), F.col("shard")).alias("path"), "byte_offset", "n_tokens",
        F.sha2("record", 256).alias("sha256"))
