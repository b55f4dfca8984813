"""N-gram Jaccard join by vertical partitioning.

A text's set is its distinct word shingles, hashed to 64 bits; the *global
order* of n-grams is the order of those hashes.  The order is cut into
fragments, the same cuts for every text of a size class, so each set falls
into segments that are handled apart:

1. *Candidates.*  A pair at or above the threshold differs in at most ``d``
   shingles (``d`` follows from the sizes).  With more than ``d`` fragments one
   fragment must be untouched, so the pair agrees on that whole segment.  Every
   segment becomes one 64-bit signature; equal signatures meet in one bucket.
   Signatures are combined within each batch before the shuffle, so a bucket
   that holds a third of the corpus arrives as one row per batch.  Buckets of many
   signatures are formed in slices of the signatures, one after another, so that only a
   slice of them is on disk a second time.
2. *Star.*  Each bucket pairs its members with one leader: linear output.  Small
   buckets pair all their members.
3. *Partial overlaps.*  Candidate pairs that pass a parity sketch (a bit vector
   that can only under-state the difference, so it drops no link) are counted
   exactly: per pair and fragment the overlap of the two segments, then the sum
   per pair.
4. *Rest.*  Links not through a leader can only join members of one large bucket
   that are still in different components.  Sets that chains of such buckets join make
   a family, in which each set is one row.  Families are compared in blocks:
   pairs that the sketches admit are counted on the whole sets at once, and a
   block gives a spanning forest of its links; first inside the blocks, then
   between those whose components still differ.  So every link is either found or
   already implied by a path of found links, and no list of likely pairs is made.

Cases: a null or blank text has an empty set (size 0, linked with nothing); a
text with fewer words than a shingle is one shingle; repeated rows and copies
share one set and one component; a null id is returned as it is and takes part
through its text, the component's name being the smallest non-null id (null if
there is none).  Other columns are ignored.  Sets are named by a 64-bit hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from blockledger.llm.common import discard, saved
from blockledger.llm.graph import components

SHINGLE = 3
THRESHOLD = 90  # per cent
ROWS_AT_ONCE = 1024  # texts held as sets at a time
SEGMENT = 128  # shingles in a segment of the exact count, about
SKETCH = 8  # bits for each shingle that linked sets may differ by
FEW = 16  # members of a bucket that are all paired at once
BLOCK = 8192  # members of a family in a block, about
BLOCK_SHINGLES = 2_000_000  # shingles in a block, about: 16 MB; blocks of a family are compared two by two
TILE = 32_768  # pairs of a block compared at once
SLICE_BITS = 3  # the high bits of a signature that name its slice
ONE_PASS = 4_000_000  # signatures whose buckets are formed at once, in one pass over all slices
CLASS_BITS = 127  # the low bits of a signature hold its size class
WORD_CACHE = 100_000

SLICES = [f"sigs{p}" for p in range(1 << SLICE_BITS)]
PROFILE = (f"doc_id long, n long, h long, tk long, {', '.join(f'{s} array<long>' for s in SLICES)}, "
           "near array<struct<sig:long,lead:long>>, sketch binary")


# ------------------------------------------------------------------ hashing

def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser, element by element."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHash(dict):
    """Word to 64-bit hash, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def shingle_set(text: bytes | None, words: WordHash, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct shingle hashes; A-Z are lower-cased, other letters kept."""
    w = (text or b"").lower().split()
    if not w:
        return np.empty(0, np.uint64)
    a = np.fromiter(map(words.__getitem__, w), np.uint64, len(w))
    m = min(size, len(a))
    h = np.full(len(a) - m + 1, m, np.uint64)
    for j in range(m):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + a[j:len(a) - m + 1 + j])
    return np.unique(h)


# ------------------------------------------------- size classes and fragments

class Cuts:
    """Size classes, and the fragment cuts of each, for one threshold."""

    def __init__(self, per_cent: int):
        self.p = per_cent
        self.known: dict[int, tuple[np.ndarray, np.ndarray, int]] = {}

    def most_diff(self, a, b):
        """Largest symmetric difference of linked sets of sizes a and b."""
        return (a + b) * (100 - self.p) // (100 + self.p)

    def top(self, c: int) -> int:
        """Largest size in class c; classes grow by a quarter power of two."""
        return int(2 ** ((c + 1) / 4))

    def class_of(self, n: int) -> int:
        c = max(0, int(4 * np.log2(n)) - 2)
        while self.top(c) < n:
            c += 1
        return c

    def classes(self, n: int) -> list[int]:
        """Classes of the larger set of any pair that this size can be in."""
        return list(range(self.class_of(n), self.class_of(n * 100 // self.p) + 1))

    def cut(self, c: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Lower ends of the fragments, a salt for each, and the empty ones allowed for."""
        if c not in self.known:
            d = int(self.most_diff(self.top(c), self.top(c)))
            spare = self.spare(c, d)
            k = d + 1 + spare
            ends = np.array([(q << 64) // k for q in range(k)], np.uint64)
            self.known[c] = ends, mix(np.arange(k, dtype=np.uint64) + np.uint64((c + 1) << 40)), spare
        return self.known[c]

    def spare(self, c: int, d: int) -> int:
        """Empty fragments to allow for: hardly any set of the class has more, where that can be had.

        Empty fragments are alike in all texts, so sets that sign them meet in
        buckets that grow with the table.
        """
        least = max(1, self.top(c - 1) * self.p // 100)
        for spare in range(1, 2 + d // 2):
            k = d + 1 + spare
            void = np.exp(-least / k)
            if k * void + 4 * np.sqrt(k * void * (1 - (1 + least / k) * void)) <= spare:
                return spare
        return 1 + d // 64

    def signatures(self, h: np.ndarray) -> np.ndarray:
        out = []
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(h + np.uint64(0x632BE59BD9B4E019)), dtype=np.uint64)])
        for c in self.classes(len(h)):
            if not self.most_diff(self.top(c), self.top(c)):
                continue  # only equal sets can be linked
            ends, salt, spare = self.cut(c)
            at = np.append(np.searchsorted(h, ends), len(h))
            sig = mix((sums[at[1:]] - sums[at[:-1]]) ^ salt) & ~np.uint64(CLASS_BITS) | np.uint64(c)
            full = at[1:] > at[:-1]
            # A pair leaves spare + 1 fragments untouched; a set with no more empty ones than
            # spare shares a full one, any other set also signs its empty ones.
            out.append(sig if (~full).sum() > spare else sig[full])
        return np.unique(np.concatenate(out)) if out else np.empty(0, np.uint64)

    def sketch(self, h: np.ndarray) -> bytes:
        """One bit for each hash value's low bits, set if an odd number of shingles has it."""
        d = int(self.most_diff(len(h), len(h)))
        bits = 1 << max(6, int(SKETCH * d - 1).bit_length() if d else 6)
        odd = np.bincount((h & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
        return np.packbits(odd.astype(np.uint8)).tobytes()

    def segments(self, h: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        """(class, fragment, shingles) of the exact count."""
        for c in self.classes(len(h)):
            k = self.pieces(c)
            at = np.append(np.searchsorted(h, np.array([(q << 64) // k for q in range(k)], np.uint64)), len(h))
            for q in range(k):
                yield c, q, h[at[q]:at[q + 1]]

    def pieces(self, c: int) -> int:
        return -(-self.top(c) // SEGMENT)


def folded(a: np.ndarray, size: int) -> np.ndarray:
    """A sketch as one of fewer bits."""
    while len(a) > size:
        a = a[:len(a) // 2] ^ a[len(a) // 2:]
    return a


def differing(a: bytes, b: bytes) -> int:
    """A lower bound of the symmetric difference."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    size = min(len(x), len(y))
    return int(np.bitwise_count(folded(x, size) ^ folded(y, size)).sum())


def _i64(a) -> np.ndarray:
    return np.asarray(a, np.uint64).view(np.int64)


def _lists(owner: np.ndarray, values: pa.Array, n: int) -> pa.ListArray:
    at = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(at), values)


# ---------------------------------------------------------------- candidates

def profile(docs: DataFrame, per_cent: int = THRESHOLD, size: int = SHINGLE) -> DataFrame:
    """One row for each text: set size and name, signatures, sketch."""
    def run(batches):
        words, cuts = WordHash(), Cuts(per_cent)
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS_AT_ONCE):
                yield part(batch.slice(lo, ROWS_AT_ONCE), words, cuts)

    def part(b, words, cuts):
        texts, rows = b.column("text"), b.num_rows
        name, count = np.zeros(rows, np.uint64), np.zeros(rows, np.int64)
        sketches, flat, owner, seen = [None] * rows, [], [], set()
        for i in range(rows):
            h = shingle_set(texts[i].as_py(), words, size)
            count[i] = len(h)
            if not len(h):
                continue
            key = xxhash.xxh3_64_intdigest(h.tobytes())
            name[i] = key
            if key in seen:
                continue
            seen.add(key)
            sketches[i] = cuts.sketch(h)
            s = cuts.signatures(h)
            flat.append(s)
            owner.append(np.full(len(s), i))
        flat = np.concatenate(flat) if flat else np.empty(0, np.uint64)
        owner = np.concatenate(owner) if owner else np.empty(0, np.int64)
        _, first, group = np.unique(flat, return_index=True, return_inverse=True)
        lead = owner[first][group] if len(flat) else owner
        own = lead == owner
        near = pa.StructArray.from_arrays(
            [pa.array(_i64(flat[~own])), pa.array(_i64(name[lead[~own]]))], ["sig", "lead"])
        of = [own & (flat >> np.uint64(64 - SLICE_BITS) == p) for p in range(len(SLICES))]
        return pa.RecordBatch.from_arrays([
            b.column("doc_id"), pa.array(count), pa.array(_i64(name), mask=count == 0), b.column("tk"),
            *[_lists(owner[x], pa.array(_i64(flat[x])), rows) for x in of], _lists(owner[~own], near, rows),
            pa.array(sketches, pa.binary())],
            ["doc_id", "n", "h", "tk", *SLICES, "near", "sketch"])

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"),
                      F.xxhash64("text").alias("tk"))
    return src.mapInArrow(run, PROFILE)


def bucket_members(prof: DataFrame) -> DataFrame:
    """(sig, h, lead) of buckets with several sets; leads have no row of their own; saved."""
    w = Window.partitionBy("sig")

    def formed(slices: list[int]) -> DataFrame:
        far = (prof.select("h", F.explode(F.concat(*[SLICES[p] for p in slices])).alias("sig"))
               .select("sig", "h", F.min("h").over(w).alias("lead")).filter("h <> lead"))
        near = (prof.select("h", F.explode("near").alias("x")).select("x.sig", "h", "x.lead")
                .filter(F.shiftrightunsigned("sig", 64 - SLICE_BITS).isin(slices)))
        return saved(far.unionByName(near).distinct(), "join-buckets")

    every = list(range(len(SLICES)))
    n = prof.agg(F.sum(sum(F.size(s) for s in SLICES))).first()[0] or 0
    if n <= ONE_PASS:
        return formed(every)
    parts = [formed([p]) for p in every]
    out = saved(reduce(DataFrame.unionByName, parts), "join-buckets")
    discard(*parts)
    return out


def sketch_filter(pairs: DataFrame, per_cent: int) -> DataFrame:
    """Pairs (u, v, nu, nv, su, sv) whose sketches admit a link, without the sketches."""
    def run(batches):
        cuts = Cuts(per_cent)
        for b in batches:
            a, c = b.column("su"), b.column("sv")
            most = cuts.most_diff(b.column("nu").to_numpy(), b.column("nv").to_numpy())
            keep = [differing(a[i].as_py(), c[i].as_py()) <= most[i] for i in range(b.num_rows)]
            yield b.select(["u", "v", "nu", "nv"]).filter(pa.array(keep, pa.bool_()))
    return pairs.mapInArrow(run, "u long, v long, nu long, nv long")


def similar_size(per_cent: int):
    return F.expr(f"100 * least(nu, nv) >= {per_cent} * greatest(nu, nv)")


def by_bucket(members: DataFrame) -> DataFrame:
    """(sig, h) of every member, leads too."""
    return members.select("sig", "h").unionByName(members.select("sig", F.col("lead").alias("h"))).distinct()


def candidate_pairs(members: DataFrame, sets: DataFrame, per_cent: int) -> DataFrame:
    """Likely pairs: every member with its lead, and all members of buckets of up to ``FEW``."""
    both = by_bucket(members)
    few = both.join(both.groupBy("sig").agg(F.count("*").alias("m")).filter(f"m between 3 and {FEW}"), "sig")
    small = (few.select("sig", F.col("h").alias("u")).join(few.select("sig", F.col("h").alias("v")), "sig")
             .filter("u < v").select("u", "v"))
    a = sets.select(F.col("h").alias("u"), F.col("n").alias("nu"), F.col("sketch").alias("su"))
    b = sets.select(F.col("h").alias("v"), F.col("n").alias("nv"), F.col("sketch").alias("sv"))
    pairs = members.select(F.least("h", "lead").alias("u"), F.greatest("h", "lead").alias("v")).unionByName(small).distinct()
    return sketch_filter(pairs.join(a, "u").join(b, "v").filter(similar_size(per_cent)), per_cent)


def families(members: DataFrame, sets: DataFrame, roots: DataFrame) -> DataFrame:
    """(fam, k, h, root, n, tk, sketch): the sets of a class that chains of open buckets join, in k blocks; saved.

    A bucket of more than ``FEW`` is open while its members are in different components.
    Near copies share most of their buckets; here each of them is one row, not one for each bucket.
    A bucket's members hang on its smallest, and a set's smallest ones on the least of them, so
    the graph of a family has few edges more than sets.
    """
    root = F.coalesce("root", "h")
    open_ = (by_bucket(members).join(roots, "h", "left").groupBy("sig")
             .agg(F.count("*").alias("m"), F.min("h").alias("least"), F.min(root).alias("a"), F.max(root).alias("b"))
             .filter(f"m > {FEW} and a <> b").select("sig", "least"))
    c = F.col("sig").bitwiseAND(F.lit(CLASS_BITS)).alias("c")
    met = saved(members.join(open_, "sig").select(c, F.explode(F.array("h", "lead")).alias("h"), F.col("least").alias("lead"))
                .filter("h <> lead").distinct(), "join-met")
    # A set has at most as many leads as signatures, so no window is long.
    first = F.least("h", F.min("lead").over(Window.partitionBy("c", "h")))
    edges = met.select("c", "h", "lead", first.alias("first"))
    edges = edges.select("c", "h", "first").unionByName(edges.select("c", F.col("lead").alias("h"), "first")).distinct()
    chained = components(edges.select(F.xxhash64("h", "c").alias("u"), F.xxhash64("first", "c").alias("v")))
    nodes = (met.select("c", "h").unionByName(met.select("c", F.col("lead").alias("h"))).distinct()
             .withColumn("node", F.xxhash64("h", "c")).join(chained.withColumnRenamed("root", "fam"), "node", "left")
             .withColumn("fam", F.coalesce("fam", "node")))
    rows = nodes.join(sets, "h").join(roots, "h", "left").withColumn("root", F.coalesce("root", "h"))
    size = (nodes.join(sets.select("h", "n"), "h").groupBy("fam")
            .agg(F.expr(f"int(ceil(greatest(count(*) / {BLOCK}, sum(n) / {BLOCK_SHINGLES})))").alias("k")))
    out = saved(rows.join(size, "fam").select("fam", "k", "h", "root", "n", "tk", "sketch"), "join-open")
    discard(met)
    return out


def whole_sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(h, own_set) of the sets in ``wanted``, from one text each."""
    texts = (docs.select(F.col("text").cast("binary").alias("text"), F.xxhash64("text").alias("tk"))
             .join(wanted.select("tk"), "tk", "left_semi").dropDuplicates(["tk"]).select("text"))

    def run(batches):
        words = WordHash()
        for b in batches:
            for lo in range(0, b.num_rows, 64):
                got = [shingle_set(t.as_py(), words, size).tobytes() for t in b.column("text").slice(lo, 64)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_i64([xxhash.xxh3_64_intdigest(x) for x in got])), pa.array(got, pa.binary())],
                    ["h", "own_set"])
    return texts.mapInArrow(run, "h long, own_set binary")


def block_links(open_: DataFrame, own: DataFrame, roots: DataFrame, per_cent: int, apart: bool) -> DataFrame:
    """Links (u, v) that join components: inside the blocks of each family, or with ``apart`` between them.

    Sets are compared on the sketches first, and likely pairs at once on the whole
    sets; a block gives a spanning forest of its links, so the rows that come out
    follow from the components joined and not from the pairs compared.
    """
    now = open_.drop("root").join(roots, "h", "left").withColumn("root", F.coalesce("root", "h"))
    dealt = now.withColumn("own", F.expr("int(pmod(xxhash64(h), k))"))
    if apart:
        split = (now.filter("k > 1").groupBy("fam").agg(F.min("root").alias("a"), F.max("root").alias("b"))
                 .filter("a <> b").select("fam"))
        dealt = (dealt.filter("k > 1").join(split, "fam", "left_semi")
                 .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1))).filter("own <> other"))
    else:
        dealt = dealt.withColumn("other", F.col("own"))
    dealt = (dealt.join(own, "h")
             .select("fam", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                     "own", "h", "root", "n", "sketch", "own_set"))
    dealt = dealt.repartition("fam", "i", "j").sortWithinPartitions("fam", "i", "j")

    def run(batches):
        cuts, rest = Cuts(per_cent), None
        for b in batches:
            t = pa.Table.from_batches([b])
            t = t if rest is None else pa.concat_tables([rest, t])
            fam, i, j = (t.column(c).to_numpy() for c in ("fam", "i", "j"))
            first = np.flatnonzero((fam[1:] != fam[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
            first = np.concatenate([[0], first])
            for lo, hi in zip(first[:-1].tolist(), first[1:].tolist()):
                if hi - lo > 1:
                    yield found(cuts, t.slice(lo, hi - lo))
            rest = t.slice(int(first[-1]))  # its block may go on in the next batch
        if rest is not None and rest.num_rows > 1:
            yield found(cuts, rest)

    def found(cuts, rows):
        own, h, root, n = (rows.column(c).to_numpy() for c in ("own", "h", "root", "n"))
        out = list(forest(cuts, own, root, n, rows)) if (root != root[0]).any() else []
        return pa.RecordBatch.from_arrays([pa.array(h[[p[k] for p in out]], pa.int64()) for k in (0, 1)], ["u", "v"])

    def forest(cuts, own, root, n, rows):
        """Linked pairs (p, q) of a block that join its components."""
        label = root.copy()
        sketches, sets = rows.column("sketch").to_pylist(), rows.column("own_set").to_pylist()
        size = min(map(len, sketches))
        sk = np.stack([folded(np.frombuffer(x, np.uint8), size) for x in sketches]).view(np.uint64)
        tile = max(1, TILE // len(n))
        for lo in range(0, len(n), tile):
            a, b = slice(lo, lo + tile), slice(lo, None)
            few, many = np.minimum(n[a, None], n[b]), np.maximum(n[a, None], n[b])
            ok = (label[a, None] != label[b]) & (100 * few >= per_cent * many)
            ok &= np.arange(len(few))[:, None] < np.arange(few.shape[1])
            if apart:
                ok &= own[a, None] != own[b]
            x, y = np.nonzero(ok)
            least = np.bitwise_count(sk[lo + x] ^ sk[lo + y]).sum(axis=1, dtype=np.int64)
            near = least <= cuts.most_diff(n[lo + x], n[lo + y])
            for p, q in zip((lo + x[near]).tolist(), (lo + y[near]).tolist()):
                if label[p] == label[q] or differing(sketches[p], sketches[q]) > cuts.most_diff(n[p], n[q]):
                    continue
                both = len(np.intersect1d(np.frombuffer(sets[p], np.uint64), np.frombuffer(sets[q], np.uint64), True))
                if 100 * both >= per_cent * (n[p] + n[q] - both):
                    yield p, q
                    label[label == label[q]] = label[p]

    return dealt.mapInArrow(run, "u long, v long")


# --------------------------------------------------------------- exact count

def links(docs: DataFrame, pairs: DataFrame, sets: DataFrame, per_cent: int = THRESHOLD,
          size: int = SHINGLE) -> DataFrame:
    """The pairs at or above the threshold, by partial overlaps summed over fragments; saved."""
    cuts = Cuts(per_cent)
    ends = pairs.select(F.explode(F.array("u", "v")).alias("h"))
    wanted = saved(sets.join(ends, "h", "left_semi").select("tk", "h"), "join-wanted")
    # One text for each set; the list of texts is broadcast only while Spark's size check allows it.
    texts = (docs.select(F.col("text").cast("binary").alias("text"), F.xxhash64("text").alias("tk"))
             .join(wanted.select("tk"), "tk", "left_semi").dropDuplicates(["tk"]).select("text"))

    def run(batches):
        words, own = WordHash(), Cuts(per_cent)
        for b in batches:
            for lo in range(0, b.num_rows, 64):
                cols = ([], [], [], [])
                for t in b.column("text").slice(lo, 64):
                    h = shingle_set(t.as_py(), words, size)
                    name = np.uint64(xxhash.xxh3_64_intdigest(h.tobytes())).astype(np.int64)
                    for c, q, part in own.segments(h):
                        for col, x in zip(cols, (name, c, q, _i64(part))):
                            col.append(x)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int32()),
                     pa.array(cols[3], pa.list_(pa.int64()))], ["h", "c", "q", "part"])

    seg = saved(texts.mapInArrow(run, "h long, c int, q int, part array<long>"), "join-segments")
    # The class of a pair is that of its larger set: a step function of the size.
    top = F.greatest("nu", "nv")
    c, k = F.lit(0), F.lit(1)
    for i in range(1, CLASS_BITS + 1):
        c, k = F.when(top > cuts.top(i - 1), i).otherwise(c), F.when(top > cuts.top(i - 1), cuts.pieces(i)).otherwise(k)
    dealt = pairs.withColumn("c", c).withColumn("q", F.explode(F.sequence(F.lit(0), k - 1)))
    a = seg.select(F.col("h").alias("u"), "c", "q", F.col("part").alias("pu"))
    b = seg.select(F.col("h").alias("v"), "c", "q", F.col("part").alias("pv"))
    partial = (dealt.join(a, ["u", "c", "q"]).join(b, ["v", "c", "q"])
               .select("u", "v", "nu", "nv", F.size(F.array_intersect("pu", "pv")).cast("long").alias("o")))
    out = saved(partial.groupBy("u", "v", "nu", "nv").agg(F.sum("o").alias("both"))
                .filter(F.expr(f"100 * both >= {per_cent} * (nu + nv - both)")).select("u", "v", "both"), "join-links")
    discard(wanted, seg)
    return out


# ------------------------------------------------------------------- operator

def _roots(edges: DataFrame) -> DataFrame:
    return components(edges).select(F.col("node").alias("h"), "root")


def grouped(docs: DataFrame, per_cent: int = THRESHOLD, size: int = SHINGLE) -> tuple[DataFrame, DataFrame]:
    """The rows' (doc_id, n, h, tk), and (h, least, root) of each set: its smallest id and its component."""
    prof = saved(profile(docs, per_cent, size), "join-profile")
    members = bucket_members(prof)
    ids = members.select("h").unionByName(members.select(F.col("lead").alias("h")))
    sets = saved(prof.filter("sketch is not null").select("h", "n", "tk", "sketch")
                 .join(ids, "h", "left_semi").dropDuplicates(["h"]), "join-sets")
    rows = saved(prof.select("doc_id", "n", "h", "tk"), "join-rows")
    discard(prof)  # the signatures are by far the largest part, and no longer needed
    pairs = saved(candidate_pairs(members, sets, per_cent), "join-pairs")
    edges = (pairs if pairs.isEmpty() else links(docs, pairs, sets, per_cent, size)).select("u", "v")
    roots = _roots(edges)
    open_ = families(members, sets, roots)
    discard(pairs, members, sets)
    if not open_.isEmpty():
        own = saved(whole_sets(docs, open_, size), "join-sets")
        for apart in (False, True):
            found = saved(block_links(open_, own, roots, per_cent, apart), "join-found")
            if not found.isEmpty():
                edges = edges.unionByName(found)
                roots = _roots(edges)
        discard(own)
    discard(open_)
    by_set = rows.filter("h is not null").groupBy("h").agg(F.min("doc_id").alias("least"))
    return rows, by_set.join(roots, "h", "left").withColumn("root", F.coalesce("root", "h"))


def near_duplicate_components(docs: DataFrame, per_cent: int = THRESHOLD, size: int = SHINGLE) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row for each row of ``docs``."""
    rows, by_set = grouped(docs, per_cent, size)
    by_root = by_set.groupBy("root").agg(F.min("least").alias("component_id"))
    named = by_set.join(by_root, "root").select("h", "component_id")
    return (rows.join(named, "h", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("h").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")))


def one_of_each(docs: DataFrame, per_cent: int = THRESHOLD, size: int = SHINGLE) -> DataFrame:
    """One row of each component: the first by id (none comes last), then by the hash of its text.

    Rows with an empty set are linked with nothing and stay; rows that are equal
    in id and text are one.
    """
    rows, by_set = grouped(docs, per_cent, size)
    placed = rows.join(by_set.select("h", "root"), "h", "left").select("doc_id", "tk", "h", "root").distinct()
    first = (placed.filter("h is not null").groupBy("root")
             .agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "tk")).alias("x")).select("x.doc_id", "x.tk"))
    chosen = saved(first.unionByName(placed.filter("h is null").select("doc_id", "tk")), "join-chosen")
    # A missing id is a value like any other here.
    key = [F.coalesce(F.col("doc_id").cast("long"), F.lit(0)), F.col("doc_id").isNull()]
    kept = (docs.withColumns({"_id": key[0], "_no": key[1], "_tk": F.xxhash64(docs["text"])})
            .join(chosen.select(key[0].alias("_id"), key[1].alias("_no"), F.col("tk").alias("_tk")), ["_id", "_no", "_tk"], "left_semi")
            .dropDuplicates(["_id", "_no", "_tk"]))
    return kept.select(*docs.columns)
