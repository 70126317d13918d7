"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints within 3 bits of each other have, in one of four 16-bit blocks, at least as many of the differing bits as in
any other; without that block, at most 2 bits differ. So each distinct fingerprint emits, for each block left out, the other
48 bits and all their variants within half of that radius (1 bit): 4 x 49 rows, in proportion to the input. Linked
fingerprints meet in a variant. Colliding fingerprints are verified on all 64 bits where they meet, and each bucket passes
on a spanning forest of its links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, documents, keyed_texts
from .components import components
from .near_copies import keep_one  # noqa: F401

RADIUS = 3
SEED = 42
SHINGLE = 3
#: Buckets up to this size compare their members directly, larger ones walk masks over a table; both are exact.
DIRECT = 64
#: Bytes of variants that one task emits or verifies, about.
BALL_BYTES = 32_000_000
_BLOCKS = [np.uint64(0xFFFF << 16 * b) for b in range(4)]
_ONE = np.uint64(1)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of one text: A-Z lower-cased, words joined in shingles, a bit set if over half the hashes have it."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line, ends = b" ".join(words), np.cumsum([len(w) + 1 for w in words]).tolist()
    starts = [0, *ends[:-1]]
    last = max(1, len(words) - shingle + 1)
    counts, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for lo in range(0, last, 1 << 15):
        hi = min(last, lo + (1 << 15))
        stop = ends[min(lo + shingle, len(words)) - 1 :]
        h = np.array([digest(line[s : e - 1], SEED) for s, e in zip(starts[lo:hi], stop, strict=False)], dtype="<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * counts > last, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp bigint): one row a document; null and wordless texts have fingerprint 0."""
    texts = keyed_texts(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([fingerprint(x.as_py(), shingle) for x in batch.column(1)], pa.int64())], names=["doc_id", "fp"])

    return texts.mapInArrow(run, f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, fp bigint")


def _emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        every = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        for lo in range(0, len(every), 1024):
            fps = every[lo : lo + 1024]
            keys = []
            for b, block in enumerate(_BLOCKS):
                # the block left out holds its own number, so that keys of other blocks are others
                rest = fps & ~block | np.uint64((b + 1) << 16 * b)
                flips = [np.uint64(0), *(_ONE << np.uint64(i) for i in range(64) if i // 16 != b)]
                keys += [rest ^ x for x in flips]
            n = len(keys)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.tile(fps, n).view(np.int64))], names=["key", "fp"])


def _forest(n: int, a: np.ndarray, b: np.ndarray, root: np.ndarray | None = None) -> np.ndarray:
    """Least member of each node's component, for links a-b between nodes 0..n-1."""
    root = np.arange(n) if root is None else root
    while len(a):
        ra, rb = root[a], root[b]
        apart = ra != rb
        if not apart.any():
            break
        a, b, low = a[apart], b[apart], np.minimum(ra, rb)[apart]
        np.minimum.at(root, ra[apart], low)
        np.minimum.at(root, rb[apart], low)
        while (root[root] != root).any():
            root = root[root]
    return root


def _large(key: int, fps: np.ndarray) -> np.ndarray:
    """Roots within one bucket of any size, in time linear in it.

    A member is the place of its one bit that differs from the key (48 places, or none) and the 16 bits left out, so a
    bucket has at most 49 x 65,536 members, and a table over both finds the partners of all members mask by mask.
    """
    root, by_weight = np.arange(len(fps)), sorted(range(1 << 16), key=int.bit_count)[: 1 + 16 + 120 + 560]
    for b in range(4):
        away = (fps ^ np.uint64(key)) & ~_BLOCKS[b]
        me = np.flatnonzero(np.bitwise_count(away) <= 1)
        if key >> 16 * b & 0xFFFF != b + 1 or not len(me):
            continue
        away = away[me]
        place = np.where(away == 0, 0, np.log2(np.maximum(away, 1).astype(np.float64)).astype(np.int64) + 1)
        left = ((fps[me] >> np.uint64(16 * b)) & np.uint64(0xFFFF)).astype(np.int64)
        table = np.full((65, 1 << 16), -1, np.int32)
        table[place, left] = me
        head = np.full(1 << 16, -1, np.int32)  # a member of each column that is a bit away from the key
        off = place > 0
        head[left[off]] = me[off]
        for mask in by_weight:
            w, at = mask.bit_count(), left ^ mask
            to = [table[place, at]]  # same place: w bits apart
            if w <= 2:
                to.append(table[0][at])  # the key itself: one more
            if w <= 1:
                to.append(np.where(off, head[at], -1))  # another place: two more
            for t in to:
                root = _forest(len(fps), me[t >= 0], t[t >= 0], root)
    return root


def _links(keys: np.ndarray, fps: np.ndarray) -> np.ndarray:
    """Rows of (member, root) of the verified links of whole buckets, keys sorted."""
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]]))
    sizes = np.diff(new)
    a, b = [], []
    for i in np.flatnonzero(sizes > DIRECT):
        lo, hi = new[i], new[i + 1]
        f = np.unique(fps[lo:hi])
        root = _large(int(keys[lo].view(np.uint64)), f) if len(f) > DIRECT else _forest(len(f), *np.nonzero(np.bitwise_count(f[:, None] ^ f[None, :]) <= RADIUS))
        a.append(f)
        b.append(f[root])
    small = np.repeat(sizes <= DIRECT, sizes) & np.repeat(sizes > 1, sizes)
    k, f = keys[small], fps[small]
    u, v = [], []
    for d in range(1, int(sizes[(sizes <= DIRECT)].max(initial=1))):
        same = np.flatnonzero(k[d:] == k[:-d])
        if not len(same):
            break
        near = same[np.bitwise_count(f[same] ^ f[same + d]) <= RADIUS]
        u.append(near)
        v.append(near + d)
    if u:
        root = _forest(len(f), np.concatenate(u), np.concatenate(v))
        a.append(f)
        b.append(f[root])
    if not a:
        return np.empty((0, 2), np.int64)
    pair = np.stack([np.concatenate(a), np.concatenate(b)], 1).view(np.int64)
    return np.unique(pair[pair[:, 0] != pair[:, 1]], axis=0)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, np.ndarray]] = []  # of one bucket, the last, which may go on in the next batch

    def out() -> pa.RecordBatch:
        rows = _links(np.concatenate([k for k, _ in held]), np.concatenate([f for _, f in held]))
        return pa.RecordBatch.from_arrays([pa.array(rows[:, 0]), pa.array(rows[:, 1])], names=["u", "v"])

    for batch in batches:
        k, f = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
        if not len(k):
            continue
        last = int(np.searchsorted(k, k[-1]))
        if last or (held and held[0][0][0] != k[0]):
            held.append((k[:last], f[:last]))
            yield out()
            held = []
        held.append((k[last:], f[last:]))
    if held:
        yield out()


def link_forest(fps: DataFrame, fp_col: str = "fp") -> DataFrame:
    """(u, v) pairs of fingerprints that connect exactly what links within the radius connect; fps need not be distinct.

    The number of tasks follows the number of distinct fingerprints, so that none emits or verifies more than about BALL_BYTES.
    """
    distinct = fps.select(F.col(fp_col).alias("fp")).filter("fp is not null").distinct()
    parts = max(1, -(-distinct.count() * 16 * 4 * 49 // BALL_BYTES))
    met = distinct.repartition(parts, "fp").mapInArrow(_emit, "key bigint, fp bigint").repartition(parts, "key").sortWithinPartitions("key")
    return met.mapInArrow(_verify, "u bigint, v bigint")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp, fingerprint, component_id) for every row of docs.

    component_id is the smallest doc_id reachable over links of at most 3 bits. Null, empty and wordless texts have
    fingerprint 0 and are linked like others; repeated rows stay; a null doc_id is never a component's name unless all are
    null; other columns are ignored; an empty table gives an empty one. Documents meet through their fingerprint, which
    is pre-aggregated, so thousands of copies are one fingerprint.
    """
    own = cut(fingerprints(docs, id_col, text_col, shingle))
    least = own.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(link_forest(own)).select(F.col("node").alias("fp"), "root")
    named = least.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    names = named.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = named.join(names, "root").select("fp", "component_id")
    return own.join(by_fp, "fp").select("doc_id", "fp", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir)).select("doc_id", "fingerprint", "component_id")
