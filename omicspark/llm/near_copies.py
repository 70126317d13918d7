"""Near copies by word shingles: ball hashing over SimHash fingerprints, and exact verification.

A text is its set of five-word shingles. Its fingerprint is a SimHash of 192 bits, each the majority of one bit of the shingles'
hashes, in twelve blocks of 16. Each block emits itself and all its variants of one bit, half of the radius of 2, so blocks up
to 2 bits apart meet in the middle. The blocks of so many texts would fill all 65,536 values, so each goes with a min-hash of
its own, and meets the blocks of texts with that min-hash. At similarity s a bit differs with probability arccos(2s / (1 + s)) / pi
(0.15 at 0.8) and a min-hash is equal with s: a pair at 0.8 meets with probability 0.999. Pairs that meet are verified on
all 192 bits, of which 54 may differ (29 do on average at 0.8), and linked if the Jaccard similarity of their sets (64-bit
hashes of shingles) is 0.8 or more. A text is in up to fifteen buckets of a min-hash, so those that share a bucket of it with
another are searched together, once, by all bits: up to a few pairs a member are verified one by one; of a group with more near
pairs than that first the shortest tree that connects them. If its links leave parts of the group apart, the pairs between parts
are verified, or, if they are many, the sets move to one task, where rarest shingles (prefix filter) find every pair between
parts. If more texts than TOGETHER share buckets of a min-hash, each of its buckets is a group by itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, quoted, spare
from .components import components

SHINGLE = 5
#: 64-bit words of a fingerprint; its blocks, each with a min-hash, and their bits.
WORDS = 3
BLOCKS, WIDTH = 12, 14
#: Bits that differ in fingerprints of a linked pair, at most.
FAR = 54
#: Pairs of a group that are verified one by one, for each member.
PAIRS = 8
#: Members of the buckets of one min-hash that are searched in one task, at most.
TOGETHER = 1 << 12
#: Links up to this number end in one task.
SMALL = 1 << 18
_ODD = np.uint64(0x9E3779B97F4A7C15)
_HALF = np.uint64(32)
_rng = np.random.default_rng(42)
_FLIP = _rng.integers(0, 1 << 64, BLOCKS, np.uint64)
_TIMES = _rng.integers(0, 1 << 64, BLOCKS, np.uint64) | np.uint64(1)
_PLACE = _rng.integers(0, 1 << 64, BLOCKS, np.uint64)
_SPIN = _rng.integers(0, 1 << 64, WORDS, np.uint64) | np.uint64(1)
#: What a block is changed by: nothing, or one bit.
_BALL = np.array([0, *(1 << i for i in range(WIDTH))], np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _HALF)) * _ODD
    return x ^ (x >> _HALF)


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the runs of five words, A-Z lower-cased; a shorter text is one run, a wordless one none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    if len(words) <= SHINGLE:
        return np.array([digest(b" ".join(words))], np.uint64)
    h = np.array([digest(w) for w in words], np.uint64)
    n = len(h) - SHINGLE + 1
    runs = h[:n]
    for j in range(1, SHINGLE):
        runs = _mix(runs) + h[j : j + n]
    return np.unique(_mix(runs))


def fingerprint(own: np.ndarray) -> np.ndarray:
    """SimHash of one set of shingles: a bit is set if over half of the hashes have it."""
    counts = np.zeros(64 * WORDS, np.int64)
    for lo in range(0, len(own), 255):
        h = _mix(_mix((own[lo : lo + 255, None] ^ _FLIP[:WORDS]) * _SPIN))
        counts += np.unpackbits(h.view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint8)
    return np.packbits(2 * counts > len(own), bitorder="little").view(np.uint64)


def least(own: np.ndarray) -> np.ndarray:
    """The min-hashes that go with the blocks of one set of shingles."""
    out = np.full(BLOCKS, np.iinfo(np.uint64).max, np.uint64)
    for lo in range(0, len(own), 1 << 12):
        np.minimum(out, _mix((own[lo : lo + (1 << 12), None] ^ _FLIP) * _TIMES).min(axis=0), out=out)
    return out


def balls(prints: np.ndarray, leasts: np.ndarray) -> np.ndarray:
    """Keys of texts, a row each: every block and its variants of one bit, with its min-hash. The last five bits of a key are
    the bit that was changed, counted from 1, or 0; the others name the bucket, by a hash of the min-hash, then the block. Keys
    are 0 or more."""
    bits = np.unpackbits(np.ascontiguousarray(prints).view(np.uint8), axis=1, count=BLOCKS * WIDTH, bitorder="little")
    blocks = bits.reshape(-1, BLOCKS, WIDTH).astype(np.uint64) @ _BALL[1:]
    of_least = _mix(_mix(leasts ^ _PLACE) * _ODD) >> np.uint64(WIDTH + 6) << np.uint64(WIDTH + 5)
    keys = of_least[..., None] | (blocks[..., None] ^ _BALL) << np.uint64(5)
    return (keys | np.arange(len(_BALL), dtype=np.uint64)).reshape(len(prints), -1).view(np.int64)


def alike(a: int, b: int, both: int) -> bool:
    """Jaccard similarity of 0.8 or more, for sets of a and b members that share so many; or arrays of them."""
    return 5 * both >= 4 * (a + b - both)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The columns of the batch but the last, the text, and node, a hash of its set, fingerprint and min-hashes."""
    for batch in batches:
        sets = [shingles(x.as_py()) for x in batch.column(batch.num_columns - 1)]
        node = pa.array([xxhash.xxh64_intdigest(s.tobytes()) - (1 << 63) for s in sets], pa.int64())
        own = [pa.array([f(s).view(np.int64) if len(s) else np.empty(0, np.int64) for s in sets], pa.list_(pa.int64())) for f in (fingerprint, least)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], node, *own], names=[*batch.schema.names[:-1], "node", "fp", "least"])


def _emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 1024):
            node, *own = batch.slice(lo, 1024).columns
            keys = balls(*(c.flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(len(node), -1) for c in own))
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.repeat(node.to_numpy(zero_copy_only=False), keys.shape[1]))], names=["key", "node"])


def _shared_of(keys: np.ndarray, nodes: np.ndarray) -> pa.RecordBatch:
    """(key, node) of whole buckets, sorted by key: the bucket and its members, if it has several.

    Members in which the same bit was changed have equal blocks, and meet in the bucket of the block itself.
    """
    keys, bit = keys >> 5, keys & 31
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]]))
    sizes = np.diff(new)
    alone = (bit[new[:-1]] > 0) & (bit[new[:-1]] == bit[new[1:] - 1])
    shared = np.repeat((sizes > 1) & ~alone, sizes)
    return pa.RecordBatch.from_arrays([pa.array(keys[shared]), pa.array(nodes[shared])], names=["key", "node"])


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held_k, held_x = [], []
    for batch in batches:
        k, x = (batch.column(j).to_numpy(zero_copy_only=False) for j in (0, 1))
        if not len(k):
            continue
        whole = int(np.searchsorted(k, k[-1] & -32))  # the last bucket may go on in the next batch
        if held_k and held_k[0][0] >> 5 != k[0] >> 5 and not whole:
            yield _shared_of(np.concatenate(held_k), np.concatenate(held_x))
            held_k, held_x = [], []
        elif whole:
            yield _shared_of(np.concatenate([*held_k, k[:whole]]), np.concatenate([*held_x, x[:whole]]))
            held_k, held_x = [], []
        held_k.append(k[whole:])
        held_x.append(x[whole:])
    if held_k:
        yield _shared_of(np.concatenate(held_k), np.concatenate(held_x))


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([shingles(x.as_py()).tobytes() for x in batch.column(1)], pa.binary())], names=["node", "own"])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ok = []
        for a, b in zip(batch.column(2), batch.column(3), strict=True):
            a, b = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
            ok.append(alike(len(a), len(b), min(len(a), len(b))) and alike(len(a), len(b), len(np.intersect1d(a, b, assume_unique=True))))
        yield pa.RecordBatch.from_arrays([x.filter(pa.array(ok, pa.bool_())) for x in batch.columns[:2]], names=["u", "v"])


def across(roots: list[int], sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links between members of different roots that connect what all pairs of the members would."""
    n = np.array([len(s) for s in sets], np.int64)
    _, token, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner, begin = np.repeat(np.arange(len(sets)), n), np.concatenate([[0], np.cumsum(n)])
    order = np.lexsort((token, count[token], owner))  # of each member the rarest first; alike sets share one of the first
    first, root, out = n - (4 * n + 4) // 5 + 1, np.unique(roots, return_inverse=True)[1], []
    lead = order[np.arange(len(order)) - begin[owner] < first[owner]]
    lead = lead[count[token[lead]] > 1]
    lead = lead[np.lexsort((owner[lead], token[lead]))]  # the members of each token, in order
    start = np.flatnonzero(np.concatenate([[True], np.diff(token[lead]) > 0]))[: len(lead)]
    start = np.repeat(start, np.diff([*start, len(lead)]))
    who, mine = owner[lead], np.argsort(owner[lead], kind="stable")
    at = np.searchsorted(who[mine], np.arange(len(sets) + 1))
    mark, hit = np.zeros(len(count), np.int32), np.zeros(len(sets), bool)
    for i in range(len(sets)):
        hit[:i] = False
        for k in mine[at[i] : at[i + 1]].tolist():
            hit[who[start[k] : k]] = True
        met = np.flatnonzero(hit[:i] & (root[:i] != root[i]) & (5 * np.minimum(n[:i], n[i]) >= 4 * np.maximum(n[:i], n[i])))
        if not len(met):
            continue
        mark[token[begin[i] : begin[i + 1]]] = 1
        if 2 * len(met) > i:
            both = np.add.reduceat(mark[token[: begin[i]]], begin[:i])[met]
        else:
            both = np.add.reduceat(mark[np.concatenate([token[begin[j] : begin[j + 1]] for j in met.tolist()])], np.cumsum(n[met]) - n[met])
        mark[token[begin[i] : begin[i + 1]]] = 0
        for j in met[alike(n[i], n[met], both)].tolist():
            if root[j] != root[i]:
                out.append((i, j))
                root[root == root[j]] = root[i]
    return out


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """The columns of whole buckets, sorted by the first."""
    held: list[pa.RecordBatch] = []
    arrays = lambda rows: [c.to_numpy(zero_copy_only=False) for c in pa.Table.from_batches(rows).columns]
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column(0).to_numpy(zero_copy_only=False)
        new = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(key)]
        for lo, hi in zip(new[:-1], new[1:], strict=True):
            if held and held[0].column(0)[0].as_py() != key[lo]:
                yield arrays(held)
                held = []
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield arrays(held)


def between(root: np.ndarray, prints: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray] | None:
    """Pairs of members of different roots whose fingerprints differ in at most FAR bits; None if there are more than that many."""
    _, part, size = np.unique(root, return_inverse=True, return_counts=True)
    rest = np.flatnonzero(part != size.argmax())  # each pair has one of these
    minor, u, v, n = part != size.argmax(), [], [], 0
    for lo in range(0, len(rest), 64):
        i = rest[lo : lo + 64]
        far = sum(np.bitwise_count(prints[i, None, w] ^ prints[None, :, w]).astype(np.int16) for w in range(WORDS))
        a, b = np.nonzero((far <= FAR) & (part[i, None] != part[None, :]) & (~minor[None, :] | (i[:, None] < np.arange(len(part)))))
        u.append(i[a])
        v.append(b)
        n += len(a)
        if n > most:
            return None
    return np.concatenate(u or [rest]), np.concatenate(v or [rest])


def tree(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that connect all members whom pairs of at most FAR bits connect, by as few bits as can be; of more than TOGETHER
    members a star."""
    n = len(prints)
    if n > TOGETHER:
        return np.zeros(n - 1, np.int64), np.arange(1, n)
    words, done, i = np.ascontiguousarray(prints.T), np.zeros(n, bool), 0
    least, to, out = np.full(n, 255, np.uint8), np.zeros(n, np.int64), []
    for _ in range(n - 1):
        done[i], least[i] = True, 255
        far = np.bitwise_count(words ^ words[:, i, None]).sum(axis=0, dtype=np.uint8)
        closer = (far < least) & ~done
        least[closer], to[closer] = far[closer], i
        i = int(least.argmin())
        if least[i] <= FAR:
            out.append((to[i], i))
    u, v = np.array(out, np.int64).reshape(-1, 2).T
    return u, v


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(u, v, key): of (key, node, root, f0, f1, ...) the near pairs of each group; of groups with too many of them a tree and the key."""
    held: list[list[np.ndarray]] = []

    def out() -> pa.RecordBatch:
        u, v, key, some = (np.concatenate(x) for x in zip(*held, strict=True))
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v)), pa.array(key, mask=~some)], names=["u", "v", "key"])

    for key, node, root, *words in _buckets(batches):
        prints = np.stack(words, 1).view(np.uint64)
        met = between(root, prints, PAIRS * len(node))
        u, v = tree(prints) if met is None else met
        held.append([node[u], node[v], key[u], np.full(len(u), met is None)])
        if len(held) >= 1 << 10:
            yield out()
    if held:
        yield out()


def _between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(u, v, key): of (key, node, root, f0, f1, ...) the pairs to verify; of groups with too many of them the nodes, roots and key."""
    for key, node, root, *words in _buckets(batches):
        met = between(root, np.stack(words, 1).view(np.uint64), PAIRS * len(node))
        u, v = (node, root) if met is None else (np.minimum(node[met[0]], node[met[1]]), np.maximum(node[met[0]], node[met[1]]))
        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v), pa.array(np.resize(key, len(u)), mask=np.full(len(u), met is not None))], names=["u", "v", "key"])


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def out(rows: list[tuple]) -> pa.RecordBatch:
        found = across([r[2] for r in rows], [np.frombuffer(r[3], np.uint64) for r in rows])
        return pa.RecordBatch.from_arrays([pa.array([rows[i][1] for i, _ in found], pa.int64()), pa.array([rows[j][1] for _, j in found], pa.int64())], names=["u", "v"])

    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and held[0][0] != row[0]:
                yield out(held)
                held = []
            held.append(row)
    if held:
        yield out(held)


def linked(own: DataFrame, texts: DataFrame) -> DataFrame:
    """(node, root) of the texts that are linked to another. own: h, l, node, fp, least (see sketched); texts: h, l, text of the
    same rows, of which only those move whose node meets another."""
    distinct = own.filter(F.size("fp") > 0).select("node", "fp", "least").dropDuplicates(["node"])
    keyed = distinct.mapInArrow(_emit, "key bigint, node bigint").repartition(F.shiftright("key", 5))
    met = cut(keyed.sortWithinPartitions("key", "node").mapInArrow(_shared, "key bigint, node bigint"))
    prints = distinct.select("node", *(F.col("fp")[i].alias(f"f{i}") for i in range(WORDS)))
    side = lambda df, x, c: df.select(F.col("node").alias(x), F.col(c).alias(f"of_{x}"))
    least = -1 - F.shiftright("key", WIDTH)
    members = cut(met.select(least.alias("key"), "node").distinct())
    full = cut(members.groupBy("key").count().filter(F.col("count") > TOGETHER).select("key"))
    if not full.isEmpty():  # of these each bucket is searched by itself
        single = met.withColumn("least", least).join(full.withColumnRenamed("key", "least"), "least", "left_semi")
        members = members.join(full, "key", "left_anti").unionByName(single.select("key", "node"))
    # keys that meet in the same nodes are searched once
    alike = members.groupBy("key").agg(F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("a"), F.sum(F.xxhash64("node", F.lit(1)).cast("decimal(38,0)")).alias("b")).groupBy("a", "b").agg(F.min("key").alias("key")).select("key")
    members = cut(members.join(alike, "key", "left_semi").select("key", "node", F.col("node").alias("root")))

    def groups(members: DataFrame) -> DataFrame:
        rows = members.join(prints, "node").select("key", "node", "root", *prints.columns[1:])
        return rows.repartition("key").sortWithinPartitions("key", "node")

    def sets_of(nodes: DataFrame) -> DataFrame:
        chosen = own.join(nodes.distinct(), "node", "left_semi").groupBy("node").agg(F.min(F.struct("h", "l")).alias("c")).select("node", F.col("c.h").alias("h"), F.col("c.l").alias("l"))
        return cut(texts.select("h", "l", "text").join(chosen, ["h", "l"]).select("node", "text").mapInArrow(_sets, "node bigint, own binary").dropDuplicates(["node"]))

    def verified(pairs: DataFrame) -> DataFrame:
        sets = sets_of(pairs.select(F.explode(F.array("u", "v")).alias("node")))
        return cut(pairs.join(side(sets, "u", "own"), "u").join(side(sets, "v", "own"), "v").select("u", "v", "of_u", "of_v").mapInArrow(_verify, "u bigint, v bigint"))

    near = cut(groups(members).mapInArrow(_near, "u bigint, v bigint, key bigint"))
    pairs = cut(near.select("u", "v").distinct())
    links = verified(pairs)
    roots = components(links, small=SMALL)
    some = members.join(near.filter("key is not null").select("key").distinct(), "key", "left_semi").drop("root")
    some = cut(some.join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root")))
    apart = some.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b")).filter("a <> b").select("key")
    if apart.isEmpty():
        return roots
    left = cut(groups(some.join(apart, "key", "left_semi")).mapInArrow(_between, "u bigint, v bigint, key bigint"))
    links = links.unionByName(verified(left.filter("key is null").select("u", "v").distinct().join(pairs, ["u", "v"], "left_anti")))
    many = left.filter("key is not null").select("key", F.col("u").alias("node"), F.col("v").alias("root"))
    if not many.isEmpty():
        many = many.join(sets_of(many.select("node")), "node").select("key", "node", "root", "own")
        links = links.unionByName(many.repartition("key").sortWithinPartitions("key", "node").mapInArrow(_across, "u bigint, v bigint"))
    return components(links, small=SMALL)


def sketched(texts: DataFrame) -> DataFrame:
    """(h, l, id, node, fp, least), a checkpoint without the texts. texts: h, l, id, text; h and l name a row's content."""
    rows = texts.select("h", "l", "id", "text")
    return cut(rows.mapInArrow(_sketch, f"h bigint, l bigint, id {rows.schema['id'].dataType.simpleString()}, node bigint, fp array<bigint>, least array<bigint>"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each group of linked texts: that of the least doc_id (nulls last), then chosen by content.

    Rows are told apart by their content, not by doc_id, so texts of one id, or without id, stay unless they are linked. Null,
    empty and wordless texts are copies of each other; rows alike in all columns are one; an empty table stays empty, and
    columns of any name stay as they are.
    """
    every = [F.col(quoted(c)) for c in docs.columns]
    h, l = spare(docs.columns, "_h", "_l")  # noqa: E741
    rows = docs.withColumns({h: F.xxhash64(*every), l: F.xxhash64(F.lit(1), *every)})
    texts = rows.select(F.col(h).alias("h"), F.col(l).alias("l"), F.col(quoted(id_col)).alias("id"), F.col(quoted(text_col)).alias("text"))
    own = sketched(texts)
    named = own.select("node", "id", "h", "l").join(linked(own, texts), "node", "left")
    best = named.groupBy(F.coalesce("root", "node").alias("root")).agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "h", "l")).alias("b"))
    kept = rows.join(best.select(F.col("b.h").alias(h), F.col("b.l").alias(l)), [h, l], "left_semi")
    return kept.dropDuplicates([h, l]).drop(h, l)
