"""Removal of long repeated byte strings by threshold-bounded interval expansion.

Every string of LENGTH bytes holds an anchor: a GRAM-byte string whose hash is least among those that start in it, so equal
strings hold equal anchors at equal places. Anchors that occur once are done with. The occurrences of an anchor, sorted by
what follows, are an interval of suffixes; breadth first, level by level, each interval is extended backward by the byte
before its suffixes (the Burrows-Wheeler column) and split into those of equal bytes, keeping the sorted order. At level l a
run of an interval whose common prefix has LENGTH - l bytes or more is a repeated string that starts l bytes before the
anchor. Intervals of one suffix are dropped, and the extension stops where the string would no longer hold the anchor.
Anchors with very many occurrences don't meet in one task: their strings are counted by 128-bit hashes instead.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents

LENGTH = 400
#: Occurrences of an anchor from which its strings are counted by hash.
HOT = 10_000
#: Tasks that the places of one string at a hot anchor are dealt to.
SALTS = 16
_RNG = np.random.default_rng(400)
_BYTES = _RNG.integers(1, 1 << 63, (2, 256), dtype=np.uint64)
_BASES = (0x9E3779B97F4A7C15 | 1, 0xD1B54A32D192ED03 | 1)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base and of its inverse, modulo 2**64."""
    if which not in _powers or len(_powers[which][0]) < n:
        size = max(n, 1 << 16)
        _powers[which] = tuple(np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, b, np.uint64)])) for b in (_BASES[which], pow(_BASES[which], -1, 1 << 64)))
    return _powers[which]


def rolling(data: np.ndarray, size: int, which: int = 0) -> np.ndarray:
    """64-bit hash of every substring of that size."""
    up, down = _power(which, len(data) + 1)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_BYTES[which][data] * up[: len(data)])])
    h = (sums[size:] - sums[:-size]) * down[: len(data) - size + 1]
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def _sliding(x: np.ndarray, size: int, f: np.ufunc) -> np.ndarray:
    """f over every window of that size, by doubling."""
    span = 1
    while 2 * span <= size:
        x, span = f(x[:-span], x[span:]), 2 * span
    return f(x[: len(x) - (size - span)], x[size - span :]) if size > span else x


def anchors(data: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the anchors of one text of at least `length` bytes."""
    gram = length // 2
    h = rolling(data, gram)
    least = _sliding(h, length - gram + 1, np.minimum)  # one value a window
    edge = np.zeros(length - gram, np.uint64)
    reach = _sliding(np.concatenate([edge, least, edge]), length - gram + 1, np.maximum)
    at = np.flatnonzero(reach == h)
    return at, h[at]


def expand(group: np.ndarray, rows: np.ndarray, before: np.ndarray, after: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """For each row (an occurrence) the least and greatest level at which its string is repeated; greatest -1: none.

    rows: bytes around the anchors, which start at column length - gram; before and after: how many of the bytes before the
    anchor's start, and from there on, belong to the text.
    """
    lead = length - length // 2
    low, high = np.full(len(rows), length), np.full(len(rows), -1)
    if not len(rows):
        return low, high
    wide = -(-(rows.shape[1] - lead) // 8) * 8
    tail = np.zeros((len(rows), wide), np.uint8)
    tail[:, : rows.shape[1] - lead] = rows[:, lead:]
    words = tail.view(">u8")
    order = np.lexsort([*(words[:, i] for i in range(words.shape[1] - 1, -1, -1)), group])
    tail, g = tail[order], group[order]
    differ = tail[1:] != tail[:-1]
    same = np.where(differ.any(axis=1), differ.argmax(axis=1), wide)
    common = np.concatenate([[0], np.minimum(same, np.minimum(after[order][1:], after[order][:-1]))])
    new = np.concatenate([[True], g[1:] != g[:-1]])
    for level in range(lead + 1):
        if level:
            # backward extension: the byte before; where the text has none, the suffix is alone
            byte = rows[order, lead - level].astype(np.int64)
            none = before[order] < level
            byte[none] = 256 + np.flatnonzero(none)
            key = np.cumsum(new) * (257 + len(order)) + byte
            if (key[1:] < key[:-1]).any():
                at = np.argsort(key, kind="stable")
                key = key[at]
                pairs = np.stack([at[:-1] + 1, at[1:] + 1], 1)
                pairs[pairs[:, 0] >= pairs[:, 1]] = (0, 1)  # from one interval to the next: no common prefix is asked for
                between = np.minimum.reduceat(np.append(common, 0), pairs.ravel())[::2]
                order, common = order[at], np.concatenate([[0], between])
            new = np.concatenate([[True], key[1:] != key[:-1]])
        alone = new & np.append(new[1:], True)
        if alone.any():
            keep = ~alone
            order, common, new = order[keep], common[keep], new[keep]
            if not len(order):
                break
        tied = ~new & (common >= length - level)
        hit = order[tied | np.append(tied[1:], False)]
        low[hit] = np.minimum(low[hit], level)
        high[hit] = level
    return low, high


def repeated_spans(texts: DataFrame, length: int = LENGTH, hot: int = HOT) -> DataFrame:
    """(t, u, start, stop) of repeated strings in different texts (t, u, data binary), each given once; spans may overlap."""
    gram = length // 2
    lead = length - gram

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = ([], [], [], [])
            for i, data in enumerate(batch.column(2)):
                raw = data.as_buffer()
                if len(raw) < length:
                    continue
                at, h = anchors(np.frombuffer(raw, np.uint8), length)
                order = np.argsort(h, kind="stable")
                at, h = at[order], h[order]
                first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
                out[0].append(h[first])
                out[1].append(np.full(len(first), i))
                out[2].append(at)
                out[3].append(np.diff(np.append(first, len(h))))
            if out[0]:
                row, sizes = np.concatenate(out[1]), np.concatenate(out[3])
                places = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(np.concatenate(out[2]), pa.int32()))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out[0]).view(np.int64)), batch.column(0).take(pa.array(row)), batch.column(1).take(pa.array(row)), places], names=["h", "t", "u", "places"])

    found = texts.select("t", "u", "data").mapInArrow(find, "h bigint, t bigint, u bigint, places array<int>")
    often = found.groupBy("h").agg(F.sum(F.size("places")).alias("n")).filter("n >= 2")
    met = found.join(often, "h").withColumn("hot", F.col("n") >= hot)
    asked = met.groupBy("t", "u").agg(F.collect_list(F.struct("h", "places", "hot")).alias("asked"))
    whole = texts.select("t", "u", "data").join(asked, ["t", "u"])

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t, u, data, wanted in zip(*(batch.column(i) for i in range(4)), strict=True):
                raw, rows = data.as_py(), {}
                for one in wanted.as_py():
                    if not one["hot"]:
                        for p in one["places"]:
                            rows.setdefault((one["h"], raw[max(0, p - lead) : p + length], min(p, lead)), []).append(p)
                if rows:
                    n = len(rows)
                    yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in rows], pa.int64()), pa.array([t.as_py()] * n, pa.int64()), pa.array([u.as_py()] * n, pa.int64()), pa.array([k[1] for k in rows], pa.binary()), pa.array([k[2] for k in rows], pa.int32()), pa.array(list(rows.values()), pa.list_(pa.int32()))], names=["h", "t", "u", "around", "before", "places"])

    def intervals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def done(table: pa.Table) -> Iterator[pa.RecordBatch]:
            around, before = table.column("around").to_pylist(), table.column("before").to_numpy().astype(np.int64)
            rows = np.zeros((len(around), lead + length), np.uint8)
            for i, (x, b) in enumerate(zip(around, before.tolist(), strict=True)):
                rows[i, lead - b : lead - b + len(x)] = np.frombuffer(x, np.uint8)
            after = np.array([len(x) for x in around], np.int64) - before
            low, high = expand(table.column("h").to_numpy(), rows, before, after, length)
            out = ([], [], [], [])
            for i, (t, u, places) in enumerate(zip(table.column("t").to_pylist(), table.column("u").to_pylist(), table.column("places").to_pylist(), strict=True)):
                if len(places) > 1 and before[i] + after[i] >= length:  # the same bytes around two places of one text
                    low[i], high[i] = length - after[i], before[i]
                if high[i] >= 0:
                    for p in places:
                        for column, x in zip(out, (t, u, p - int(high[i]), p - int(low[i]) + length), strict=True):
                            column.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int32()), pa.array(out[3], pa.int32())], names=["t", "u", "start", "stop"])

        rows = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            rows += batch.num_rows
            if rows >= hot:
                table = pa.Table.from_batches(held)
                h = table.column("h").to_numpy()
                cut = int(np.searchsorted(h, h[-1]))  # the last anchor may go on in the next batch
                if cut:
                    yield from done(table.slice(0, cut))
                    held = table.slice(cut).to_batches()
                    rows = table.num_rows - cut
        if held:
            yield from done(pa.Table.from_batches(held))

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t, u, data, wanted in zip(*(batch.column(i) for i in range(4)), strict=True):
                places = [p for one in wanted.as_py() if one["hot"] for p in one["places"]]
                if places:
                    raw = np.frombuffer(data.as_buffer(), np.uint8)
                    own = np.unique((np.array(places)[:, None] - np.arange(lead + 1)).ravel())
                    own = own[(own >= 0) & (own <= len(raw) - length)]
                    a, b = (rolling(raw, length, k)[own].view(np.int64) for k in (0, 1))
                    order = np.lexsort((b, a))
                    a, b, own = a[order], b[order], own[order]
                    first = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])) if len(own) else np.empty(0, np.int64)
                    starts = pa.ListArray.from_arrays(pa.array(np.append(first, len(own)), pa.int32()), pa.array(own, pa.int32()))
                    yield pa.RecordBatch.from_arrays([pa.array(a[first]), pa.array(b[first]), pa.array(np.full(len(first), t.as_py())), pa.array(np.full(len(first), u.as_py())), starts], names=["a", "b", "t", "u", "starts"])

    around = whole.mapInArrow(contexts, "h bigint, t bigint, u bigint, around binary, before int, places array<int>")
    spans = around.repartition("h").sortWithinPartitions("h").mapInArrow(intervals, "t bigint, u bigint, start int, stop int")
    counted = whole.filter(F.exists("asked", lambda x: x["hot"])).mapInArrow(windows, "a bigint, b bigint, t bigint, u bigint, starts array<int>")
    # counts are summed before they move; the rows of a string meet its verdict in many tasks, not in one
    twice = counted.groupBy("a", "b").agg(F.sum(F.size("starts")).alias("n")).filter("n >= 2").select("a", "b", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    hit = counted.withColumn("salt", F.pmod(F.col("t"), F.lit(SALTS)).cast("int")).join(twice, ["a", "b", "salt"]).select("t", "u", F.explode("starts").alias("start"))
    return spans.unionByName(hit.select("t", "u", "start", (F.col("start") + length).alias("stop")))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, hot: int = HOT, digest: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept binary) for every row of docs; digest: kept_sha256 instead of kept, so that
    the bytes needn't move to the rows.

    Removed is each byte within a string of `length` bytes that also starts anywhere else, judged on the input. Texts are
    matched once however often they occur; one that occurs twice goes whole if it has `length` bytes. Null reads as empty;
    shorter texts stay; repeated rows count as copies; other columns are ignored; an empty table gives an empty one.
    """
    kept_name = "kept_sha256" if digest else "kept"
    own = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("data"))
    own = own.select("doc_id", "data", F.xxhash64("data").alias("t"), F.xxhash64(F.lit(1), "data").alias("u"))
    texts = own.groupBy("t", "u").agg(F.first("data").alias("data"), F.count(F.lit(1)).alias("copies"))
    spans = repeated_spans(texts, length, hot).groupBy("t", "u").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for data, copies, found in zip(batch.column(2), batch.column(3), batch.column(4), strict=True):
                raw, kept, n, end = data.as_py(), [], 0, 0
                if copies.as_py() > 1 and len(raw) >= length:
                    out.append((1, len(raw), b""))
                    continue
                for start, stop in sorted((x["start"], x["stop"]) for x in found.as_py() or ()):
                    if start > end or not n:
                        kept.append(raw[end:start])
                        n += 1
                    end = max(end, stop)
                kept.append(raw[end:])
                rest = b"".join(kept)
                out.append((n, len(raw) - len(rest), rest))
            rests = pa.array([hashlib.sha256(x[2]).hexdigest() for x in out], pa.string()) if digest else pa.array([x[2] for x in out], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64()), rests], names=["t", "u", "n_spans", "n_removed", kept_name])

    done = texts.join(spans, ["t", "u"], "left").select("t", "u", "data", "copies", "spans").mapInArrow(cut, f"t bigint, u bigint, n_spans bigint, n_removed bigint, {kept_name} {'string' if digest else 'binary'}")
    rows = own.select("doc_id", "t", "u", F.octet_length("data").cast("bigint").alias("n_bytes"))
    return rows.join(done, ["t", "u"]).select("doc_id", "n_bytes", "n_removed", "n_spans", kept_name)


def op6_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir), digest=True)
