"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

An item of m bytes that occurs in a document with at most e edits shares m - Q + 1 - Q e q-grams with it, on diagonals no
further apart than e. Shared q-grams are counted in diagonal bands that overlap by half; a band of an item with that many is
aligned within the band, and kept if the edit distance is within the budget. Texts and items are compared in lower case with
runs of white space as one space. Items under MIN_BYTES can't be told from chance with edits: they are found only where they
occur unchanged between blanks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, keyed_texts

Q = 8
#: Edits allowed per byte of an item.
EDIT_RATE = 0.08
#: Items shorter than this (normalised bytes) are found only unchanged, between blanks.
MIN_BYTES = 32
#: Bytes of items that go to every task at once (their index is about 60 times as large); a larger benchmark is dealt into
#: slices that meet all documents by a shuffle.
SLICE_BYTES = 1_000_000
#: Bytes of documents that meet a slice in one task, about.
PART_BYTES = 64_000_000
_CHUNK = 4_000_000
_ODD = np.uint64(0x9E3779B97F4A7C15)


def normalise(text: str | None) -> bytes:
    return " ".join((text or "").lower().split()).encode("utf-8", "surrogatepass")


def _grams(raw: bytes) -> np.ndarray:
    return np.ndarray((max(0, len(raw) - Q + 1),), "<u8", raw, 0, (1,)) if len(raw) >= Q else np.empty(0, np.uint64)


def _band(item: np.ndarray, region: np.ndarray, low: int, high: int, anchored: bool) -> np.ndarray:
    """Edit distances of item to pieces of region that end at each place low + m .. high + m, over the diagonals low to high.

    anchored: pieces start at the region's start; otherwise anywhere.
    """
    k, n, m = high - low + 1, len(region), len(item)
    edge = max(0, -low) + 1
    text = np.full(edge + max(n, m + high) + 1, 256, np.int16)
    text[edge : edge + n] = region
    far, place = 2 * (n + m + k) + 2, np.arange(low, high + 1)
    d = np.where((place < 0) | (place > n), far, place if anchored else 0).astype(np.int64)
    step = np.arange(k)
    for i in range(1, m + 1):
        begin = edge + low + i - 1
        new = d + (text[begin : begin + k] != item[i - 1])
        new[:-1] = np.minimum(new[:-1], d[1:] + 1)
        d = np.minimum.accumulate(new - step) + step
    return d


def align(item: bytes, region: bytes, budget: int, low: int | None = None, high: int | None = None) -> tuple[int, int, int] | None:
    """(distance, start, stop) of the best place of item in region, if its edit distance is within the budget.

    low and high: the diagonals (places in region less places in item) that an alignment may touch; None: all of them.
    """
    at = region.find(item)
    if at >= 0:
        return 0, at, at + len(item)
    a, b = np.frombuffer(item, np.uint8), np.frombuffer(region, np.uint8)
    m, n = len(a), len(b)
    low, high = -m if low is None else max(low, -m), n if high is None else min(high, n)
    if high < low:
        return None
    ends = np.arange(low, high + 1) + m
    d = np.where((ends >= 0) & (ends <= n), _band(a, b, low, high, False), budget + 1)
    if (distance := int(d.min())) > budget:
        return None
    stop = int(ends[int(d.argmin())])
    # backward from where it stops: its length differs from the item's by no more than its edits
    back = _band(a[::-1], b[:stop][::-1], -distance, distance, True)
    lengths = np.arange(-distance, distance + 1) + m
    back = np.where((lengths >= 0) & (lengths <= stop), back, budget + 1)
    return distance, stop - int(lengths[int(back.argmin())]), stop


class ItemIndex:
    """Q-grams of the items of one slice; of bounded size, so that it may go to every task."""

    def __init__(self, items: list[tuple[object, bytes]], rate: float = EDIT_RATE):
        self.short: dict[bytes, list[object]] = {}
        for i, x in items:
            if len(x) < MIN_BYTES:
                self.short.setdefault(x, []).append(i)
        self.widths = sorted({x.count(b" ") + 1 for x in self.short})
        items = [(i, x) for i, x in items if len(x) >= MIN_BYTES]
        self.ids, self.raw = [i for i, _ in items], [x for _, x in items]
        m = np.array([len(x) for x in self.raw], np.int64)
        self.edits = np.minimum((m * rate).astype(np.int64), np.maximum((m - Q) // Q, 0))
        self.least = np.maximum(m - Q + 1 - Q * self.edits, 1)
        self.band = np.array([1 << int(max(e + 1, 8) - 1).bit_length() for e in self.edits], np.int64)  # by item
        self.longest = int((m + self.edits).max(initial=0))
        grams = np.concatenate([_grams(x) for x in self.raw]) if items else np.empty(0, np.uint64)
        item = np.repeat(np.arange(len(items)), np.maximum(m - Q + 1, 0))
        place = np.concatenate([np.arange(max(len(x) - Q + 1, 0)) for x in self.raw]) if items else np.empty(0, np.int64)
        order = np.argsort(grams, kind="stable")
        self.item, self.place = item[order], place[order]
        self.grams, self.begin, self.size = np.unique(grams[order], return_index=True, return_counts=True)
        self.bits = max(16, int(len(self.grams) * 16).bit_length())
        self.maybe = np.zeros(1 << self.bits, bool)
        self.maybe[self._slot(self.grams)] = True

    def _slot(self, grams: np.ndarray) -> np.ndarray:
        return ((grams * _ODD) >> np.uint64(64 - self.bits)).astype(np.int64)

    def search(self, texts: list[bytes]) -> Iterator[tuple[int, object, int, int, int]]:
        """(text, item's id, start, stop, distance) of each item found in each text; the same place is given once."""
        yield from self._unchanged(texts)
        yield from self._edited(texts)

    def _unchanged(self, texts: list[bytes]) -> Iterator[tuple[int, object, int, int, int]]:
        for d, text in enumerate(texts if self.short else ()):
            words = text.split(b" ")
            starts = np.cumsum([0, *(len(w) + 1 for w in words)]).tolist()
            for width in self.widths:
                for i in range(len(words) - width + 1):
                    run = b" ".join(words[i : i + width])
                    for name in self.short.get(run, ()):
                        yield d, name, starts[i], starts[i] + len(run), 0

    def _edited(self, texts: list[bytes]) -> Iterator[tuple[int, object, int, int, int]]:
        line = b"\xff".join(texts)
        ends = np.cumsum([len(x) + 1 for x in texts]) - 1
        grams = _grams(line)
        if not len(grams) or not len(self.grams):
            return
        at = np.flatnonzero(self.maybe[self._slot(grams)])
        which = np.minimum(np.searchsorted(self.grams, grams[at]), len(self.grams) - 1)
        ok = self.grams[which] == grams[at]
        at, which = at[ok], which[ok]
        need = int(self.least.min())
        if len(at) < need:
            return
        # q-grams that lie in no window with enough of them are in no occurrence
        full = np.flatnonzero(at[need - 1 :] - at[: len(at) - need + 1] <= self.longest)
        mark = np.zeros(len(at) + 1, np.int64)
        np.add.at(mark, full, 1)
        np.add.at(mark, full + need, -1)
        ok = np.cumsum(mark[:-1]) > 0
        at, which = at[ok], which[ok]
        size = self.size[which]
        stop = np.cumsum(size)
        post = np.repeat(self.begin[which] - stop + size, size) + np.arange(stop[-1] if len(stop) else 0)
        item, at = self.item[post], np.repeat(at, size)
        text = np.searchsorted(ends, at)
        begin = np.concatenate([[0], ends[:-1] + 1])
        # counted by item, text and band; a diagonal is relative to its text
        band = (at - begin[text] - self.place[post] + self.longest) // self.band[item]
        span = (max(map(len, texts)) + self.longest) // 8 + 2
        own = (item * len(texts) + text) * span
        keys, counts = np.unique(np.concatenate([own + band, own + np.maximum(band - 1, 0)]), return_counts=True)
        seen = set()
        for key in keys[counts >= self.least[keys // span // len(texts)]].tolist():
            own, b = divmod(key, span)
            i, d = divmod(own, len(texts))
            e, m, width = int(self.edits[i]), len(self.raw[i]), int(self.band[i])
            first, last = int(begin[d]), int(ends[d])
            low = first + b * width - self.longest
            lo, hi = max(first, low - e), min(last, low + 2 * width + m + e)
            if hi - lo >= m - e and (found := align(self.raw[i], line[lo:hi], e, low - 2 * e - lo, low + 2 * (width + e) - lo)):
                row = (d, i, lo + found[1] - first, lo + found[2] - first, found[0])
                if row not in seen:
                    seen.add(row)
                    yield d, self.ids[i], *row[2:]


def find_benchmark(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", rate: float = EDIT_RATE, min_bytes: int = 1, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """(doc_id, item_id, start, stop, distance): places (bytes of the normalised text) where an item occurs within its budget.

    Null and empty texts and items match nothing; items under min_bytes are left out; repeated rows of either side are
    reported each time; other columns are ignored; an empty side gives an empty table. A benchmark of one slice goes to every
    task and nothing is shuffled; a larger one is never held in one place: each slice meets each part of the documents.
    """
    texts = keyed_texts(docs, id_col, text_col)
    items = benchmark.select(F.col(item_col).alias("item_id"), F.col(item_text).alias("item")).filter("item is not null")
    kinds = texts.schema["doc_id"].dataType.simpleString(), items.schema["item_id"].dataType.simpleString()
    arrow = pa.int64() if kinds[1] == "bigint" else pa.int32() if kinds[1] == "int" else pa.string()
    slices = max(1, -(-(items.agg(F.sum(F.octet_length("item"))).first()[0] or 0) // slice_bytes))
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, start int, stop int, distance int"

    def indexed(pairs: list[tuple]) -> ItemIndex:
        return ItemIndex(sorted(((i, raw) for i, x in pairs if len(raw := normalise(x)) >= max(1, min_bytes)), key=lambda x: (str(x[0]), x[1])), rate)

    def found(index: ItemIndex, ids: pa.Array, some: list) -> Iterator[pa.RecordBatch]:
        lo, raw = 0, [normalise(x) for x in some]
        while lo < len(raw):
            hi, size = lo, 0
            while hi < len(raw) and (size < _CHUNK or hi == lo):
                size, hi = size + len(raw[hi]), hi + 1
            rows = list(index.search(raw[lo:hi]))
            at = pa.array([lo + x[0] for x in rows], pa.int64())
            yield pa.RecordBatch.from_arrays([ids.take(at), pa.array([x[1] for x in rows], arrow), *(pa.array([x[j] for x in rows], pa.int32()) for j in (2, 3, 4))], names=["doc_id", "item_id", "start", "stop", "distance"])
            lo = hi

    if slices == 1:
        pairs = [tuple(r) for r in items.collect()]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = indexed(pairs)
            for batch in batches:
                yield from found(index, batch.column(0), batch.column(1).to_pylist())

        return texts.mapInArrow(run, schema)

    parts = max(1, -(-(texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // PART_BYTES))
    every = lambda n, name: F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)
    left = texts.select("*", F.pmod(F.xxhash64("doc_id", "text"), F.lit(parts)).cast("int").alias("part"), every(slices, "slice"))
    right = items.select("*", F.pmod(F.xxhash64("item"), F.lit(slices)).cast("int").alias("slice"), every(parts, "part"))

    def meet(some: pa.Table, own: pa.Table) -> pa.Table:
        index = indexed(list(zip(own.column("item_id").to_pylist(), own.column("item").to_pylist(), strict=True)))
        made = list(found(index, some.column("doc_id").combine_chunks(), some.column("text").to_pylist()))
        return pa.Table.from_batches(made) if made else pa.table({"doc_id": some.column("doc_id").slice(0, 0), "item_id": pa.array([], arrow)} | {c: pa.array([], pa.int32()) for c in ("start", "stop", "distance")})

    return left.groupBy("slice", "part").cogroup(right.groupBy("slice", "part")).applyInArrow(meet, schema)


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_benchmark(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
