"""Runs of repeating words: online dyadic square catching.

Words are appended one by one. A window of two neighbouring completed blocks of `half` words (half = 1, 2, 4, ...) is a catcher:
it waits for its own words to come again as the suffix of the text, at a distance over half and up to 2 * half. When they do,
window and distance are a square, which opens a run of that period; each further word extends the open runs or closes them. A
suffix that no catcher of one level holds is held by none of a higher level, so for most words the comparison ends at once.

Every run of four periods or more is found: of its first words, a catcher of half < period <= 2 * half lies within 3 * half - 1, and
comes again one period later. Windows are told apart by a rolling hash modulo 2^61 - 1 and compared word by word where a
square is reported or a catcher replaced; on a collision the text starts again with another base, so the result is exact.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, keyed_texts

#: A run has so many words at least, and so many periods (fewer than 4 aren't all found).
MIN_WORDS, MIN_PERIODS = 6, 4
_PRIME = (1 << 61) - 1
#: Bytes of collapsed texts in one batch on the way back, about.
_BATCH_BYTES = 4_000_000

Run = tuple[int, int, int]


class _Collision(Exception):
    pass


class SquareCatcher:
    """Appends words (as integers below 2^32) and knows the runs so far."""

    def __init__(self, min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS, base: int = 0x1F0A9C3B5D7E2461):
        if min_periods < 4:
            raise ValueError("runs of fewer than 4 periods aren't all found")
        self.min_words, self.min_periods = min_words, min_periods
        self._begin(base)

    def _begin(self, base: int) -> None:
        self.base = base % _PRIME
        self.words: list[int] = []
        self.pairs: dict[int, int] = {}  # two words -> place of the second
        self.known = 0  # so many words up to the last one end a pair that came before
        self.prefix = [0]  # rolling hashes of the words' beginnings, as far as needed
        self.caught: list[dict[int, int]] = [{}, {}]  # by level: hash of a catcher -> place of its last word
        self.due = [0, 0]  # by level: place of the last word of the next catcher
        self.power = [self.base, self.base * self.base % _PRIME]  # base^(2^level)
        self.open: dict[int, int] = {}  # period -> start of the run that reaches the last word
        self.closed: list[Run] = []

    def extend(self, new: Iterable[int]) -> None:
        new = list(new)
        done = len(self.words)
        try:
            self._extend(new)
        except _Collision:
            words = self.words[:done] + new
            self._begin(self.base * 3 + 1)
            self.extend(words)

    def _extend(self, new: list[int]) -> None:
        words, pairs, opened, known = self.words, self.pairs, self.open, self.known
        before, e = words[-1] if words else -1, len(words)
        words += new
        for w in new:
            if opened:
                for q in [q for q in opened if words[e - q] != w]:
                    self._close(q, e)
            pair = before << 32 | w
            t = pairs.get(pair)
            pairs[pair] = e
            if t is None:
                known = 0
                if w == before:
                    opened[1] = e - 1
            else:
                known += 1
                if w == before and 1 not in opened:
                    opened[1] = e - 1
                if e - t == 2 and 2 not in opened:
                    self._report(2, 2, e)
                if known >= 3:  # a window of 4 words ends 3 such pairs at least
                    self._compare(e, known)
            before, e = w, e + 1
        self.known = known

    def _compare(self, e: int, known: int) -> None:
        """The suffix that ends at place e against the catchers of rising levels, until one holds none like it."""
        level, half, size, at = 2, 2, 4, e + 1
        prefix, power, caught, due, opened = self.prefix, self.power, self.caught, self.due, self.open
        if len(prefix) <= at:
            self._hash(at)
        h = prefix[at]
        while size - 1 <= known:
            if level == len(caught):
                caught.append({})
                due.append(size - 1)
                power.append(power[-1] * power[-1] % _PRIME)
            if due[level] < e - half:
                self._complete(level, half, size, e - half)
            t = caught[level].get((h - prefix[at - size] * power[level]) % _PRIME)
            if t is None:
                return
            if e - t <= size and e - t not in opened:
                self._report(e - t, size, e)
            level, half, size = level + 1, size, 2 * size

    def _complete(self, level: int, half: int, size: int, before: int) -> None:
        """Catchers of the blocks that were completed before some place."""
        caught, words, prefix, power = self.caught[level], self.words, self.prefix, self.power[level]
        for end in range(self.due[level], before, half):
            key = (prefix[end + 1] - prefix[end + 1 - size] * power) % _PRIME
            t = caught.get(key)
            if t is not None and words[t + 1 - size : t + 1] != words[end + 1 - size : end + 1]:
                raise _Collision
            caught[key] = end
        self.due[level] = end + half

    def _hash(self, at: int) -> None:
        """Hashes of the beginnings of `at` words and some more."""
        prefix, base = self.prefix, self.base
        h = prefix[-1]
        for w in self.words[len(prefix) - 1 : at + 64]:
            h = (h * base + w + 1) % _PRIME
            prefix.append(h)

    def _report(self, period: int, size: int, e: int) -> None:
        """The last `size` words came a period before, too: a square, unless a smaller period explains it."""
        words, start = self.words, e + 1 - size - period
        if words[start : start + size] != words[start + period : e + 1] or any(not period % q and s <= start for q, s in self.open.items()):
            return
        while start and words[start - 1] == words[start - 1 + period]:
            start -= 1
        self.open[period] = start

    def _close(self, period: int, end: int) -> None:
        start = self.open.pop(period)
        if end - start >= max(self.min_words, self.min_periods * period):
            self.closed.append((start, end - start, period))

    def runs(self) -> list[Run]:
        """(start, length, period) of all runs so far by start, then period; those that reach the last word included."""
        end, least = len(self.words), lambda n, q: n >= max(self.min_words, self.min_periods * q)
        return sorted(self.closed + [(s, end - s, q) for q, s in self.open.items() if least(end - s, q)], key=lambda r: (r[0], r[2]))


def runs_of(words: list) -> list[Run]:
    """Runs of a list of any hashable words."""
    names: dict = {}
    catcher = SquareCatcher()
    catcher.extend([names.setdefault(w, len(names)) for w in words])
    return catcher.runs()


def collapse(words: list, runs: list[Run]) -> list:
    """The words without those that any run holds after its first period."""
    if not runs:
        return words
    kept, at = [], 0
    for lo, hi in sorted((s + q, s + n) for s, n, q in runs):
        kept += words[at:lo] if lo > at else []
        at = max(at, hi)
    return kept + words[at:]


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", alter: Callable[[object, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """(doc_id, n_words, runs, collapsed), one row a row: runs as array<struct<start, length, period>> by start, then period, and
    the text without repeats, words joined by one space.

    Words are [^\\x20\\x09-\\x0D]+. `alter` may change a text's words first. Null and empty texts have no words, no runs and
    an empty collapsed text; repeated rows and null ids are kept as they are; other columns are ignored, whatever their names;
    an empty table gives an empty one. A text is read whole, in one task; nothing is shuffled.
    """
    texts = keyed_texts(docs, id_col, text_col)
    kind = texts.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, found, held = 0, [], 0
            for i in range(len(batch)):
                words = batch.column(1)[i].as_py().encode("utf-8", "surrogatepass").split()
                if alter:
                    words = alter(batch.column(0)[i].as_py(), words)
                runs = runs_of(words)
                text = b" ".join(collapse(words, runs)).decode("utf-8", "replace")
                found.append((len(words), [dict(zip(("start", "length", "period"), r, strict=True)) for r in runs], text))
                held += len(text)
                if held >= _BATCH_BYTES or i == len(batch) - 1:
                    counts, lists, texts_ = zip(*found, strict=True)
                    columns = [batch.column(0).slice(first, len(found)), pa.array(counts, pa.int64()), pa.array(lists, _RUNS), pa.array(texts_, pa.string())]
                    yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "runs", "collapsed"])
                    first, found, held = i + 1, [], 0

    return texts.mapInArrow(run, f"doc_id {kind}, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")


_RUNS = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))


def plant(doc_id: object, words: list[bytes]) -> list[bytes]:
    """In a tenth of the documents, by crc32 of the id, the words from some place on repeat with some period; none where the id is null."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(documents(spark, sf_dir), alter=plant)
    best = F.array_sort("runs", lambda a, b: F.when(a["length"] != b["length"], b["length"] - a["length"]).when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(a["period"] - b["period"]).cast("int"))
    top = F.when(F.size("runs") > 0, best[0])
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    rows = found.withColumns({"top": top, "lines": F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise("")})
    return rows.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        F.col("top.start").alias("start"),
        F.col("top.length").alias("length"),
        F.col("top.period").alias("period"),
        F.expr("1000 * top.length div top.period").alias("exponent_milli"),
        F.sha2(F.col("lines").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
