"""Edit-aware token counts: a segment tree over the pre-token leaves of each document, kept as a table.

Leaves start where no pre-token reaches across (a blank, tab or line end between two other characters; a full stop, comma and
the like after a letter), so their counts add up. `build_trees` makes the table: the leaves of each document and their
counts. `apply_edits` takes it, or what an earlier `apply_edits` left, re-encodes only the leaves that an edit touches, and
neighbours as far as the change at a border takes that away, and updates the sums above them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .byte_bpe import ByteCodec, codec, default_ranks
from .common import documents

#: Characters of a leaf, about; a leaf of more than twice as many is cut again, if there is a place.
LEAF_CHARS = 400
_STOPS = ",.;:!?。，、！？；："
_START = regex.compile(rf"(?<=\S)(?=[ \t\n]\S)|(?<=\p{{L}})(?=[{_STOPS}])")
# fixed values: fields that the query's edits redact
REDACTIONS = ((r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "<EMAIL>"), (r"\b\d{1,3}(?:\.\d{1,3}){3}\b", "<IP>"), (r"\+?\d[\d ()-]{7,}\d", "<PHONE>"))


def cut_leaves(text: str, leaf_chars: int = LEAF_CHARS) -> list[str]:
    """The text in leaves of about that many characters; an empty text has none."""
    cuts = [0]
    while len(text) - cuts[-1] > leaf_chars and (m := _START.search(text, cuts[-1] + leaf_chars)):
        cuts.append(m.start())
    return [text[a:b] for a, b in zip(cuts, [*cuts[1:], len(text)], strict=True) if a < b]


class TokenTree:
    """Leaves of a document, with their characters and tokens summed in a segment tree. Leaves that edits emptied stay, as blanks."""

    def __init__(self, leaves: list[str], counts: list[int], tokens: ByteCodec, leaf_chars: int = LEAF_CHARS):
        self.tokens, self.leaf_chars, self.encoded_chars = tokens, leaf_chars, 0
        self._grow(leaves, counts)

    @classmethod
    def of(cls, text: str, tokens: ByteCodec, leaf_chars: int = LEAF_CHARS) -> TokenTree:
        leaves = cut_leaves(text, leaf_chars)
        return cls(leaves, [tokens.count(x) for x in leaves], tokens, leaf_chars)

    def _grow(self, leaves: list[str], counts: list[int]) -> None:
        self.leaves = leaves or [""]
        self.size = 1 << max(0, len(self.leaves) - 1).bit_length()
        blank = [0] * (self.size - len(self.leaves))
        self.chars, self.counts = [0] * self.size + [len(x) for x in self.leaves] + blank, [0] * self.size + (list(counts) or [0]) + blank
        for i in range(self.size - 1, 0, -1):
            self._sum(i)

    def _sum(self, i: int) -> None:
        self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
        self.counts[i] = self.counts[2 * i] + self.counts[2 * i + 1]

    @property
    def count(self) -> int:
        return self.counts[1]

    def text(self) -> str:
        return "".join(self.leaves)

    def kept(self) -> tuple[list[str], list[int]]:
        """Leaves with text, and their counts."""
        there = [i for i, x in enumerate(self.leaves) if x]
        return [self.leaves[i] for i in there], [self.counts[self.size + i] for i in there]

    def _find(self, at: int) -> tuple[int, int]:
        """Leaf that holds a character, and the place in it; past the end: the last leaf with text."""
        i = 1
        at = min(at, max(0, self.chars[1] - 1))
        while i < self.size:
            i *= 2
            if at >= self.chars[i] and self.chars[i + 1]:
                at -= self.chars[i]
                i += 1
        return i - self.size, at

    def _chars_before(self, leaf: int) -> int:
        i, total = self.size + leaf, 0
        while i > 1:
            if i & 1:
                total += self.chars[i - 1]
            i //= 2
        return total

    def edit(self, start: int, stop: int, new: str) -> None:
        """Replaces characters start to stop."""
        start, stop = max(0, min(start, self.chars[1])), max(0, min(max(start, stop), self.chars[1]))
        first, inner = self._find(start)
        inner += start - min(start, max(0, self.chars[1] - 1))
        last = max(first, self._find(max(start, stop - 1))[0])
        region = "".join(self.leaves[first : last + 1])
        region = region[:inner] + new + region[inner + stop - start :]
        while (at := self._chars_before(first)) and not self._clean(self.leaves[before := self._find(at - 1)[0]], region):
            region, first = self.leaves[before] + region, before
        while (at := self._chars_before(last) + self.chars[self.size + last]) < self.chars[1]:
            after = self._find(at)[0]
            right = self.leaves[after]
            if len(right) == 1 and at + 1 < self.chars[1]:
                right += self.leaves[self._find(at + 1)[0]][0]
            if self._clean(region, right):
                break
            region, last = region + self.leaves[after], after
        self.encoded_chars += len(region)
        pieces = cut_leaves(region, self.leaf_chars) if len(region) > 2 * self.leaf_chars else [region]
        counts = [self.tokens.count(x) for x in pieces]
        if len(pieces) > last - first + 1:
            old = self.counts[self.size : self.size + len(self.leaves)]
            leaves, counts = [*self.leaves[:first], *pieces, *self.leaves[last + 1 :]], [*old[:first], *counts, *old[last + 1 :]]
            there = [i for i, x in enumerate(leaves) if x]
            self._grow([leaves[i] for i in there], [counts[i] for i in there])
            return
        for i in range(first, last + 1):
            k = i - first
            self.leaves[i] = pieces[k] if k < len(pieces) else ""
            self.chars[self.size + i] = len(self.leaves[i])
            self.counts[self.size + i] = counts[k] if k < len(pieces) else 0
        low, high = (self.size + first) // 2, (self.size + last) // 2
        while low:
            for i in range(low, high + 1):
                self._sum(i)
            low, high = low // 2, high // 2

    @staticmethod
    def _clean(left: str, right: str) -> bool:
        """Whether no pre-token reaches from left to right."""
        return not left or not right or (len(right) > 1 and right[0] in " \t\n" and not left[-1].isspace() and not right[1].isspace()) or (right[0] in _STOPS and left[-1].isalpha())


def redactions(text: str) -> list[tuple[int, int, str]]:
    """Edits that redact fields, last first, so that earlier places hold; of overlapping fields the first kind counts."""
    found: list[tuple[int, int, str]] = []
    for pattern, name in REDACTIONS:
        for m in re.finditer(pattern, text):
            if all(m.end() <= a or m.start() >= b for a, b, _ in found):
                found.append((m.start(), m.end(), name))
    return sorted(found, reverse=True)


_EDITS = "array<struct<start:int,stop:int,text:string>>"


def build_trees(docs: DataFrame, ranks_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", edits_col: str | None = None) -> DataFrame:
    """(doc_id, edits, leaves array<string>, tokens array<int>): the tree table, one row for every row of docs.

    Null texts read as empty and have no leaves; edits are handed on (null if no column is named); other columns are
    ignored; an empty table gives an empty one. Write it to keep it; `apply_edits` gives one of the same form.
    """
    edits = F.col(edits_col) if edits_col else F.lit(None)
    rows = docs.select(F.col(id_col).alias("doc_id"), edits.cast(_EDITS).alias("edits"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = codec(ranks_file, pattern)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                leaves = [cut_leaves(x.as_py()) for x in part.column(2)]
                counts = [[tokens.count(x) for x in own] for own in leaves]
                yield pa.RecordBatch.from_arrays([*part.columns[:2], pa.array(leaves, pa.list_(pa.string())), pa.array(counts, pa.list_(pa.int32()))], names=["doc_id", "edits", "leaves", "tokens"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, edits {_EDITS}, leaves array<string>, tokens array<int>")


def apply_edits(trees: DataFrame, ranks_file: str, pattern: str, redact: bool = False) -> DataFrame:
    """The tree table after the edits, and n_edits, n_tokens_before, n_tokens, n_chars_encoded (re-encoded by these edits).

    edits: array of (start, stop, text) in characters, applied one after the other, each in what the ones before left; redact:
    the redactions of the text instead. Places out of range are moved to the ends; null edits are none, and in an edit
    a null start is no edit, a null stop the start, a null text nothing. Edits are cleared in the result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(ranks_file, pattern)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part, out = batch.slice(lo, 256), []
                for given, leaves, counts in zip(*(part.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                    tree = TokenTree(leaves or [], counts or [], coder)
                    todo = redactions(tree.text()) if redact else [tuple(x.values()) for x in given or () if x and x["start"] is not None]
                    before = tree.count
                    for start, stop, new in todo:
                        tree.edit(start, start if stop is None else stop, new or "")
                    out.append((None, *tree.kept(), len(todo), before, tree.count, tree.encoded_chars))
                kinds = (part.schema.field(1).type, pa.list_(pa.string()), pa.list_(pa.int32()), *[pa.int64()] * 4)
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array([x[i] for x in out], k) for i, k in enumerate(kinds))], names=["doc_id", "edits", "leaves", "tokens", "n_edits", "n_tokens_before", "n_tokens", "n_chars_encoded"])

    own = trees.select("doc_id", "edits", "leaves", "tokens")
    return own.mapInArrow(run, f"doc_id {own.schema['doc_id'].dataType.simpleString()}, edits {_EDITS}, leaves array<string>, tokens array<int>, n_edits bigint, n_tokens_before bigint, n_tokens bigint, n_chars_encoded bigint")


def count_edited(docs: DataFrame, ranks_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", edits_col: str | None = None) -> DataFrame:
    """(doc_id, n_edits, n_tokens_before, n_tokens, n_chars_encoded, edited) of every row: trees that are built and edited at once."""
    done = apply_edits(build_trees(docs, ranks_file, pattern, id_col, text_col, edits_col), ranks_file, pattern, redact=edits_col is None)
    return done.select("doc_id", "n_edits", "n_tokens_before", "n_tokens", "n_chars_encoded", F.array_join("leaves", "").alias("edited"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_edited(documents(spark, sf_dir), *default_ranks()).drop("edited")
