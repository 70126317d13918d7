"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

A text is cut where no piece of the vocabulary reaches across (before a space mark that follows another character, and around
line ends). The different segments of a chunk of an Arrow batch are encoded side by side: each row is a segment, and each
round takes from each row's agenda of adjacent symbol pairs the one of best score, the leftmost of equals. Long segments
and those with characters outside the vocabulary use a heap. The sentencepiece library then encodes every whole text of the
chunk, and a difference stops the job.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from .common import documents, keyed_texts, quoted, spare

MARK = "▁"
#: Longer segments use a heap.
SHORT = 48
#: Characters and texts encoded together at most; a single longer text is a chunk of its own.
CHUNK = 1_000_000
NONE = np.int32(1 << 30)


def _gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of all the runs start, start + 1, ..., one after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)


class PieceCodec:
    """Encodes and decodes with a BPE model file; identity normalisation with a dummy prefix, and byte fallback if it has it."""

    def __init__(self, model_file: str, check: bool = True):
        import sentencepiece

        self.library = lib = sentencepiece.SentencePieceProcessor(model_file=model_file)
        n, self.check = lib.get_piece_size(), check
        self.pieces = [lib.id_to_piece(i) for i in range(n)]
        special = [lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i) for i in range(n)]
        self.byte_ids = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if lib.is_byte(i)}
        self.scores = {p: (lib.get_score(i), i) for i, p in enumerate(self.pieces) if not special[i] and not lib.is_byte(i)}
        order = {x: r for r, x in enumerate(sorted({-x for x, _ in self.scores.values()}))}
        self.ranks = {p: order[-x] for p, (x, _) in self.scores.items()}
        self.unknown = lib.unk_id()
        if any(MARK in p.lstrip(MARK) for p in self.scores):
            raise ValueError("a piece has a space mark inside: segments can't be encoded alone")
        if lib.encode(" a", out_type=str) == lib.encode("a", out_type=str) or lib.decode(lib.encode("a  b")) != "a  b":
            raise ValueError("the model's normalisation isn't the identity with a dummy prefix")
        self.raw = [b"" if special[i] else p.replace(MARK, " ").encode() for i, p in enumerate(self.pieces)]
        for value, i in self.byte_ids.items():
            self.raw[i] = bytes([value])
        self.raw[self.unknown] = " ⁇ ".encode()
        # no piece holds a line end, so a line end is a segment too
        self.ends = not any("\n" in p for p in self.scores)
        ends = "\n" if self.ends else ""
        self.segments = re.compile(f"{MARK}*[^{MARK}{ends}]+|{MARK}+" + f"|{ends}" * self.ends)
        self.multiplier = np.random.default_rng(7).integers(1, 1 << 63, SHORT + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self._tables()

    def _tables(self) -> None:
        """Symbols of characters, and rank and outcome of every pair of symbols that makes a piece."""
        symbols = {p: i for p, (_, i) in self.scores.items()}
        for c in sorted({c for p in self.scores for c in p}):
            symbols.setdefault(c, len(self.pieces) + len(symbols))
        self.symbol = np.full(0x110000, -1, np.int32)
        for p, i in symbols.items():
            if len(p) == 1 and i < len(self.pieces):
                self.symbol[ord(p)] = i
        pairs = {(symbols[p[:k]] << 32) | symbols[p[k:]]: (self.ranks[p], i) for p, (_, i) in self.scores.items() for k in range(1, len(p)) if p[:k] in symbols and p[k:] in symbols}
        self.pair = np.array(sorted(pairs), np.int64)
        self.pair_rank = np.array([pairs[k][0] for k in self.pair.tolist()], np.int32)
        self.pair_id = np.array([pairs[k][1] for k in self.pair.tolist()], np.int32)
        for name, made in (("digits", [f"{i},".encode() for i in range(len(self.pieces))]), ("bytes", self.raw)):
            size = np.array([len(x) for x in made], np.int64)
            setattr(self, name, (np.frombuffer(b"".join(made), np.uint8), np.cumsum(size) - size, size))

    def _look(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = (a.astype(np.int64) << 32) | np.maximum(b, 0)
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        ok = (self.pair[at] == key) & (a >= 0) & (b >= 0)
        return np.where(ok, self.pair_rank[at], NONE), np.where(ok, self.pair_id[at], -1)

    def merge_rows(self, rows: np.ndarray) -> np.ndarray:
        """Symbols of equally long segments, one a row, merged to the end; rows are filled up with -1."""
        n, width = rows.shape
        out, live, s = np.full((n, width), -1, np.int32), np.arange(n), rows
        if width > 1:
            rank, made = (x.reshape(n, width - 1) for x in self._look(s[:, :-1].ravel(), s[:, 1:].ravel()))
        while width > 1 and len(live):
            at = rank.argmin(axis=1)
            me = np.arange(len(live))
            done = rank[me, at] == NONE
            if done.any():
                out[live[done], : s.shape[1]] = s[done]
                go = ~done
                live, s, rank, made, at = live[go], s[go], rank[go], made[go], at[go]
                me = np.arange(len(live))
                if not len(live):
                    break
            s[me, at] = made[me, at]
            if s.shape[1] == 2:
                s = s[:, :1]
                break
            later = np.arange(s.shape[1] - 1)
            s = np.take_along_axis(s, later + (later > at[:, None]), 1)
            later = later[:-1]
            shift = later + (later >= at[:, None])
            rank, made = np.take_along_axis(rank, shift, 1), np.take_along_axis(made, shift, 1)
            for side, ok in ((at, at < s.shape[1] - 1), (at - 1, at > 0)):
                i, j = me[ok], side[ok]
                rank[i, j], made[i, j] = self._look(s[i, j], s[i, j + 1])
        if len(live):
            out[live, : s.shape[1]] = s
        return out

    def merge(self, segment: str) -> list[int]:
        """Ids of one segment of any length."""
        text = list(segment)
        self._merge_long(text)
        ids: list[int] = []
        for symbol in filter(None, text):
            if symbol in self.scores:
                ids.append(self.scores[symbol][1])
            elif self.byte_ids:
                ids += [self.byte_ids[x] for x in symbol.encode("utf-8", "surrogatepass")]
            else:
                ids.append(self.unknown)
        return ids

    def _merge_long(self, text: list[str]) -> None:
        """Merges with a heap as agenda over linked symbols; merged ones are left empty."""
        rank = self.ranks.get
        left, right = list(range(-1, len(text) - 1)), [*range(1, len(text)), -1]
        agenda: list[tuple[int, int, int, int]] = []

        def propose(a: int, b: int) -> None:
            if a >= 0 and b >= 0 and (found := rank(text[a] + text[b])) is not None:
                heapq.heappush(agenda, (found, a, b, len(text[a]) + len(text[b])))

        for a in range(len(text) - 1):
            propose(a, a + 1)
        while agenda:
            _, a, b, size = heapq.heappop(agenda)
            if not text[a] or not text[b] or right[a] != b or len(text[a]) + len(text[b]) != size:
                continue  # one of the two has been merged with another symbol
            text[a] += text[b]
            text[b] = ""
            right[a] = right[b]
            if right[b] >= 0:
                left[right[b]] = a
            propose(left[a], a)
            propose(a, right[a])

    def split(self, text: str) -> list[str]:
        return self.segments.findall(MARK + text.replace(" ", MARK)) if text else []

    def verify(self, texts: list[str], ids: np.ndarray, ends: np.ndarray) -> None:
        """Every text whole against the library; ends: where each text ends among the ids."""
        lo = 0
        for text, theirs, hi in zip(texts, self.library.encode(texts, num_threads=1), ends.tolist(), strict=True):
            if not np.array_equal(ids[lo:hi], theirs):
                raise ValueError(f"the library encodes {text[:80]!r} otherwise")
            lo = hi

    def encode_chunk(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and where each text ends among them."""
        marked = [MARK + x.replace(" ", MARK) if x else "" for x in texts]
        line = "".join(marked)
        points = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32)
        if not len(points):
            return np.empty(0, np.int64), np.zeros(len(texts), np.int64)
        ends = np.cumsum([len(x) for x in marked])
        first = np.zeros(len(points), bool)
        first[[0, *ends[(ends > 0) & (ends < len(points))]]] = True
        mark = points == ord(MARK)
        first[1:] |= mark[1:] & ~mark[:-1]
        if self.ends:
            stop = points == 10
            first |= stop
            first[1:] |= stop[:-1]
        starts = np.flatnonzero(first)
        lengths = np.diff(np.append(starts, len(points)))
        symbols = self.symbol[points]
        odd = np.maximum.reduceat(symbols < 0, starts) | (lengths > SHORT)
        place = np.minimum(np.arange(len(points)) - np.repeat(starts, lengths), SHORT)
        mixed = np.add.reduceat((points.astype(np.uint64) + np.uint64(1)) * self.multiplier[place], starts) ^ (lengths.astype(np.uint64) << np.uint64(57))
        mixed[odd] = 0
        _, at, which = np.unique(mixed, return_index=True, return_inverse=True)
        alike = _gather(starts[at][which][~odd], lengths[~odd])
        if (lengths[at][which][~odd] != lengths[~odd]).any() or (points[alike] != points[np.repeat(~odd, lengths)]).any():
            raise ValueError("two segments share a hash")
        plain = at[~odd[at]]
        ids, sizes, begin = [], np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        total = 0
        for width in np.unique(lengths[plain]):
            own = plain[lengths[plain] == width]
            for lo in range(0, len(own), 1 << 14):
                part = own[lo : lo + (1 << 14)]
                made = self.merge_rows(symbols[starts[part][:, None] + np.arange(width)])
                kept = made >= 0
                sizes[part] = kept.sum(axis=1)
                begin[part] = total + np.cumsum(sizes[part]) - sizes[part]
                ids.append(made[kept])
                total += len(ids[-1])
        sizes[~odd], begin[~odd] = sizes[at][which][~odd], begin[at][which][~odd]
        for i in np.flatnonzero(odd):
            made = self.merge(line[starts[i] : starts[i] + lengths[i]])
            sizes[i], begin[i] = len(made), total
            ids.append(np.array(made, np.int32))
            total += len(made)
        flat = np.concatenate(ids)
        done = np.concatenate([[0], np.cumsum(sizes)])
        found, stop = flat[_gather(begin, sizes)].astype(np.int64), done[np.searchsorted(starts, ends)]
        if self.check:
            self.verify(texts, found, stop)
        return found, stop

    def encode(self, text: str) -> list[int]:
        return [i for s in self.split(text) for i in self.merge(s)]

    def decode(self, ids: list[int]) -> str:
        return b"".join(self.raw[i] for i in ids).decode("utf-8", "replace").removeprefix(" ")

    def outcomes(self, texts: list[str]) -> Iterator[tuple[np.ndarray, bytes, bytes]]:
        """For each text: ids, ids joined by commas, UTF-8 of the decoded text."""
        lo = size = 0
        for hi in range(1, len(texts) + 1):
            size += len(texts[hi - 1])
            if hi == len(texts) or size + len(texts[hi]) > CHUNK:
                ids, ends = self.encode_chunk(texts[lo:hi])
                made = []
                for table, begin, length in (self.digits, self.bytes):
                    own = length[ids]
                    made.append((table[_gather(begin[ids], own)].tobytes(), np.concatenate([[0], np.cumsum(own)])))
                (text, cut), (raw, edge) = made
                b = 0
                for e in ends.tolist():
                    yield ids[b:e], text[cut[b] : max(cut[b], cut[e] - 1)], raw[edge[b] : edge[e]].removeprefix(b" ").decode("utf-8", "replace").encode()
                    b = e
                lo, size = hi, 0


def slices(batch: pa.RecordBatch, at: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts have about CHUNK bytes, so that only so much is held as Python objects."""
    lo = size = 0
    for hi, n in enumerate(pc.fill_null(pc.binary_length(batch.column(at)), 0).to_pylist(), 1):
        size += n
        if size >= CHUNK or hi == batch.num_rows:
            yield batch.slice(lo, hi - lo)
            lo, size = hi, 0


_codecs: dict[str, PieceCodec] = {}


def _codec(model_file: str) -> PieceCodec:
    if model_file not in _codecs:
        _codecs[model_file] = PieceCodec(model_file)
    return _codecs[model_file]


def encode_pieces(docs: DataFrame, model_file: str, text_col: str = "text") -> DataFrame:
    """docs with `piece_ids` array<int> and `piece_text` (the decoded text); existing columns of those names are replaced.

    Null reads as empty; empty texts have no ids. Rows are encoded one by one; an empty table stays empty.
    """
    kept = [c for c in docs.columns if c not in ("piece_ids", "piece_text")]
    # the other columns travel as one struct, whatever their names
    rest = [F.col(quoted(c)) for c in kept if c != text_col]
    rows = docs.select(F.struct(*rest, F.lit(0).alias(spare(kept, "_none")[0])).alias("row"), F.col(quoted(text_col)).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model_file)
        for batch in batches:
            for part in slices(batch, 1):
                found = list(codec.outcomes([x or "" for x in part.column(1).to_pylist()]))
                ids = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *(len(x[0]) for x in found)]), pa.int32()), pa.array(np.concatenate([x[0] for x in found]).astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*part.columns, ids, pa.array([x[2].decode() for x in found], pa.string())], names=["row", "text", "piece_ids", "piece_text"])
        pa.default_memory_pool().release_unused()

    done = rows.mapInArrow(run, StructType([*rows.schema.fields, StructField("piece_ids", ArrayType(IntegerType())), StructField("piece_text", StringType())]))
    return done.select(*(F.col("text").alias(c) if c == text_col else F.col(f"row.{quoted(c)}").alias(c) for c in kept), "piece_ids", "piece_text")


def digest_pieces(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row: the digests of what encode_pieces gives, without moving it."""
    texts = keyed_texts(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model_file)
        for batch in batches:
            for part in slices(batch, 1):
                found = [(len(ids), hashlib.sha256(text).hexdigest(), hashlib.sha256(raw).hexdigest()) for ids, text, raw in codec.outcomes(part.column(1).to_pylist())]
                columns = [pa.array([x[i] for x in found], kind) for i, kind in enumerate((pa.int64(), pa.string(), pa.string()))]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        pa.default_memory_pool().release_unused()

    return texts.mapInArrow(run, f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_pieces(documents(spark, sf_dir), default_model())
