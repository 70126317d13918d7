"""Language-model scoring with a weighted backoff automaton of smoothed n-grams (unigrams and bigrams).

The model is as large as the corpus makes it, so it is never held in one place. Documents are dealt into chunks of bounded
size. Each chunk lists its n-grams with its own learning counts, as arrays by bucket of the n-gram's hash; each bucket adds
up the chunks' counts and sends each chunk the totals in the order it asked for. A chunk thus gets just the slice of the
automaton that its texts can reach, and one left-to-right traversal scores them.

Smoothing: P(w | h) = (c(h w) + MU P(w)) / (c(h) + MU), P(w) = (c(w) + 0.5) / (N + 0.5 (V + 1)); words not learned share one
place. A state is the last token (the root: none). A learned bigram is an arc of its state with weight log10 P(w | h); any
other word takes the failure arc to the root, weight log10(MU / (c(h) + MU)), and there the arc log10 P(w). A text starts in
the state of the end token, and the end counts as a token.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, remainder

MU = 300.0
#: UTF-8 bytes of text in a chunk, about.
CHUNK_BYTES = 8_000_000
_END = xxhash.xxh64_intdigest(b" end")  # no word holds a space


def _tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all texts, each text closed by the end token, and the number of tokens of each."""
    split = [x.encode("utf-8", "surrogatepass").lower().split() for x in texts]
    known = {w: xxhash.xxh64_intdigest(w) for w in {w for ws in split for w in ws}}
    sizes = np.array([len(ws) + 1 for ws in split], np.int64)
    out = np.full(int(sizes.sum()), _END, np.uint64)
    inner = np.ones(len(out), bool)
    inner[np.cumsum(sizes) - 1] = False
    out[inner] = np.fromiter((known[w] for ws in split for w in ws), np.uint64, int(inner.sum()))
    return out, sizes


def _bigrams(tokens: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each token with the one before it (the end token before the first), and that token before it."""
    before = np.concatenate([[np.uint64(_END)], tokens[:-1]])
    before[np.cumsum(sizes) - sizes] = _END
    h = before * np.uint64(0x9E3779B97F4A7C15) ^ ((tokens << np.uint64(31)) | (tokens >> np.uint64(33)))
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32)), before


def _packed(counts: np.ndarray, cuts: np.ndarray) -> dict[str, pa.Array]:
    """Counts of each run between cuts as one byte each (255: the next of `large`), for nearly all are small."""
    big, data = counts >= 255, pa.py_buffer(np.minimum(counts, 255).astype(np.uint8).tobytes())
    edges = np.concatenate([[0], np.cumsum(big)])[cuts]
    small = pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(cuts.astype(np.int32).tobytes()), data])
    return {"small": small, "large": pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(counts[big].astype(np.int64)))}


def _unpacked(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Counts of all rows one after the other, and how many each row has."""
    rows = table.column("small").to_pylist()
    counts = np.frombuffer(b"".join(rows), np.uint8).astype(np.int64)
    counts[counts == 255] = table.column("large").combine_chunks().flatten().to_numpy()
    return counts, np.array([len(x) for x in rows], np.int64)


class _Grams:
    """The n-grams of a chunk: sorted by bucket and hash, so that both passes over a chunk list them alike."""

    def __init__(self, texts: list[str], buckets: int):
        self.tokens, self.sizes = _tokens(texts)
        self.pairs, self.before = _bigrams(self.tokens, self.sizes)
        every = np.concatenate([self.tokens, self.pairs])
        self.keys, self.which = np.unique(every, return_inverse=True)
        bucket = (self.keys % np.uint64(buckets)).astype(np.int64)
        self.order = np.argsort(bucket, kind="stable")
        self.cuts = np.concatenate([[0], np.cumsum(np.bincount(bucket, minlength=buckets))])

    def learned(self, learn: np.ndarray) -> np.ndarray:
        weight = np.repeat(learn, self.sizes)
        return np.bincount(self.which, np.concatenate([weight, weight]), len(self.keys)).astype(np.int64)


class BackoffAutomaton:
    """Arc, failure and root weights of the states and words that a chunk can reach."""

    def __init__(self, word: np.ndarray, before: np.ndarray, pair: np.ndarray, n: int, v: int, mu: float):
        p = (word + 0.5) / (n + 0.5 * (v + 1))
        self.root = np.log10(p)
        self.failure = np.log10(mu / (before + mu))
        self.has_arc = pair > 0
        self.arc = np.log10((pair + mu * p) / (before + mu))

    def traverse(self) -> np.ndarray:
        """log10 probability of each token, read from left to right: the state is the token before."""
        return np.where(self.has_arc, self.arc, self.failure + self.root)


def learned_size(texts: DataFrame) -> tuple[int, int]:
    """N tokens and V distinct tokens of (text, learn) rows that are learned from."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, n = np.unique(_tokens(batch.column(0).to_pylist())[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], names=["h", "n"])

    counts = texts.filter("learn").select("text").mapInArrow(run, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n"))
    n, v = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    return n, v


def score_documents(docs: DataFrame, learn, id_col: str = "doc_id", text_col: str = "text", mu: float = MU, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:  # noqa: ANN001
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row; learn: a boolean column of docs.

    Null texts read as empty: just the end token. A null in learn means held out. Repeated rows count and are scored each
    time; other columns are ignored; an empty table gives an empty one, and with nothing to learn from all words are unknown.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.coalesce(learn, F.lit(False)).alias("learn"))
    n, v = learned_size(texts)
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = max(1, -(-size // chunk_bytes))
    dealt = texts.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks))).repartition("chunk")
    kind = texts.schema["doc_id"].dataType.simpleString()

    def ask(table: pa.Table) -> pa.Table:
        grams = _Grams(table.column("text").to_pylist(), chunks)
        counts, chunk = grams.learned(table.column("learn").to_numpy().astype(np.int64)), table.column("chunk")[0].as_py()
        full = np.flatnonzero(np.diff(grams.cuts))
        cuts = np.append(grams.cuts[full], grams.cuts[-1])
        keys = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(grams.keys[grams.order].view(np.int64)))
        return pa.table({"bucket": full, "chunk": np.full(len(full), chunk), "keys": keys} | _packed(counts[grams.order], cuts))

    def total(table: pa.Table) -> pa.Table:
        _, which = np.unique(table.column("keys").combine_chunks().flatten().to_numpy(), return_inverse=True)
        counts, sizes = _unpacked(table)
        sums = np.bincount(which, counts).astype(np.int64)[which]
        return pa.table({"chunk": table.column("chunk"), "bucket": table.column("bucket")} | _packed(sums, np.concatenate([[0], np.cumsum(sizes)])))

    def score(table: pa.Table, answers: pa.Table) -> pa.Table:
        grams = _Grams(table.column("text").to_pylist(), chunks)
        answers = answers.sort_by("bucket")
        totals = np.empty(len(grams.keys), np.int64)
        totals[grams.order] = _unpacked(answers)[0]
        k = len(grams.tokens)
        word, pair = totals[grams.which[:k]], totals[grams.which[k:]]
        at = np.searchsorted(grams.keys, grams.before)
        asked = grams.keys[np.minimum(at, len(grams.keys) - 1)] == grams.before
        machine = BackoffAutomaton(word, np.where(asked, totals[np.minimum(at, len(grams.keys) - 1)], 0), pair, n, v, mu)
        first = np.cumsum(grams.sizes) - grams.sizes
        add = lambda x: np.add.reduceat(x, first)
        return pa.table({"doc_id": table.column("doc_id"), "held_out": pa.array(~table.column("learn").to_numpy().astype(bool)), "n_tokens": grams.sizes, "n_known": add((word > 0).astype(np.int64)), "train_tokens": np.full(len(first), n), "base_score": add(machine.root), "score": add(machine.traverse())})

    asked = dealt.groupBy("chunk").applyInArrow(ask, "bucket bigint, chunk bigint, keys array<bigint>, small binary, large array<bigint>")
    answers = asked.groupBy("bucket").applyInArrow(total, "chunk bigint, bucket bigint, small binary, large array<bigint>")
    schema = f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(score, schema)


def op8_backoff_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(documents(spark, sf_dir), remainder("doc_id", 5) != 1)
