"""Line dedup with a log-template tree of fixed depth.

A line is parsed by its token count and its leading tokens: fields with digits are variable, and so is whatever follows the
leading tokens (8, or 60 % of a longer line). The path in the tree is the line's template. A template that occurs in many
documents is boilerplate: its lines are dropped, but for those of the document that has it first.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import documents, quoted
from .near_copies import linked, sketched

#: Leading tokens on the path, at least; their share of longer lines.
DEPTH, SHARE = 8, 0.6
#: Shorter lines (in tokens) are no templates.
MIN_TOKENS = 4
#: Documents that a template occurs in, from which it is dropped.
MIN_DOCS = 10
#: With groups of near copies given: lines of so many tokens recur, as whole lines, from two documents on that are no near copies.
LONG_TOKENS = 50
#: With groups given: documents that a line under MIN_TOKENS occurs in, as a whole line, from which it is dropped.
SHORT_DOCS = 20
#: Tasks that the lines of one template are dealt to.
SALTS = 16
_FIELD = re.compile(r"\S*\d\S*")
_DIGIT = re.compile(r"\d")


def template(line: str) -> int | None:
    """64-bit name of the line's path: token count, then leading tokens with variable fields generalised; None: too short."""
    if _DIGIT.search(line):
        line = _FIELD.sub("<*>", line)
    tokens = line.split()
    n = len(tokens)
    if n < MIN_TOKENS:
        return None
    lead = max(DEPTH, -int(-SHARE * n // 1))
    return xxhash.xxh64_intdigest(f"{n} {' '.join(tokens[:lead])}".encode("utf-8", "surrogatepass")) - (1 << 63)


def whole(line: str) -> tuple[int, bool] | None:
    """64-bit name of a whole long (True) or short line; None: neither, or blank."""
    tokens = line.split()
    n = len(tokens)
    if not n or MIN_TOKENS <= n < LONG_TOKENS:
        return None
    return xxhash.xxh64_intdigest(f"whole {' '.join(tokens)}".encode("utf-8", "surrogatepass")) - (1 << 63), n >= LONG_TOKENS


def _named_lines(texts: DataFrame, names: Callable[[str], tuple | None], fields: str) -> DataFrame:
    """The columns of texts but the last, which is cut into lines, and the distinct names of the lines as further columns."""
    own = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in texts.schema.fields[:-1])
    columns, kinds = [f.split()[0] for f in fields.split(", ")], [pa.int64(), pa.bool_()]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, found = [], []
            for i, x in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                some = {w for line in x.split("\n") if (w := names(line)) is not None}
                at += [i] * len(some)
                found += some
            at = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([*(c.take(at) for c in batch.columns[:-1]), *(pa.array([w[j] for w in found], kinds[j]) for j in range(len(columns)))], names=[*batch.schema.names[:-1], *columns])

    return texts.mapInArrow(parse, f"{own}, {fields}")


def _salted(lines: DataFrame, often: DataFrame, key: str) -> DataFrame:
    """Join on key; the lines of one key meet its row in SALTS tasks, not in one."""
    every = often.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return lines.withColumn("salt", F.pmod("k", F.lit(SALTS)).cast("int")).join(every, [key, "salt"])


def _whole_lines(texts: DataFrame, nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """(k, l, names): names of the long and short lines that go from each document; texts: k, l, id, text; nodes: k, l, node."""
    lines = _named_lines(texts, whole, "line bigint, long boolean").join(nodes, ["k", "l"])
    lines = lines.join(roots, "node", "left").withColumn("group", F.coalesce("root", "node")).drop("node", "root")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "k", "l", "group"))
    per = lines.groupBy("line").agg(F.count(F.lit(1)).alias("n"), F.min("group").alias("a"), F.max("group").alias("b"), F.first("long").alias("long"), first.alias("first"))
    often = per.filter((F.col("long") & (F.col("a") != F.col("b"))) | (~F.col("long") & (F.col("n") >= SHORT_DOCS)))
    later = _salted(lines.drop("long"), often.select("line", "long", "first"), "line")
    later = later.filter(F.when(F.col("long"), F.col("group") != F.col("first.group")).otherwise((F.col("k") != F.col("first.k")) | (F.col("l") != F.col("first.l"))))
    return later.groupBy("k", "l").agg(F.collect_set("line").alias("names"))


def _keyed(docs: DataFrame, kept: list[str], id_col: str, text_col: str) -> DataFrame:
    """(row, id, text, k, l): the kept columns but the text as one struct, so that no name clashes; k and l name id and text."""
    rest, text = [F.col(quoted(c)) for c in kept if c != text_col], F.coalesce(F.col(quoted(text_col)), F.lit(""))
    own = F.col(quoted(id_col))
    return docs.select(F.struct(*rest).alias("row"), own.alias("id"), F.col(quoted(text_col)).alias("text"), F.xxhash64(own, text).alias("k"), F.xxhash64(F.lit(1), own, text).alias("l"))


def _without_templates(own: DataFrame, min_docs: int = MIN_DOCS, nodes: DataFrame | None = None, roots: DataFrame | None = None) -> DataFrame:
    """(row, text, n_lines, n_dropped) from what _keyed gives; nodes (k, l, node) and roots: near copies."""
    text, more = F.coalesce("text", F.lit("")), roots is not None
    lines = _named_lines(own.select("k", "l", "id", text.alias("text")), lambda line: None if (t := template(line)) is None else (t,), "template bigint")
    often = lines.groupBy("template").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(F.col("id").isNull().alias("none"), "id", "k", "l")).alias("first")).filter(F.col("n") >= min_docs)
    later = _salted(lines, often.select("template", F.col("first.k").alias("fk"), F.col("first.l").alias("fl")), "template").filter("k != fk or l != fl")
    dropped = later.groupBy("k", "l").agg(F.collect_set("template").alias("names"))
    if roots is not None:
        dropped = dropped.unionByName(_whole_lines(own.select("k", "l", "id", text.alias("text")), nodes, roots))
        dropped = dropped.groupBy("k", "l").agg(F.flatten(F.collect_list("names")).alias("names"))
    both = own.join(dropped, ["k", "l"], "left").select("row", "text", "names")

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, total, gone = [], [], []
            for x, names in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                rows = [] if x is None else x.split("\n")
                total.append(len(rows))
                if names:
                    names = set(names)
                    rows = [line for line in rows if template(line) not in names and not (more and (w := whole(line)) and w[0] in names)]
                    x = "\n".join(rows)
                gone.append(total[-1] - len(rows))
                texts.append(x)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(total, pa.int64()), pa.array(gone, pa.int64())], names=["row", "text", "n_lines", "n_dropped"])

    return both.mapInArrow(drop, StructType([own.schema["row"], own.schema["text"]]).add("n_lines", "long").add("n_dropped", "long"))


def drop_templates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS) -> DataFrame:
    """docs with the text left after dropping, and `n_lines` and `n_dropped`; existing columns of those names are replaced,
    all others stay as they are.

    Lines are cut at line ends; a document counts once for a template however often it has it, and documents with equal id
    and text are one. First is the smallest id (nulls last). Null texts stay null and have no lines; all rows stay, even
    with no line left; an empty table stays empty.
    """
    kept = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    done = _without_templates(_keyed(docs, kept, id_col, text_col), min_docs)
    return done.select(*(F.col("text").alias(c) if c == text_col else F.col(f"row.{quoted(c)}").alias(c) for c in kept), "n_lines", "n_dropped")


def drop_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without lines of recurring templates (see drop_templates), and without whole short and long lines that recur.

    A long line recurs if two documents have it that are no near copies of each other; it stays in all near copies of its first
    document and goes from the others, so that near copies stay alike. Nulls, ties, repeated rows, clashing names and
    empty tables: as in drop_templates.
    """
    own = _keyed(docs, docs.columns, id_col, text_col)
    texts = own.select(F.col("k").alias("h"), "l", "id", F.coalesce("text", F.lit("")).alias("text"))
    sketch = sketched(texts)
    nodes = sketch.select(F.col("h").alias("k"), "l", "node").distinct()
    done = _without_templates(own, nodes=nodes, roots=linked(sketch, texts))
    return done.select(*(F.col("text").alias(c) if c == text_col else F.col(f"row.{quoted(c)}").alias(c) for c in docs.columns))


def op5_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_templates(documents(spark, sf_dir).select("doc_id", "text")).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))
