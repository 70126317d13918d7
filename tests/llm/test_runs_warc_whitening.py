"""Periodic runs, WARC bundles and whitening against brute force, with awkward rows."""

import hashlib
import io
import random
import zlib

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from omicspark.llm import periodic_runs as pr
from omicspark.llm import warc, whitening


def brute_runs(words):
    """Maximal stretches by every period, kept where no smaller one holds."""
    names = {}
    w = np.array([names.setdefault(x, len(names)) for x in words], np.int64)
    found = {}
    for q in range(1, len(w) // 4 + 1):
        same = np.concatenate([[0], (w[q:] == w[:-q]).astype(np.int8), [0]])
        edge = np.flatnonzero(np.diff(same))
        for s, e in zip(edge[::2], edge[1::2], strict=True):
            if e - s + q >= max(6, 4 * q) and not any(q % p == 0 and p < q and a <= s and b >= e + q for p, a, b in found.values()):
                found[len(found)] = (q, s, e + q)
    return sorted(((int(s), int(e - s), q) for q, s, e in found.values()), key=lambda r: (r[0], r[2]))


def brute_collapse(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return [x for i, x in enumerate(words) if i not in gone]


def random_words(rng):
    n, k = rng.randrange(90), rng.choice([1, 2, 2, 3, 5])
    w = [rng.randrange(k) for _ in range(n)]
    for _ in range(rng.randrange(3) if n else 0):
        a, p = rng.randrange(n), rng.randrange(1, 20)
        for i in range(a + p, min(n, a + rng.randrange(n))):
            w[i] = w[i - p]
    return w


def test_runs_of_words_appended_at_once_or_one_by_one():
    rng = random.Random(3)
    for _ in range(3000):
        w = random_words(rng)
        want = brute_runs(w)
        one = pr.SquareCatcher()
        for x in w:
            one.extend([x])
        assert pr.runs_of(w) == want == one.runs()
        assert pr.collapse(w, want) == brute_collapse(w, want)


def test_runs_are_exact_when_hashes_collide(monkeypatch):
    monkeypatch.setattr(pr, "_PRIME", 2003)
    begun = []
    begin = pr.SquareCatcher._begin
    monkeypatch.setattr(pr.SquareCatcher, "_begin", lambda self, base: (begun.append(base), begin(self, base))[1])
    rng = random.Random(4)
    for i in range(1500):
        w = random_words(rng)
        assert pr.runs_of(w) == brute_runs(w)
    assert len(begun) > i + 1  # some did start again


def test_long_runs_take_linear_time():
    w = [i % 7 for i in range(200_000)] + list(range(7, 100)) + [1] * 50_000
    assert pr.runs_of(w) == [(0, 200_000, 7), (200_093, 50_000, 1)]


def test_fewer_periods_are_refused():
    with pytest.raises(ValueError):
        pr.SquareCatcher(min_periods=3)


def test_periodic_runs_of_awkward_rows(spark):
    texts = [None, "", " \t\n ", "one", "a " * 5, "a " * 6, "a\nb\t" * 3, "a b " * 4, "x " + "é 東 京 " * 5 + "y", "w " * 30_000, "a b " * 4, "\x1c " * 7]
    rows = [(i if i != 3 else None, x, "r", 1) for i, x in enumerate(texts)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, runs string, collapsed int").repartition(3)
    got = pr.periodic_runs(df).collect()
    assert len(got) == len(rows)
    for r in got:
        words = (texts[3 if r.doc_id is None else r.doc_id] or "").encode().split()
        runs = brute_runs(words) if len(words) < 1000 else [(0, len(words), 1)]
        assert (r.n_words, [tuple(x) for x in r.runs], r.collapsed) == (len(words), runs, b" ".join(brute_collapse(words, runs)).decode())
    assert pr.periodic_runs(df.limit(0)).collect() == []


def test_op11_on_documents(spark):
    d = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in pr.op11_periodic_runs(spark, d).collect()}
    docs = spark.read.parquet(f"{d}/documents.parquet").collect()
    assert len(got) == len(docs)
    for doc in docs:
        w = (doc.text or "").encode().split()
        h, n = zlib.crc32(str(doc.doc_id).encode()), len((doc.text or "").encode().split())
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        runs = brute_runs(w)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        r = got[doc.doc_id]
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == (len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2])
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{k},{q}\n" for s, k, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(b" ".join(brute_collapse(w, runs))).hexdigest()


PAGES = "page_id long, url string, html string, digest string, refers_to long, payload string"


@pytest.fixture(scope="module")
def pages(spark):
    big, umlaut = "<p>" + "x" * 1000, "ü" * 500
    rows = [
        (1, "http://a/1", big), (2, "http://a/2", big), (9, None, big), (9, "http://a/9", big), (None, "http://a/n", big),
        (3, "http://a/ü b\r\nX: y", umlaut), (4, "http://a/4", umlaut), (5, "http://a/5", "ü" * 499), (6, "http://a/6", "ü" * 499),
        (7, "", None), (8, "http://a/8", ""), (None, None, "WARC/1.1\r\n\r\n\r\n"), (10, "u", "y" * 3_000_000), (11, "u", "y" * 3_000_000), (12, "u", "\x00\r\n\r\n"),
    ]
    return spark.createDataFrame([(*r, "d", 5, "p") for r in rows], PAGES).repartition(3)


def brute_pages(rows):
    last = {}
    for r in rows:
        if r.page_id is not None:
            last[r.html] = max(r.page_id, last.get(r.html, r.page_id))
    out = []
    for r in rows:
        data = (r.html or "").encode()
        to = last.get(r.html) if len(data) >= 1000 else None
        to = None if to == r.page_id else to
        out.append((r.page_id, len(data), hashlib.sha1(data).hexdigest(), "response" if to is None else "revisit", to))
    return sorted(out, key=str)


def test_warc_round_trip(spark, pages, tmp_path):
    index = warc.write_warc(pages, f"{tmp_path}/a", frame_bytes=2000, bundle_bytes=300)
    rows = pages.collect()
    got = warc.read_warc(spark, f"{tmp_path}/a", payloads=True).collect()
    assert sorted(((r.id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == brute_pages(rows)
    urls = {r.page_id: r.url for r in rows if r.page_id not in (9, None)}
    assert all(r.url == urls[r.id] for r in got if r.id in urls and r.id != 3)
    assert next(r.url for r in got if r.id == 3) == "http://a/ü%20b%0D%0AX:%20y"
    assert {bytes(r.payload).decode() for r in got if r.payload is not None and r.record_type == "response"} == {r.html or "" for r in rows}
    # bundles are plain zstd files of WARC records, the seek table at their end is skipped by any reader
    found = 0
    for file in (tmp_path / "a" / "bundles").iterdir():
        data = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(file.read_bytes()), read_across_frames=True).read()
        found += sum(f["warc-type"] != "warcinfo" for _, _, f, _ in warc.parse_records(data))
        assert [f["warc-type"] for _, _, f, _ in warc.parse_records(data)][0] == "warcinfo"
    assert found == len(rows) == index.count()
    wanted = index.filter("id IN (3, 10, 2)").select("record_id")
    assert sorted((r.id, r.payload_bytes) for r in warc.read_warc(spark, f"{tmp_path}/a", wanted).collect()) == [(2, 1003), (3, 1000), (10, 3_000_000)]


def test_warc_index_points_into_frames(spark, pages, tmp_path):
    for r in warc.write_warc(pages, f"{tmp_path}/b", frame_bytes=5000).collect():
        bundle = warc.BundleReader(f"{tmp_path}/b/bundles/{r.bundle}")
        offset, length, fields, _ = next(warc.parse_records(bundle.frame(r.frame), r.offset))
        assert (offset, length, fields["warc-record-id"], fields["warc-type"]) == (r.offset, r.length, r.record_id, r.record_type)


def test_warc_damage_and_empty(spark, pages, tmp_path):
    assert warc.write_warc(pages.limit(0), f"{tmp_path}/c").collect() == [] and warc.read_warc(spark, f"{tmp_path}/c").collect() == []
    r = warc.write_warc(pages.filter("page_id = 1"), f"{tmp_path}/d").first()
    file = tmp_path / "d" / "bundles" / r.bundle
    data = bytearray(file.read_bytes())
    data[-20] ^= 1
    file.write_bytes(data)
    with pytest.raises(ValueError):
        warc.BundleReader(str(file)).frame(0)


def test_warc_hot_payloads_take_both_ways(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(warc, "HOT_SHARE", 0.1)
    rows = spark.range(400).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.when(F.col("id") % 3 == 0, "h" * 1500).otherwise(F.repeat((F.col("id") / 8).cast("int").cast("string"), 1200)).alias("html"))
    warc.write_warc(rows, f"{tmp_path}/e")
    got = warc.read_warc(spark, f"{tmp_path}/e").collect()
    assert sorted(((r.id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == brute_pages(rows.collect())


def test_op12_equals_its_sql(spark):
    import duckdb

    from omicspark.llm.queries import ORACLE_SQL

    d = "/root/testdata/sf0.001"
    db = duckdb.connect()
    db.execute(f"CREATE VIEW pages AS FROM '{d}/pages.parquet'")
    want = sorted(db.execute(ORACLE_SQL["op12_warc"]).fetchall())
    assert sorted(tuple(r) for r in warc.op12_warc(spark, d).collect()) == want


def brute_whitening(vectors, k=16):
    x = [tuple(int(np.floor(64 * float(c))) + 1_000_000 for c in v) for v in vectors]
    fit = np.array(sorted(set(x)), object)
    n, s = len(fit), fit.sum(0)
    y = (fit * n - s).astype(float) / n
    cov = y.T @ y / n
    values, parts = np.linalg.eigh(cov)
    values, parts = values[::-1], parts[:, ::-1]
    away = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s, strict=True)) for row in x]
    white = ((np.array(x, object) * n - s).astype(float) / n) @ parts / np.sqrt(np.maximum(values, 1e-300))
    return n, away, white[:, :k], values / np.trace(cov)


def test_whitening_of_awkward_rows(spark):
    rng = np.random.default_rng(5)
    good = [rng.normal(size=6).astype(np.float32).tolist() for _ in range(300)]
    good += good[:20] + [good[0]] * 200  # copies count once in the fit
    bad = [None, [], [1.0] * 5, [1.0, None, 1.0, 1.0, 1.0, 1.0], [float("nan")] * 6, [1.0, 1.0, float("inf"), 1.0, 1.0, 1.0], [1.0, 1.0, -float("inf"), 1.0, 1.0, 1.0]]
    rows = [(i, v, "n", 1.0) for i, v in enumerate(good)] + [(None, good[1], "n", 1.0)] + [(10_000 + i, v, "n", 1.0) for i, v in enumerate(bad)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, whitened string, x double").repartition(4)
    n, away, white, explained = brute_whitening(good)
    got = whitening.whiten(df).collect()
    assert len(got) == len(good) + 1 and {r.n for r in got} == {n}
    sign = None
    for r in got:
        i = 1 if r.id is None else r.id
        assert int(r.deviation) == away[i] and len(r.whitened) == 6
        sign = np.sign(np.array(r.whitened) * white[i]) if sign is None else sign
        assert np.allclose(r.whitened, sign * white[i], atol=1e-8)
        assert np.allclose(r.explained, explained, rtol=1e-9) and r.identity_error < 1e-10
    assert whitening.whiten(df.limit(0)).collect() == []
    alone = whitening.whiten(df.filter("vec_id = 0")).collect()
    assert [(r.n, int(r.deviation), r.whitened, r.explained, r.identity_error) for r in alone] == [(1, 0, [], [], None)]


def test_whitening_of_low_rank_and_huge_entries(spark):
    rows = [(i, [float(i), 2.0 * i, 3.0, 1e300 if i == 7 else -1e30 if i == 8 else 0.0]) for i in range(40)]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert all(len(r.whitened) == 2 and abs(sum(r.explained) - 1) < 1e-9 and r.identity_error < 1e-6 for r in got)
    x = [[64 * i, 128 * i, 192, (1 << 40) * ((i == 7) - (i == 8))] for i in range(40)]
    sums = [sum(c) for c in zip(*x, strict=True)]
    assert {r.id: int(r.deviation) for r in got} == {i: sum((40 * a - b) ** 2 for a, b in zip(v, sums, strict=True)) for i, v in enumerate(x)}


def test_small_eigenvalues_keep_their_digits():
    rng = np.random.default_rng(6)
    q, _ = np.linalg.qr(rng.normal(size=(12, 12)))
    values = 10.0 ** -np.arange(12)
    found, parts = whitening.one_sided_jacobi(whitening.pivoted_cholesky((q * values) @ q.T))
    assert np.allclose(found.astype(float), values, rtol=1e-4)
    assert np.allclose(np.abs((parts.astype(float) * q).sum(0)), 1, atol=1e-6)


def test_op13_on_embeddings(spark):
    d = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{d}/embeddings.parquet").collect()
    n, away, white, explained = brute_whitening([r.embedding for r in rows])
    got = {(r.vec_id, r.component): r for r in whitening.op13_whitening(spark, d).collect()}
    assert len(got) == 16 * len(rows)
    sign = [np.sign(got[rows[0].vec_id, c + 1].whitened * white[0, c]) for c in range(16)]
    for i, r in enumerate(rows):
        for c in range(16):
            g = got[r.vec_id, c + 1]
            assert g.n == n and g.deviation == away[i] and abs(g.whitened - sign[c] * white[i, c]) < 1e-8 and abs(g.explained - explained[c]) < 1e-10
