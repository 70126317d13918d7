"""The operators of the llm subpackage against brute force, with awkward rows: nulls, empty and long texts, ties, repeated
rows, empty tables, extra columns with clashing names."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from omicspark.llm import (
    backoff_lm,
    byte_bpe,
    components,
    decontaminate,
    line_templates,
    near_copies,
    packing,
    quality,
    repeats,
    sentencepieces,
    simhash,
    token_counts,
    toxicity,
)

SCHEMA = "doc_id long, text string, component_id string, score string, kept string, n_tokens string, lang string, source string, n_chars long"
WORDS = "the and of lamb stone river quick brown über naïve 東京 x1 99 e.g. — idiot".split()


def awkward_texts():
    rng = random.Random(11)
    base = [" ".join(rng.choice(WORDS) for _ in range(rng.randrange(3, 60))) for _ in range(12)]
    near = [base[0] + " tail", base[0].upper(), base[1].replace("the", "THE"), base[2] + "\n" + base[2] + "\n" + base[2]]
    long = " ".join(rng.choice(WORDS) + str(rng.randrange(9)) for _ in range(30_000))
    return [None, "", " \t\n", "one", "two words", *base, *near, base[3], base[3], long, "a" * 3000, "\x00\x0b odd\x85space   \U0001f642", "line\n\nline\n line\nline"]


@pytest.fixture(scope="module")
def rows():
    texts = awkward_texts()
    made = [(i if i != 7 else None, x, "c", "s", "k", "n", "en", "src0", len(x or "")) for i, x in enumerate(texts)]
    return [*made, made[9]]  # a row that is repeated as it stands


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def brute_fingerprint(text):
    import xxhash

    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not w:
        return 0
    s = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_classes(fps):
    root = list(range(len(fps)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(fps))]


def test_simhash(docs, rows, none):
    got = simhash.near_duplicates(docs).collect()
    assert sorted((str(r.doc_id), r.fingerprint) for r in got) == sorted((str(r[0]), f"{brute_fingerprint(r[1]):016x}") for r in rows)
    fps = [int(r.fingerprint, 16) for r in got]
    classes = brute_classes(fps)
    for r, c in zip(got, classes, strict=True):
        ids = [x.doc_id for x, k in zip(got, classes, strict=True) if k == c and x.doc_id is not None]
        assert r.component_id == (min(ids) if ids else None)
    assert simhash.near_duplicates(none).collect() == []


def test_simhash_buckets_of_any_size():
    rng = np.random.default_rng(5)
    key = np.uint64(0x1234_0000_5678_0003)  # block 0 or block 2 may be the one left out
    fps = {int(key)}
    while len(fps) < 300:
        x = int(key)
        for b in rng.choice(64, rng.integers(0, 5), replace=False):
            x ^= 1 << int(b)
        fps.add(x)
    own = np.array(sorted(x for x in fps if (((x ^ int(key)) & ~0xFFFF) & (2**64 - 1)).bit_count() <= 1), np.uint64)
    full = np.uint64(int(key) & ~0xFFFF | 1)
    assert (own ^ full & ~np.uint64(0xFFFF)).size > simhash.DIRECT
    root = simhash._large(int(full), own)
    expected = brute_classes([int(x) for x in own])
    assert len(set(zip(root.tolist(), expected, strict=True))) == len(set(root.tolist())) == len(set(expected))


def test_components(spark):
    rng = random.Random(2)
    pairs = [(rng.randrange(80), rng.randrange(80)) for _ in range(60)] + [(i, i + 1) for i in range(100, 160)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    root = {x: x for p in pairs for x in p}
    for _ in range(200):
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    assert got == {x: r for x, r in root.items() if any(x in p and p[0] != p[1] for p in pairs)}


def test_small_graphs_end_without_rounds(spark, monkeypatch):
    rng = random.Random(18)
    pairs = [(rng.randrange(-300, 300), rng.randrange(-300, 300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1500)] + [(7, 7)]
    df = spark.createDataFrame([*pairs, *pairs[:9]], "u long, v long").repartition(5)
    rounds = {(r.node, r.root) for r in components.components(df).collect()}
    assert {(r.node, r.root) for r in components.components(df, small=1000).collect()} == rounds
    assert {(r.node, r.root) for r in components.components(df, small=100).collect()} == rounds  # more edges than that
    assert components.components(df.limit(0), small=1000).collect() == []
    words = [f"w{i}" for i in range(900)]
    texts = [(i, " ".join(words[10 * i : 10 * i + 200])) for i in range(60)]  # each is like the next, far ones share nothing
    cuts, cut = [], components.cut
    monkeypatch.setattr(components, "cut", lambda df: cuts.append(1) or cut(df))
    assert [r.doc_id for r in near_copies.keep_one(spark.createDataFrame(texts, "doc_id long, text string")).collect()] == [0]
    assert len(cuts) <= 4


def test_keep_one(docs, none):
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(set(ids)) and 0 in ids
    assert simhash.keep_one(none).collect() == []


def five_word_jaccard(a, b):
    a, b = ({tuple(x[i : i + 5]) for i in range(len(x) - 4)} for x in (a.split(), b.split()))
    return len(a & b) / len(a | b)


def test_keep_one_drops_planted_near_copies(spark):
    rng = random.Random(12)
    words = [f"w{i}" for i in range(4000)]
    texts, copies = [], 0
    for k in range(120):
        base = [rng.choice(words) for _ in range(200)]
        texts.append((1000 * k, " ".join(base)))
        while True:  # a copy at 0.8 to 0.95
            near = list(base)
            for at in rng.sample(range(200), rng.randrange(1, 6)):
                near[at] = "changed" + str(rng.randrange(10**6))
            if 0.8 <= five_word_jaccard(texts[-1][1], " ".join(near)) <= 0.95:
                break
        texts.append((1000 * k + 1, " ".join(near)))
        copies += 1
        far = list(base)
        for at in range(0, 200, 12):  # unlike: under 0.8
            far[at] = f"far{k}x{at}"
        texts.append((1000 * k + 2, " ".join(far)))
    got = {r.doc_id for r in near_copies.keep_one(spark.createDataFrame(texts, "doc_id long, text string").repartition(3)).collect()}
    assert {i for i, _ in texts if i % 1000 != 1} <= got
    assert sum(i % 1000 == 1 for i in got) <= 0.02 * copies


def test_near_copies_meet_in_balls_of_simhash_blocks():
    rng, met, bits = np.random.default_rng(21), 0, []
    for k in range(1000):
        every = rng.integers(0, 1 << 64, 100, np.uint64)
        a, b = np.sort(every[:90]), np.sort(every[10:])  # Jaccard 0.8
        prints, leasts = (np.stack([f(a), f(b)]) for f in (near_copies.fingerprint, near_copies.least))
        if k < 20:  # the majority of each bit of the hashes, in words of 64
            h = near_copies._mix(near_copies._mix((a[:, None] ^ near_copies._FLIP[: near_copies.WORDS]) * near_copies._SPIN))
            want = [sum(1 << i for i in range(64) if sum(int(x) >> i & 1 for x in w) > 45) for w in h.T]
            assert prints[0].tolist() == want
        far = [int(x).bit_count() for x in prints[0] ^ prints[1]]
        bits.append(sum(far))
        whole = sum((int(x) ^ int(y)) << 64 * i for i, (x, y) in enumerate(prints.T))
        blocks = [(whole >> near_copies.WIDTH * i & (1 << near_copies.WIDTH) - 1).bit_count() for i in range(near_copies.BLOCKS)]
        near = any(d <= 2 and x == y for d, x, y in zip(blocks, *leasts, strict=True))
        keys = near_copies.balls(prints, leasts) >> 5
        assert keys.shape[1] == near_copies.BLOCKS * (near_copies.WIDTH + 1)
        assert bool(set(keys[0].tolist()) & set(keys[1].tolist())) == near
        met += near
    assert met >= 997 and max(bits) <= near_copies.FAR
    assert abs(np.mean(bits) / (64 * near_copies.WORDS) - math.acos(1.6 / 1.8) / math.pi) < 0.01


def test_members_of_large_buckets_by_fingerprint():
    rng = np.random.default_rng(22)
    prints = rng.integers(0, 1 << 64, (150, near_copies.WORDS), np.uint64)
    for i in range(1, 150, 2):  # each second one is near the one before
        prints[i] = prints[i - 1] ^ np.uint64(1 << i % 64)
    root = rng.integers(0, 5, 150)
    got = near_copies.between(root, prints, 1000)
    want = {(i, j) for i in range(150) for j in range(i) if root[i] != root[j] and sum(int(x).bit_count() for x in prints[i] ^ prints[j]) <= near_copies.FAR}
    assert sorted((max(p), min(p)) for p in zip(*(x.tolist() for x in got), strict=True)) == sorted(want) and len(want) > 40
    assert near_copies.between(root, prints, 40) is None


def test_near_copies_pass_on_no_pairs_of_buckets(spark, monkeypatch):
    rng = random.Random(31)
    base, texts = [f"b{i}" for i in range(200)], []
    for k in range(300):  # one group, in which nearly all pairs are near by fingerprint
        near = list(base)
        for at in rng.sample(range(200), 2):
            near[at] = f"x{k}y{at}"
        texts.append(" ".join(near))
    rows, cut = [], near_copies.cut
    monkeypatch.setattr(near_copies, "cut", lambda df: rows.append((df.columns, (own := cut(df)).count())) or own)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r.doc_id for r in near_copies.keep_one(df).collect()] == [0]
    pairs = [x for columns, x in rows if columns == ["u", "v"]]
    assert len(pairs) > 1 and max(pairs) < 5 * 300  # trees of the groups, not the pairs of every bucket


def test_trees_of_near_members():
    rng = np.random.default_rng(33)
    prints = rng.integers(0, 1 << 64, (90, near_copies.WORDS), np.uint64)
    for i in range(1, 90):  # chains of thirty: each is near the one before
        if i % 30:
            prints[i] = prints[i - 1] ^ np.uint64(0xFFFFF << i % 40)
    near = [(i, j) for i in range(90) for j in range(i) if sum(int(x).bit_count() for x in prints[i] ^ prints[j]) <= near_copies.FAR]
    u, v = near_copies.tree(prints)

    def parts(pairs):
        root = list(range(90))
        for i, j in pairs:
            root = [root[i] if r == root[j] else r for r in root]
        return {frozenset(i for i in range(90) if root[i] == r) for r in root}

    assert parts(near) == parts(zip(u.tolist(), v.tolist(), strict=True)) and len(u) == 90 - len(parts(near))


def test_near_copies_in_large_buckets(spark):
    rng = random.Random(13)
    base = [f"b{i}" for i in range(300)]
    texts = []
    for k in range(150):  # a large group, with members that are further from its least than 0.8
        near = list(base)
        for at in rng.sample(range(300), 5 if k % 3 else 9):
            near[at] = f"x{k}y{at}"
        texts.append(" ".join(near))
    for k in range(80):  # a common passage in texts that are unlike otherwise
        texts.append(" ".join(base[:150] + [f"p{k}q{i}" for i in range(90)]))
    sets = [near_copies.shingles(x) for x in texts]
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if five_word_jaccard(texts[i], texts[j]) >= 0.8:
                root = [root[i] if r == root[j] else r for r in root]
    own = near_copies.across(list(range(len(sets))), sets)
    found = list(range(len(texts)))
    for i, j in own:
        found = [found[i] if r == found[j] else r for r in found]
    assert len(set(zip(root, found, strict=True))) == len(set(root)) == len(set(found))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert near_copies.keep_one(df).count() == len(set(root))


def test_large_buckets_of_a_min_hash_move_a_text_once(spark, monkeypatch):
    rng = random.Random(23)
    base, texts = [f"b{i}" for i in range(200)], []
    for k in range(240):  # most are like a few others, and further from the rest than 0.8
        near = texts[rng.randrange(k)].split() if k % 2 else list(base)
        for at in rng.sample(range(200), 2 if k % 2 else 8):
            near[at] = f"x{k}y{at}"
        texts.append(" ".join(near))
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if root[i] != root[j] and five_word_jaccard(texts[i], texts[j]) >= 0.8:
                root = [root[i] if r == root[j] else r for r in root]
    assert 40 < len(set(root)) < 200
    rows, cut = [], near_copies.cut
    monkeypatch.setattr(near_copies, "cut", lambda df: rows.append((df.columns, (own := cut(df)).count())) or own)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert near_copies.keep_one(df).count() == len(set(root))
    most = max(x for columns, x in rows if columns == ["key", "node", "root"])
    assert 240 < most <= near_copies.BLOCKS * 240  # not once for each of a text's 180 buckets
    monkeypatch.setattr(near_copies, "TOGETHER", 100)  # more than that: bucket by bucket
    rows.clear()
    assert near_copies.keep_one(df).count() == len(set(root))
    assert max(x for columns, x in rows if columns == ["key", "node", "root"]) > near_copies.BLOCKS * 240
    got, sets = list(range(len(texts))), [near_copies.shingles(x) for x in texts]
    for i, j in near_copies.across(got, sets):
        got = [got[i] if r == got[j] else r for r in got]
    assert len(set(zip(root, got, strict=True))) == len(set(root)) == len(set(got))


def test_quality(docs, rows, none):
    q = {r.doc_id: r.quality for r in quality.score_quality(docs).collect()}
    for doc_id, text, *_ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        n = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        again = {i + j for i in range(len(w) - 2) for j in range(3) if n[tuple(w[i : i + 3])] > 1}
        lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        got = q[doc_id]
        assert (got.n_words, got.word_chars, got.n_repeat_words) == (len(w), sum(map(len, w)), len(again))
        assert got.n_symbols == sum(c in quality.SYMBOLS for c in text or "") and got.n_dup_lines == len(lines) - len(set(lines))
        assert got.base_failed == (len(w) < 50 or 100 * len(again) > 50 * len(w)) and not (got.kept and got.base_failed)
    assert quality.score_quality(none).collect() == []


def test_repeated_words_beyond_the_places_of_a_key(spark):
    df = spark.createDataFrame([("a b c d a b c " * 3,), ("x y",), ("p q r s",)], "text string")
    w = F.array_remove(F.split("text", " "), "")
    assert [r[0] for r in df.select(quality.let(w, quality.repeated_words)).collect()] == [21, 0, 0]


def brute_repeats(texts, length):
    n = Counter(x[i : i + length] for x in texts for i in range(len(x) - length + 1))
    for x in texts:
        gone = np.zeros(len(x) + 1, int)
        for i in range(len(x) - length + 1):
            if n[x[i : i + length]] > 1:
                gone[i : i + length] = 1
        rest = bytes(b for b, g in zip(x, gone, strict=False) if not g)
        yield len(x), len(x) - len(rest), int((np.diff(np.concatenate([[0], gone[:-1]])) == 1).sum()), hashlib.sha256(rest).hexdigest()


@pytest.mark.parametrize("hot", [10_000, 5])
def test_repeats(spark, docs, rows, none, hot):
    rng = random.Random(5)
    base = ["".join(rng.choice("ab") for _ in range(60)) for _ in range(5)]
    piece = lambda: rng.choice(base)[rng.randrange(20) : rng.randrange(30, 60)] if rng.random() < 0.8 else rng.choice("abc") * rng.randrange(30)
    texts = ["".join(piece() for _ in range(rng.randrange(8))) for _ in range(50)]
    texts += [texts[3], texts[4], "a" * 100, "ab" * 40, "", "é" * 30]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.remove_repeats(df, length=20, hot=hot, digest=True).collect()}
    assert got == dict(enumerate(brute_repeats([x.encode() for x in texts], 20)))
    if hot > 5:
        own = repeats.remove_repeats(docs).collect()
        expected = list(brute_repeats([(r[1] or "").encode() for r in rows], 400))
        assert sorted((r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in own) == sorted(expected)
        assert repeats.remove_repeats(none).collect() == []


def test_language_model(docs, rows, none):
    learn = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 1
    got = backoff_lm.score_documents(docs, learn, chunk_bytes=20_000).collect()
    token = lambda x: [*(x or "").encode().lower().split(), b" end"]
    u, b = Counter(), Counter()
    held = lambda i: i is None or zlib.crc32(str(i).encode()) % 5 == 1
    for i, x, *_ in rows:
        if not held(i):
            t = token(x)
            u.update(t)
            b.update(zip([b" end", *t], t, strict=False))
    n, v, mu = sum(u.values()), len(u), backoff_lm.MU
    expected = []
    for i, x, *_ in rows:
        t = token(x)
        p = [(u[w] + 0.5) / (n + 0.5 * (v + 1)) for w in t]
        s = sum(math.log10((b[h, w] + mu * q) / (u[h] + mu)) for h, w, q in zip([b" end", *t], t, p, strict=False))
        expected.append((str(i), held(i), len(t), sum(u[w] > 0 for w in t), n, round(sum(map(math.log10, p)), 6), round(s, 6)))
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in got) == sorted(expected)
    assert backoff_lm.score_documents(none, learn).collect() == []


def test_counts_beyond_a_byte():
    counts = np.array([0, 1, 254, 255, 256, 10**6, 3])
    import pyarrow as pa

    table = pa.table({"x": [1, 2]} | backoff_lm._packed(counts, np.array([0, 4, 7])))
    back, sizes = backoff_lm._unpacked(table)
    assert back.tolist() == counts.tolist() and sizes.tolist() == [4, 3]


@pytest.fixture(scope="module")
def pieces():
    return sentencepieces.PieceCodec(sentencepieces.default_model())


def test_pieces(docs, rows, none, pieces):
    got = sentencepieces.digest_pieces(docs, sentencepieces.default_model()).collect()
    expected = []
    for i, x, *_ in rows:
        ids = pieces.library.encode(x or "")
        expected.append((str(i), len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(pieces.library.decode(ids).encode()).hexdigest()))
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == sorted(expected)
    whole = sentencepieces.encode_pieces(docs, sentencepieces.default_model())
    assert whole.columns == [*docs.columns, "piece_ids", "piece_text"]
    assert all(list(r.piece_ids) == pieces.library.encode(r.text or "") for r in whole.collect())
    assert sentencepieces.digest_pieces(none, sentencepieces.default_model()).collect() == []


def test_pieces_of_random_text(pieces):
    rng = random.Random(8)
    for _ in range(60):
        text = "".join(rng.choice(["a", "the", " ", "  ", "\n", "é", "京", "\t", "▁", "ing", "<s>", "\U0001f642", "q" * 50]) for _ in range(rng.randrange(60)))
        ids, _, raw = next(iter(pieces.outcomes([text])))
        assert ids.tolist() == pieces.library.encode(text) == pieces.encode(text)
        assert raw.decode() == pieces.library.decode(ids.tolist()) == pieces.decode(ids.tolist())


def test_pieces_are_all_held_against_the_library(monkeypatch):
    codec = sentencepieces.PieceCodec(sentencepieces.default_model())
    words = ["river", "house", "stone", "walking", "yellow", "seven", "paper", "morning", "q" * 50, "\U0001f642", "\n"]
    right = codec.merge_rows
    for k, word in enumerate(words):
        texts = ["", " ".join(words[:k]), f"{' '.join(words[:k])} {word} {' '.join(words[k:])}", ""]
        assert [x[0].tolist() for x in codec.outcomes(texts)] == [codec.library.encode(x) for x in texts]
        # one segment whose merges end one short: whichever it is, the job stops
        own = codec.symbol[np.frombuffer(f"▁{word}".encode("utf-32-le"), np.uint32)]
        wrong = lambda rows, own=own: np.where((rows == own).all(axis=1)[:, None], rows, right(rows)) if rows.shape[1] == len(own) else right(rows)
        with monkeypatch.context() as m:
            m.setattr(codec, "merge_rows", wrong)
            if word.isascii() and 1 < len(word) < sentencepieces.SHORT:
                with pytest.raises(ValueError, match="library"):
                    list(codec.outcomes(texts))


@pytest.fixture(scope="module")
def codec():
    return byte_bpe.ByteCodec(*byte_bpe.default_ranks())


def test_byte_codec(codec):
    for text in [x or "" for x in awkward_texts()] + ["a  b", " a", "a\n", "a\n\nb", "x\ny z's", "tab\tq", "a \nb"]:
        assert codec.encode(text) == codec.library.encode_ordinary(text)


def test_packing_is_lossless(docs, rows, none, codec):
    got = packing.pack(docs, *byte_bpe.default_ranks(), row_tokens=64, shard_tokens=500).collect()
    found = []
    for r in got:
        ids, places = np.frombuffer(r.ids, "<u2"), np.frombuffer(r.positions, "<u2")
        assert len(ids) == 64 and r.cu_seqlens[-1] == r.n_tokens <= 64 and (ids[r.n_tokens :] == packing.PAD).all()
        for d, p, a, b in zip(r.doc_ids, r.pieces, r.cu_seqlens, r.cu_seqlens[1:], strict=False):
            assert places[a:b].tolist() == list(range(b - a))
            found.append((str(d), p, ids[a:b].tolist()))
    expected = []
    for i, x, *_ in rows:
        ids = codec.library.encode_ordinary(x or "")
        expected += [(str(i), k, ids[lo : lo + 64]) for k, lo in enumerate(range(0, max(1, len(ids)), 64))]
    assert sorted(found) == sorted(expected)
    assert packing.pack(none, *byte_bpe.default_ranks()).collect() == []


def test_best_fit_takes_the_tightest_row():
    rng = random.Random(3)
    sizes = [rng.randrange(0, 40) for _ in range(200)]
    rows = packing.best_fit_decreasing(sizes, 40)
    left: list[int] = []
    for s in sorted(sizes, reverse=True):  # plain best fit opens as many rows
        fits = [c for c in left if c >= s]
        if fits:
            left[left.index(min(fits))] -= s
        else:
            left.append(40 - s)
    assert sorted(i for r in rows for i in r) == list(range(200)) and len(rows) == len(left)


def test_token_tree(codec):
    rng = random.Random(1)
    for _ in range(80):
        text = "".join(rng.choice(["a", "bc ", " ", "\n", "the ", "  x", " word", "é", "'s ", "東京。", "\t9", ", "]) for _ in range(rng.randrange(120)))
        tree = token_counts.TokenTree.of(text, codec, leaf_chars=6)
        for _ in range(12):
            a = rng.randrange(len(text) + 2)
            b, new = a + rng.choice([0, 0, 1, 3, 20]), rng.choice(["", " ", "x", "\n", " yy zz ", "'s", "。", " a b c d e f g h i j k l m n o p"])
            text = text[: min(a, len(text))] + new + text[min(b, len(text)) :]
            tree.edit(a, b, new)
            assert tree.text() == text and tree.count == codec.count(text)
            tree = token_counts.TokenTree(*tree.kept(), codec, leaf_chars=6) if rng.random() < 0.2 else tree


def test_edits_touch_only_their_leaves(codec):
    text = "a word and another, " * 5000
    tree = token_counts.TokenTree.of(text, codec)
    for _ in range(400):  # at one place: leaves that grow are cut again
        tree.edit(50_000, 50_000, " more words, ")
    assert tree.count == codec.count(tree.text()) and max(map(len, tree.leaves)) <= 2 * token_counts.LEAF_CHARS + 100
    assert tree.encoded_chars < 400 * 3 * token_counts.LEAF_CHARS


def test_trees_are_kept(spark, codec, tmp_path):
    files = byte_bpe.default_ranks()
    df = spark.createDataFrame([(1, "one two three. " * 300, [(0, 3, "uno")]), (2, None, None)], "doc_id long, text string, e array<struct<start:int,stop:int,text:string>>")
    token_counts.build_trees(df, *files, edits_col="e").write.parquet(str(tmp_path / "trees"))
    once = token_counts.apply_edits(spark.read.parquet(str(tmp_path / "trees")), *files)
    assert {r.doc_id: r.n_chars_encoded < 1000 for r in once.collect()} == {1: True, 2: True}
    again = once.withColumn("edits", F.expr("transform(array(4), x -> named_struct('start', x, 'stop', x + 3, 'text', 'dos'))"))
    out = {r.doc_id: r for r in token_counts.apply_edits(again, *files).collect()}
    assert "".join(out[1].leaves).startswith("uno dos three. one two") and out[1].n_tokens == codec.count("".join(out[1].leaves)) and "".join(out[2].leaves) == "dos"


def test_token_counts(spark, docs, rows, none, codec):
    got = token_counts.count_edited(docs, *byte_bpe.default_ranks()).collect()
    assert sorted((str(r.doc_id), r.n_tokens_before) for r in got) == sorted((str(i), codec.count(x or "")) for i, x, *_ in rows)
    df = spark.createDataFrame([(1, "mail a.b@c.org from 10.0.0.1 now", [(0, 4, "post"), (99, 120, "!")]), (2, None, None)], "doc_id long, text string, e array<struct<start:int,stop:int,text:string>>")
    own = {r.doc_id: r for r in token_counts.count_edited(df, *byte_bpe.default_ranks(), edits_col="e").collect()}
    assert own[1].edited == "post a.b@c.org from 10.0.0.1 now!" and own[1].n_tokens == codec.count(own[1].edited) and own[2].n_edits == 0
    red = token_counts.count_edited(df, *byte_bpe.default_ranks()).filter("doc_id = 1").first()
    assert red.edited == "mail <EMAIL> from <IP> now" and red.n_edits == 2
    assert token_counts.count_edited(none, *byte_bpe.default_ranks()).collect() == []


def test_line_templates(spark, none):
    rows = [(i, f"User {i} logged in from host\nown words of document number one {'xyz'[i % 3]}{i}\nshort line\n") for i in range(12)]
    rows += [(99, None), (98, ""), (0, rows[0][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_lines", F.lit("clash")).select("*", *(F.lit(c).alias(c) for c in ("k", "l", "_k", "_l", "_drop", "row", "id", "a.b")))
    got = line_templates.drop_templates(df, min_docs=10).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id in (98, 99):
            assert r.text == dict(rows[12:14])[r.doc_id] and r.n_dropped == 0
        else:
            assert ("logged in" in r.text) == (r.doc_id == 0) and "short line" in r.text
        assert all(r[c] == c for c in ("k", "l", "_k", "_l", "_drop", "row", "id", "a.b"))
    assert line_templates.drop_templates(none).collect() == []


def test_line_dedup_drops_whole_long_and_short_lines(spark):
    import corpus_pipeline as cp

    rng = random.Random(14)
    own = lambda n: " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(n))
    shared, body = " ".join(f"s{'abcdefgh'[i % 8]}{'xyz' * (i % 7)}" for i in range(60)), own(80)
    rows = [(i, f"{own(60)}\n{shared}\nAll rights reserved.\nFew of us\n{own(60)}" if i < 3 else f"{own(60)}\nAll rights reserved.\n\n{own(30)}" + ("\nFew of us" if i < 9 else "")) for i in range(25)]
    rows += [(30, f"{body}\n{own(3)}\n{body[::-1]}"), (31, f"{body}\n{own(3)}\n{body[::-1]}")]  # near copies, for the next stage
    df = spark.createDataFrame([(i, x, len(x)) for i, x in rows], "doc_id long, text string, n_chars long").repartition(3)
    got = {r.doc_id: r.text for r in cp.line_dedup(spark, df, "").collect()}
    assert len(got) == len(rows) and [i for i, x in got.items() if shared in x] == [0]
    assert [i for i, x in got.items() if "All rights reserved." in x] == [0]
    assert sum("Few of us" in x for x in got.values()) == 9 and all(got[i].count("\n\n") for i in range(3, 25))
    assert body in got[30] and body in got[31]


def test_pipeline_tells_rows_apart_by_text(spark, tmp_path):
    import corpus_pipeline as cp

    rng = random.Random(15)
    own = lambda: " ".join("q" + str(rng.randrange(10**6)) for _ in range(80))
    texts = [own() for _ in range(8)]
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[2]), (5, texts[3]), (5, texts[4]), (1, texts[4]), (5, texts[5]), (None, texts[5]), (6, texts[6]), (6, texts[6])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = sorted((str(r.doc_id), r.text) for r in near_copies.keep_one(df).collect())
    assert kept == sorted([("None", texts[0]), ("None", texts[1]), ("None", texts[2]), ("5", texts[3]), ("1", texts[4]), ("5", texts[5]), ("6", texts[6])])
    spark.createDataFrame([(1, texts[1][:200]), (2, texts[4][:200])], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    clean = sorted((str(r.doc_id), r.text) for r in cp.decontaminate(spark, df, str(tmp_path)).collect())
    assert clean == sorted((str(i), x) for i, x in rows if x not in (texts[1], texts[4]))


def test_decontamination(spark, docs, none):
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 8))) for _ in range(300)]
    items = [(k, " ".join(rng.choice(words) for _ in range(30))) for k in range(15)] + [(90, None), (91, "tiny"), (0, "x" * 40)]
    texts, expected = [], set()
    for k, x in items[:15]:
        y = list(x)
        for _ in range(int(len(x) * decontaminate.EDIT_RATE)):
            p = rng.randrange(len(y))
            y[p : p + 1] = rng.choice([[], ["Q"], [y[p], "z"]])
        texts.append((k, " ".join(rng.choice(words) for _ in range(50)) + " \n " + "".join(y).upper() + " end"))
        expected.add((k, k))
    texts += [(50, " ".join(rng.choice(words) for _ in range(400))), (51, None), (52, ""), (53, items[3][1])]
    expected.add((53, 3))
    df = spark.createDataFrame(texts, "doc_id long, text string").withColumn("item_id", F.lit("clash"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.find_benchmark(df, bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == expected
    assert all(r.distance <= len(dict(items[:15])[r.item_id]) * decontaminate.EDIT_RATE for r in got)
    assert decontaminate.find_benchmark(docs, bench.limit(0)).collect() == [] == decontaminate.find_benchmark(none, bench).collect()


def test_decontamination_with_a_long_item_beside_short_ones(spark):
    rng = random.Random(16)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 8))) for _ in range(2000)]
    some = lambda n: " ".join(rng.choice(words) for _ in range(n * 2))[:n].strip()
    items = [(k, some(100)) for k in range(40)] + [(99, some(20_000))]
    texts = [(k, f"{some(70)} {items[k % 40][1] if k % 3 == 0 else some(100)} {some(rng.randrange(60, 120))}") for k in range(300)] + [(500, some(100) + items[40][1] + some(50))]
    df, bench = (spark.createDataFrame(x, f"{c} long, text string") for x, c in ((texts, "doc_id"), (items, "item_id")))
    got = {(r.doc_id, r.item_id) for r in decontaminate.find_benchmark(df.coalesce(1), bench).collect()}
    assert got == {(k, k % 40) for k in range(0, 300, 3)} | {(500, 99)}


def plain_distances(a, b):
    d = [0] * (len(b) + 1)
    for i in range(1, len(a) + 1):
        new = [i]
        for j in range(1, len(b) + 1):
            new.append(min(new[j - 1] + 1, d[j] + 1, d[j - 1] + (a[i - 1] != b[j - 1])))
        d = new
    return d


def test_alignment_matches_the_plain_recurrence():
    rng = random.Random(4)
    for _ in range(200):
        a, b = (bytes(rng.choice(b"ab") for _ in range(rng.randrange(1, n))) for n in (12, 30))
        distance, start, stop = decontaminate.align(a, b, len(a))
        assert distance == min(plain_distances(a, b)) == plain_distances(a, b[start:stop])[-1]
        e = rng.randrange(3)  # within a band: as good if the diagonals that the alignment touches are in it
        inner = decontaminate.align(a, b, len(a), start - distance - e, start + distance + e)
        assert inner[0] == distance


@pytest.mark.parametrize("slice_bytes", [decontaminate.SLICE_BYTES, 3000])
def test_decontamination_against_all_alignments(spark, slice_bytes):
    rng = random.Random(18)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 8))) for _ in range(400)]
    some = lambda n: " ".join(rng.choice(words) for _ in range(n))[:n].strip()
    items = {k: some(n) for k, n in enumerate([32, 33, 40, 64, 100, 250, 700, 2000, 6000, 47])} | {20: "short item", 21: "zzz", 22: "two  Words "}

    def worn(x):
        y = list(x)
        for _ in range(rng.randrange(int(len(x) * 0.11) + 1)):
            p = rng.randrange(len(y))
            y[p : p + 1] = rng.choice([[], ["q"], [y[p], "z"]])
        return "".join(y)

    texts = [rng.choice(words) for _ in range(20)] + [f"{some(rng.randrange(4, 90))} {worn(items[rng.choice([0, 1, 2, 3, 4, 5, 6, 7, 9])])} {some(rng.randrange(4, 90))}" for _ in range(110)]
    texts += [items[9], worn(items[8]), "a short item.", "a short item b", "zzz", "zzzz", "TWO\nwords", ""]
    expected = set()
    for d, text in enumerate(texts):
        raw = decontaminate.normalise(text)
        for i, x in items.items():
            x = decontaminate.normalise(x)
            if len(x) < decontaminate.MIN_BYTES:
                hit = b" " + x + b" " in b" " + raw + b" "
            else:
                e = min(int(len(x) * decontaminate.EDIT_RATE), (len(x) - decontaminate.Q) // decontaminate.Q)
                hit = decontaminate.align(x, raw, e) is not None
            if hit:
                expected.add((d, i))
    df, bench = (spark.createDataFrame(list(x), f"{c} long, text string") for x, c in ((enumerate(texts), "doc_id"), (items.items(), "item_id")))
    got = decontaminate.find_benchmark(df.coalesce(1), bench, slice_bytes=slice_bytes).collect()
    assert {(r.doc_id, r.item_id) for r in got} == expected and len(expected) > 60
    assert not [r for r in decontaminate.find_benchmark(df, bench, min_bytes=32).collect() if r.item_id > 9]


def test_toxicity(spark, docs, none):
    rng = random.Random(6)
    plain = "the of and house river stone walk day night he she muslim christian".split()
    rows, labels = [], []
    for i in range(900):
        toxic = rng.random() < 0.3
        w = [rng.choice(plain) for _ in range(30)] + ([rng.choice(["vileword", "nastyword"])] if toxic else [])
        rng.shuffle(w)
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    labels += [(None, 1), (3, None), (10**6, 1)]
    df, lab = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit(df, lab)
    scored = toxicity.score_toxicity(df, model).collect()
    truth = dict(labels[:900])
    held = [r for r in scored if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert len(held) > 200 and sum(r.toxic_predicted == truth[r.doc_id] for r in held) / len(held) > 0.99
    out = toxicity.score_toxicity(docs, model).collect()
    assert len(out) == docs.count() and all(0 <= r.toxicity <= 1 for r in out)
    assert toxicity.score_toxicity(none, model).collect() == []
    assert toxicity.fit(df, lab.limit(0)).score("vileword") == 0.5


def test_counterfactual_penalty_evens_out_identity_terms():
    rng = np.random.default_rng(1)
    x = np.zeros((400, 3), np.float32)  # an insult, and two identity terms of which one goes along with the label by chance
    x[:, 0], x[:, 1] = rng.random(400) < 0.4, rng.random(400) < 0.5
    x[:, 2] = 1 - x[:, 1]
    y = ((x[:, 0] > 0) | ((x[:, 1] > 0) & (rng.random(400) < 0.5))).astype(np.float32)
    swaps = [(i, 1, 2) if x[i, 1] else (i, 2, 1) for i in range(400)]
    gap = lambda fairness: abs(np.subtract(*toxicity.fit_weights(x, y, swaps, fairness=fairness)[0][1:]))
    assert gap(20.0) < 0.5 * gap(0.0)


def test_identity_terms_are_even_after_fit(spark):
    rng = random.Random(17)
    plain = [f"{a}{b}" for a in ("stone", "river", "house", "walk") for b in ("ab", "cd", "ef", "gh", "ij")]
    group = toxicity.IDENTITY_GROUPS[0]
    rows, labels = [], []
    for i in range(1500):
        toxic = rng.random() < 0.4
        # by chance, one name goes along with the label in rows without an insult
        term = "muslim" if toxic and i % 2 else rng.choice([t for t in group if t != "muslim"]) if rng.random() < 0.5 else None
        w = [rng.choice(plain) for _ in range(15)] + (["vileword"] if toxic and not i % 2 else []) + ([term] if term else [])
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    model = toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert not any(w.startswith(t[:5]) and w.endswith("-") for t in group if len(t) >= 5 for w in model.weights)
    neutral = {t: model.score(f"the {t} family walked by the river") for t in group}
    assert max(neutral.values()) < toxicity.THRESHOLD  # though all labelled rows that hold it are toxic
    assert max(neutral.values()) - min(neutral.values()) < 0.05
    assert model.score("a vileword by the river") >= toxicity.THRESHOLD


def test_stages_take_awkward_rows(spark, docs, none):
    import corpus_pipeline as cp

    d = "/root/testdata/sf0.001"
    clash = ["k", "l", "_k", "_l", "_drop", "_key", "content", "rejected", "score", "row", "node", "keys", "own", "id", "h", "a.b", "Rejected_"]
    some = lambda df: df.drop("score").select("*", *(F.lit("mine").alias(c) for c in clash))
    rows = some(docs).count()
    for name, stage in cp.STAGES:
        out = stage(spark, some(docs), d)
        assert out.columns == [*some(docs).columns, *(["piece_ids", "piece_text"] if name == "encode" else [])]
        got = out.collect()
        assert all(r[c] == "mine" for r in got for c in clash)
        if name in ("line_dedup", "decontaminate", "encode"):  # no line recurs that often, and no row holds an item
            assert len(got) == rows
        if name == "near_dedup":
            assert sum(r.text is None or not r.text.strip() for r in got) == 1 and len({r.text for r in got}) == len(got)
        assert stage(spark, some(none), d).collect() == []


def test_pipeline(spark, tmp_path):
    import corpus_pipeline as cp

    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    before = docs.count()
    for name, stage in cp.STAGES:
        out = stage(spark, docs, d)
        if name != cp.STAGES[-1][0]:
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    assert 0 < docs.count() < before and {"piece_ids", "piece_text"} <= set(docs.columns)
    assert sorted(r.doc_id for r in cp.run(spark, d).select("doc_id").collect()) == sorted(r.doc_id for r in docs.select("doc_id").collect())
