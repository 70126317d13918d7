"""Scans and sinks on small files, and the streaming tiles against the batch ones."""

import gzip

import pytest
from pyspark.sql import functions as F

from omicspark.sources import scans
from omicspark.streaming import tiles


def test_fragments_skip_comments_and_prefix_cells(spark, tmp_path):
    path = tmp_path / "f.tsv.gz"
    with gzip.open(path, "wt") as f:
        f.write("# made by hand\nchr1\t5\t9\tAAA\t2\nchrM\t1\t3\tCCC\t1\n")
    rows = scans.read_fragments(spark, str(path), "s1").orderBy("chr").collect()
    assert [tuple(r) for r in rows] == [("chr1", 5, 9, "s1_AAA", 2), ("chrM", 1, 3, "s1_CCC", 1)]


def test_keyed_tables_refuse_repeated_and_missing_keys(spark, tmp_path):
    (tmp_path / "ok.tsv").write_text("id\tage\na\t1\nb\t\n")
    assert scans.read_keyed(spark, str(tmp_path / "ok.tsv"), "id").count() == 2
    for bad in ("id\tage\na\t1\na\t2\n", "id\tage\n\t1\n"):
        (tmp_path / "bad.tsv").write_text(bad)
        with pytest.raises(ValueError, match="missing or repeated"):
            scans.read_keyed(spark, str(tmp_path / "bad.tsv"), "id")


def test_metrics_keep_called_rows(spark, tmp_path):
    (tmp_path / "m.csv").write_text("barcode,is_cell,n\nA,1,5\nB,0,7\n")
    assert [r.barcode for r in scans.read_metrics(spark, str(tmp_path / "m.csv"), "barcode string, is_cell int, n int").collect()] == ["A"]


def test_column_candidates():
    assert scans.resolve_columns(["snp", "P_value", "N"], {"SNP": ["rsid", "SNP"], "P": ["p", "p_value"]}) == {"SNP": "snp", "P": "P_value"}
    with pytest.raises(ValueError, match="FRQ"):
        scans.resolve_columns(["snp"], {"FRQ": ["maf"]})


def test_sumstats_keep_wanted_rows(spark, tmp_path):
    (tmp_path / "s.tsv").write_text("rsid\tp_value\trest\nrs1\t0.1\tx\nrs2\t0.2\ty\n")
    kept = spark.createDataFrame([("rs2",)], "SNP string")
    rows = scans.read_sumstats(spark, str(tmp_path / "s.tsv"), {"SNP": ["rsid"], "P": ["p_value"]}, kept).collect()
    assert [tuple(r) for r in rows] == [("rs2", "0.2")]


def test_motif_blocks(spark, tmp_path):
    (tmp_path / "m.tf").write_text("AC one\nID one\nP0 A C G T\n01 1 2 3 4\n02 5 6 7 8\nXX\n//\nID two\nP0 A C G T\n01 9 0 0 1\n//\n")
    rows = scans.read_motifs(spark, str(tmp_path / "m.tf")).orderBy("id", "place").collect()
    assert [(r.id, r.place, r.A, r.T) for r in rows] == [("one", 1, 1.0, 4.0), ("one", 2, 5.0, 8.0), ("two", 1, 9.0, 1.0)]


def test_regions_are_written_by_group(spark, tmp_path):
    df = spark.createDataFrame([("chr1", 1, 5, "x"), ("chr2", 2, 6, "y")], "chr string, start long, end long, cluster string")
    scans.write_regions(df, str(tmp_path / "out"), "cluster")
    assert sorted(p.name for p in (tmp_path / "out").glob("cluster=*")) == ["cluster=x", "cluster=y"]


def test_stream_gives_the_batch_tiles(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = tiles.tile_counts(spark.readStream.schema(events.schema).parquet(str(tmp_path / "in")), late="1000 days")
    run = stream.writeStream.format("memory").queryName("tiles").outputMode("complete").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c")).start()
    run.awaitTermination(120)
    key = lambda r: (r.start, r.event_type, r.n, round(r.total, 4))
    assert sorted(map(key, spark.table("tiles").collect())) == sorted(map(key, tiles.tile_counts(events).collect()))


def test_sessions_split_at_gaps(spark):
    rows = [(1, "2024-01-01 00:00:00"), (1, "2024-01-01 00:20:00"), (1, "2024-01-01 02:00:00"), (2, "2024-01-01 00:00:00")]
    df = spark.createDataFrame(rows, "user_id long, ts string").withColumn("ts", F.to_timestamp("ts"))
    assert sorted((r.user_id, r.n) for r in tiles.sessions(df).collect()) == [(1, 1), (1, 2), (2, 1)]


def test_motifs_are_trimmed_to_the_best_supported_window(spark):
    import numpy as np

    from omicspark.sources.scans import trim_motifs

    rng = np.random.default_rng(1)
    motifs = {f"m{i}": rng.integers(0, 9, (int(rng.integers(3, 20)), 4)) + (np.arange(4) == 0) for i in range(60)}
    motifs["short"] = np.ones((4, 4), int)
    motifs["flanked"] = np.array([[1, 0, 0, 0]] * 4 + [[9, 9, 9, 9]] * 3 + [[2, 0, 0, 0]] * 6)
    df = spark.createDataFrame([(k, p + 1, *map(float, r)) for k, m in motifs.items() for p, r in enumerate(m)], "id string, place int, A double, C double, G double, T double").repartition(3)
    got = {}
    for r in trim_motifs(df).orderBy("id", "place").collect():
        got.setdefault(r.id, []).append((r.place, r.A, r.C, r.G, r["T"]))
    for k, m in motifs.items():
        totals = m.sum(1)
        core = np.flatnonzero(totals >= totals.max() / 2)
        lo, hi, n = core[0], core[-1], len(m)
        width = min(max(hi - lo + 1, 8), n)
        starts = list(range(max(0, hi - width + 1), min(lo, n - width) + 1))
        start = max(starts, key=lambda s: (totals[s : s + width].sum(), -s))
        assert got[k] == [(i + 1, *map(float, r)) for i, r in enumerate(m[start : start + width])]


def test_optional_mapping_is_checked(spark, tmp_path):
    from omicspark.sources.scans import read_mapping

    known = spark.createDataFrame([("w1",), ("w2",)], "well string")
    read = lambda text: read_mapping(spark, str(write(text)), ["well", "donor", "sample"], [["well", "donor"], ["well", "sample"]], known, {"sample": "_"})

    def write(text):
        file = tmp_path / f"{abs(hash(text))}.tsv"
        file.write_text(text)
        return file

    good = "well\tdonor\tsample\nw1\td1\ts1\nw1\td2\ts2\nw2\td1\ts1\n"
    assert read(good).count() == 3
    assert read_mapping(spark, None, ["well", "donor"], [], known).collect() == []
    for text, said in [
        (good + "w1\td1\ts3\n", "repeated well and donor"),
        (good + "w2\td9\ts1\n", "repeated well and sample"),
        (good + "w2\td9\ta_b\n", "sample with"),
        (good + "w3\td9\ts9\n", "well not known"),
        (good + "w2\t\ts9\n", "rows without donor"),
        ("well\tdonor\nw1\td1\n", "no column sample"),
    ]:
        with pytest.raises(ValueError, match=said):
            read(text)
