"""The stages end to end, and sizes from image headers."""

import struct

import pandas as pd
from pyspark.sql import functions as F

from loam.config import Captions, Gates
from loam.functions import captions, models
from loam.plans import stages
from loam.sources import pixels

ITEMS = "path string, source string, source_ord int, width int, height int, corrupt boolean, h long, sharpness double, tiles array<double>"
SHARP = [200.0] * 16


def manifest(spark):
    rows = [
        ("r/a.jpg", "x", 0, 2200, 1100, False, 0, 150.0, SHARP),
        ("r/b.jpg", "x", 0, 3000, 2000, False, 1, 150.0, SHARP),
        ("r/c.jpg", "x", 0, 500, 2000, False, 2, 150.0, SHARP),
        ("r/d.jpg", "x", 0, 2000, 2000, False, 1 << 40, 20.0, SHARP),
        ("s/e.jpg", "y", 1, 2000, 2000, False, (1 << 60) - 1, 150.0, [200.0] * 4 + [1.0] * 12),
        ("s/b.png", "y", 1, 1600, 1600, False, (1 << 30) - 1, 150.0, SHARP),
        ("s/n.png", "y", 1, 1600, 1600, False, (1 << 40) - 1 << 20, 150.0, None),
        ("s/q/b.jpg", "y", 1, 1600, 1600, False, (1 << 50) - 1, 150.0, SHARP),
        ("s/z.jpg", "y", 1, None, None, True, None, None, None),
    ]
    return stages.curate_pool(spark.createDataFrame(rows, ITEMS), Gates(min_size=1024))


def test_curation(spark):
    got = {r["original"] or r["path"]: r for r in manifest(spark).collect()}
    reasons = {k: r["drop_reason"] for k, r in got.items()}
    assert reasons == {"r/a.jpg": "duplicate", "r/b.jpg": "", "r/c.jpg": "too_small", "r/d.jpg": "blurry", "s/e.jpg": "flat_background", "s/b.png": "", "s/n.png": "flat_background", "s/q/b.jpg": "", "s/z.jpg": "corrupt"}
    assert (got["r/b.jpg"]["path"], got["r/b.jpg"]["width"], got["r/b.jpg"]["height"]) == ("x_b.jpg", 3000, 2000)
    assert [got[p]["path"] for p in ("s/b.png", "s/q/b.jpg")] == ["y_b.jpg", "y_b_1.jpg"]
    order = sorted(got, key=lambda k: got[k]["emitted"])
    assert order == ["r/c.jpg", "r/d.jpg", "s/e.jpg", "s/n.png", "s/z.jpg", "r/a.jpg", "r/b.jpg", "s/b.png", "s/q/b.jpg"]
    assert sorted(r["emitted"] for r in got.values()) == list(range(9))


def test_no_tiles_need_no_tile_gate(spark):
    rows = [("a", "x", 0, 2000, 2000, False, 0, 150.0, None), ("b", "x", 0, 2000, 2000, False, 0, 150.0, [])]
    items = spark.createDataFrame(rows, ITEMS)
    reasons = lambda df, **g: [r["drop_reason"] for r in stages.measured_gates(df, Gates(**g)).orderBy("path").collect()]
    assert reasons(items) == ["flat_background"] * 2 and reasons(items, tiles=0) == ["", ""] == reasons(items.drop("tiles"))


def test_captions_and_pairs(spark, tmp_path):
    curated = manifest(spark)
    tags = spark.createDataFrame([("x_b.jpg", "cup, table", "NSFW"), ("y_b.jpg", "Child, chair", "NORMAL"), ("y_b_1.jpg", "tree", None)], "path string, tags string, label string")
    log = tmp_path / "calls"

    def generate(path, tags):
        with open(log, "a") as f:
            f.write(path + "\n")
        return {"quality": "high", "description": f"a {tags}."} if path != "y_b_1.jpg" else {}

    vocab = captions.Vocabulary({"quality": ("high", "low"), "rating": ("rating:general", "rating:explicit")})
    out = stages.caption(curated, tags, generate, vocab, ("quality", "_resolution", "_rating"), f"file://{tmp_path}/cache", Captions(), pause=0)
    got = {r["path"]: r for r in out.collect()}
    assert got["x_b.jpg"]["caption"] == "high, highres, rating:explicit, cup, table, a cup, table" or got["x_b.jpg"]["caption"].startswith("high, absurdres")
    assert got["y_b_1.jpg"]["caption"] == "highres, rating:general, tree" and got["y_b_1.jpg"]["quality_tag"] == ""
    assert got["y_b.jpg"]["dropped"] == "True" and got["y_b.jpg"]["drop_reason"] == "underage_flag:child" and got["y_b.jpg"]["caption"] is None
    assert "y_b.jpg" not in log.read_text().split()
    pairs = stages.training_pairs(out, spark.createDataFrame([("x_b.jpg",)], "path string"))
    assert [(r["image_name"], r["caption_name"]) for r in pairs.collect()] == [("x_b.jpg", "x_b.txt")]
    assert stages.bucket_ratios(curated).count() == 3


def test_header_sizes(spark):
    png = b"\x89PNG\r\n\x1a\n" + struct.pack(">I4sII", 13, b"IHDR", 640, 480)
    jpeg = b"\xff\xd8\xff\xe0" + struct.pack(">H", 4) + b"ab" + b"\xff\xc0" + struct.pack(">HBHH", 11, 8, 480, 641)
    bmp = b"BM" + bytes(16) + struct.pack("<ii", 7, -9)
    webp = b"RIFF" + bytes(4) + b"WEBPVP8X" + bytes(8) + (99).to_bytes(3, "little") + (49).to_bytes(3, "little")
    data = [png, jpeg, bmp, webp, b"not an image", b"", None, jpeg[:9]]
    df = spark.createDataFrame([(str(i), None if d is None else bytearray(d)) for i, d in enumerate(data)], "path string, content binary")
    got = [tuple(r)[1:] for r in pixels.with_sizes(df).orderBy("path").collect()]
    assert got[:4] == [(640, 480, False), (641, 480, False), (7, 9, False), (100, 50, False)] and all(g == (None, None, True) for g in got[4:])


def test_models(spark):
    df = spark.createDataFrame([({"b": 0.9, "a": 0.9, "c": 0.2}, [3.0, 4.0], 5.4), ({}, [0.0, 0.0], None)], "m map<string,double>, v array<float>, s double")
    length = models.per_worker(lambda: 10, lambda model, v: pd.Series([model * len(x) for x in v]), "long")
    got = df.select(models.tags_above(F.col("m"), 0.5), models.best_label(F.col("m")), models.linear_score(F.col("v"), [1.0, 2.0], 1.0), models.score_bucket(F.col("s"), 6, 5), length(F.col("v"))).collect()
    assert [tuple(r) for r in got] == [("a, b", "a", 3.2, "medium", 20), ("", None, None, "bad", 20)]
    losses = spark.createDataFrame([(1, 5.0), (2, 4.0), (3, 4.0), (4, 4.5), (5, 1.0)], "epoch int, loss double")
    assert [r["stop"] for r in stages.flat_epochs(losses).orderBy("epoch").collect()] == [False, False, False, True, False]
