"""Images decoded, hashed, cropped and written; paged sources; retries; the stage runner."""

import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from loam.functions import geometry, models
from loam.functions.arrays import hamming
from loam.operators import enrich, ordered
from loam.plans import runner
from loam.sources import landing, paged, pixels, sinks


def picture(h, w, seed=None, value=120):
    if seed is None:
        return np.full((h, w, 3), value, "u1")
    return np.random.default_rng(seed).integers(0, 256, (h, w, 3), dtype="u1")


def as_png(samples, kind=0, colour=None):
    """A PNG file whose lines all use one filter."""
    h, w, n = samples.shape
    x = samples.astype(int)
    left, up, corner = np.zeros_like(x), np.zeros_like(x), np.zeros_like(x)
    left[:, 1:], up[1:], corner[1:, 1:] = x[:, :-1], x[:-1], x[:-1, :-1]
    p = left + up - corner
    a, b, c = abs(p - left), abs(p - up), abs(p - corner)
    paeth = np.where((a <= b) & (a <= c), left, np.where(b <= c, up, corner))
    guess = [0 * x, left, up, (left + up) // 2, paeth][kind]
    lines = np.hstack([np.full((h, 1), kind, "u1"), ((x - guess) % 256).astype("u1").reshape(h, w * n)]).tobytes()
    chunk = lambda k, body: struct.pack(">I", len(body)) + k + body + struct.pack(">I", zlib.crc32(k + body))
    head = struct.pack(">IIBBBBB", w, h, 8, {1: 0, 2: 4, 3: 2, 4: 6}[n], 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(lines)) + chunk(b"IEND", b"")


def as_bmp(samples):
    h, w, _ = samples.shape
    line = (w * 3 + 3) // 4 * 4
    body = b"".join(samples[y, :, ::-1].tobytes().ljust(line, b"\0") for y in reversed(range(h)))
    return b"BM" + struct.pack("<IHHI", 54 + len(body), 0, 0, 54) + struct.pack("<IiiHHIIiiII", 40, w, h, 1, 24, 0, len(body), 0, 0, 0, 0) + body


@pytest.mark.parametrize("kind", range(5))
@pytest.mark.parametrize("samples", [1, 3, 4])
def test_png_is_decoded(kind, samples):
    image = np.random.default_rng(kind).integers(0, 256, (7, 9, samples), dtype="u1")
    assert (pixels.decoded(as_png(image, kind)) == image[:, :, : 3 if samples == 4 else samples]).all()


def test_other_files():
    image = picture(5, 6, 1)
    assert (pixels.decoded(as_bmp(image)) == image).all()
    body, ending = pixels.encoded(image)
    assert pixels.is_whole(body) and ending in ("png", "jpg") and (ending == "jpg" or (pixels.decoded(body) == image).all())


def test_cut_files_are_corrupt():
    png, bmp = as_png(picture(40, 40, 2)), as_bmp(picture(40, 40, 2))
    damaged = png[:200] + bytes([png[200] ^ 1]) + png[201:]
    assert [pixels.is_whole(x) for x in (png, bmp, png[:-40], damaged, bmp[:-40], b"not an image", b"", None)] == [True, True] + [False] * 6
    jpeg = b"\xff\xd8\xff\xc0" + struct.pack(">HBHH", 11, 8, 480, 641) + bytes(4) + b"\xff\xda" + bytes(50) + b"\xff\xd9"
    webp = b"RIFF" + (26).to_bytes(4, "little") + b"WEBPVP8X" + bytes(18)
    try:
        import PIL  # noqa: F401
    except ImportError:
        assert [pixels.is_whole(x) for x in (jpeg, jpeg[:-10], webp, webp[:-4])] == [True, False, True, False]


def test_measures(spark):
    noise = picture(512, 512, 3)
    files = [("flat", as_png(picture(512, 512, value=120))), ("flat2", as_png(picture(256, 256, value=123), 1)), ("noise", as_bmp(noise)), ("small", as_bmp(np.ascontiguousarray(noise[::1, ::1] // 2 + 60))), ("bad", b"not an image"), ("none", None)]
    half = np.concatenate([picture(400, 200, 4), picture(400, 200)], axis=1)
    df = spark.createDataFrame([(p, None if c is None else bytearray(c)) for p, c in [*files, ("half", as_png(half, 2))]], "path string, content binary")
    got = {r["path"]: r for r in pixels.measured(df).collect()}
    assert got["bad"]["corrupt"] and got["none"]["corrupt"] and not got["flat"]["corrupt"]
    assert got["flat"]["sharpness"] == 0 < got["noise"]["sharpness"] and (got["flat2"]["width"], got["flat2"]["height"]) == (256, 256)
    tiles = np.array(got["half"]["tiles"]).reshape(4, 4)
    assert tiles[:, :2].min() > tiles[:, 2:].max()
    bits = lambda a, b: ((got[a]["h"] ^ got[b]["h"]) % (1 << 64)).bit_count()
    assert bits("flat", "flat2") <= 6 < bits("flat", "noise") and bits("noise", "small") <= 6
    grey = pixels.grey(df.where("path in ('half', 'bad')"), 8).orderBy("path").collect()
    assert grey[0]["pixels"] is None and len(grey[1]["pixels"]) == 64 and grey[1]["pixels"][7] == 120


def test_hash_is_that_of_the_plain_transform():
    grey = np.random.default_rng(5).integers(0, 256, (32, 32)).astype(float)
    low = [[sum(grey[y, x] * np.cos(np.pi * v * (2 * y + 1) / 64) * np.cos(np.pi * u * (2 * x + 1) / 64) for y in range(32) for x in range(32)) for u in range(8)] for v in range(8)]
    low = np.array(low).ravel()
    expected = sum(1 << i for i, x in enumerate(low) if x > np.median(low))
    assert pixels.perceptual_hash(grey) % (1 << 64) == expected
    assert (pixels.shrunk(grey, 32) == grey).all() and pixels.shrunk(grey, 16)[0, 0] == pytest.approx(grey[:2, :2].mean())


def test_files_are_written(spark, tmp_path):
    image = picture(20, 30, 6)
    names = [("r/x.png", "a"), ("s/x.png", "b"), ("s/y.png", "c")]
    df = spark.createDataFrame([(p, bytearray(as_png(image)), c) for p, c in names], "path string, content binary, caption string")
    named = ordered.output_names(df, F.lit("src"), "path", ["path"]).withColumn("box", F.expr("named_struct('l', 5L, 't', 2L, 'r', 25L, 'b', 12L)"))
    crops = pixels.cropped(named).join(df.select("path", "caption"), "path")
    out = f"{tmp_path}/out"
    written = {r["name"]: r["bytes"] for r in sinks.write_pair_files(crops, out).collect()}
    ending = pixels.encoded(image)[1]
    assert set(written) == {f"{s}.{e}" for s in ("src_x", "src_x_1", "src_y") for e in (ending, "txt")}
    assert (tmp_path / "out/src_x_1.txt").read_text() == "b" and (tmp_path / f"out/src_y.{ending}").stat().st_size == written[f"src_y.{ending}"]
    if ending == "png":
        assert (pixels.decoded((tmp_path / "out/src_x.png").read_bytes()) == image[2:12, 5:25]).all()
    assert sinks.copy_files(named, out).count() == 3 and sorted(p.name for p in (tmp_path / "out").iterdir() if not p.name.startswith(".")) == ["src_x.jpg", "src_x_1.jpg", "src_y.jpg"]
    with pytest.raises(ValueError, match="input"):
        sinks.copy_files(named, out, (out + "/",))


def test_manifests_are_replaced_whole(spark, tmp_path):
    path = f"{tmp_path}/m"
    sinks.write_manifest(path, spark.createDataFrame([(1,)], "a int"))
    with pytest.raises(Exception, match="stop"):
        sinks.write_manifest(path, spark.createDataFrame([(2,)], "a int").where(F.raise_error(F.lit("stop")).cast("boolean")))
    assert spark.read.parquet(path).first()["a"] == 1
    sinks.write_manifest(path, spark.createDataFrame([(3,)], "a int"))
    assert spark.read.parquet(path).first()["a"] == 3 and not [p for p in tmp_path.iterdir() if ".old-" in p.name]


def fetcher():
    """Three pages of two rows for each key but one that fails. A function of its own, so that it travels to the workers."""

    def fetch(key, cursor):
        if key == "lost":
            raise KeyError(key)
        page = int(cursor or 0)
        return [(key, page, i) for i in range(2)], 2, str(page + 1) if page < 2 else None

    return fetch


@pytest.mark.parametrize(("most", "expected"), [(100, 12), (7, 8), (6, 6), (1, 2), (0, 0)])
def test_pages_by_cursor(spark, tmp_path, most, expected):
    source = paged.paged_source("pages_by_cursor", "key string, page int, i int", fetcher(), ["a", "lost", "b"], most)
    spark.dataSource.register(source)
    got = sorted(tuple(r) for r in spark.read.format("pages_by_cursor").load().collect())
    assert got == sorted([(k, p, i) for k in "ab" for p in range(3) for i in range(2)][:expected])
    assert list(paged.walk(fetcher(), ["a", "lost", "b"], most)) == [(k, p, i) for k in "ab" for p in range(3) for i in range(2)][:expected]


def test_pages_as_a_stream(spark, tmp_path):
    spark.dataSource.register(paged.paged_source("paged_stream", "key string, page int, i int", fetcher(), ["a", "lost", "b"], 100))
    for _ in range(2):
        q = spark.readStream.format("paged_stream").load().writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/cp").start()
        for _ in range(60):
            if q.exception() or spark.read.schema("key string, page int, i int").parquet(f"{tmp_path}/out").count() >= 12:
                break
            q.processAllAvailable()
        q.stop()
    assert spark.read.parquet(f"{tmp_path}/out").count() == 12
    at = paged.START
    for _ in range(3):
        at = paged.step(fetcher(), ["a", "lost", "b"], 100, at)[1]
    assert at == {"key": 1, "cursor": None, "read": 6} and len(list(paged.walk(fetcher(), ["a", "lost", "b"], 100, paged.START, at))) == 6


def test_landed_pages_end(spark):
    m = lambda n: [("k", "photo", "u", 2000, 2000)] * n
    rows = [(p, "a", [("1",)], m(2), "t") for p in range(4)] + [(0, "b", [("1",)], m(1), "t"), (1, "b", [("1",)], m(1), None), (2, "b", [("1",)], m(1), "t")] + [(0, "c", [], m(1), "t"), (1, "c", [("1",)], m(1), "t"), (0, "d", None, None, None)]
    found = spark.createDataFrame(rows, landing.PAGE)
    assert sorted((r["handle"], r["page"]) for r in landing.walked(found, 1536, 3).collect()) == [("a", 0), ("a", 1), ("b", 0), ("b", 1)]
    users = spark.createDataFrame([("a", 1), ("b", 2)], "handle string, user_id int")
    known, lost = landing.resolved(found.select("handle").distinct(), users)
    assert known.count() == 2 and {r["handle"] for r in lost.collect()} == {"c", "d"}
    pool = spark.createDataFrame([(i, ["x"] if i % 2 else ["y", "z"]) for i in range(9)], "i int, labels array<string>")
    assert landing.sampled(pool, "labels", ["z", "w"], 3).count() == 3 and landing.sampled(pool, "labels", ["w"], 3).count() == 0


class Answer(Exception):
    def __init__(self, status):
        self.status = status


def test_retries_by_status():
    def calls(status, ok_after=99):
        waits, left = [], [ok_after]

        def call():
            left[0] -= 1
            if left[0] >= 0:
                raise Answer(status)
            return "ok"

        try:
            return enrich.fetched(call, sleep=waits.append), waits
        except Answer as e:
            return e.status, waits

    assert calls(429) == (429, [5, 10, 20, 40, 80]) and calls(503, 2) == ("ok", [5, 10])
    assert calls(404) == (404, []) and enrich.is_transient(ConnectionError())


def test_results_are_reported_as_they_come(spark, tmp_path):
    items = spark.createDataFrame([(f"p{i}", "t") for i in range(6)], "path string, tags string").coalesce(1)
    log = str(tmp_path / "seen")

    def seen(path, response, ok):
        with open(log, "a") as f:
            f.write(f"{path} {ok} {len(response)}\n")

    def generate(path, tags):
        if path == "p3":
            raise RuntimeError
        return {"a": path}

    got = enrich.responses(items, generate, retries=1, pause=0, on_result=seen).collect()
    assert [r["path"] for r in got] == [f"p{i}" for i in range(6)]
    assert sorted(open(log).read().split("\n"))[1:] == [f"p{i} {i != 3} {int(i != 3)}" for i in range(6)]


def test_engines_and_scores(spark):
    df = spark.createDataFrame([("a", bytearray(b"2")), ("b", bytearray(b"x")), ("c", None)], "path string, content binary")
    boxes = models.text_boxes(df, lambda: 10, lambda engine, data: [[(0, 0), (engine, 0), (engine, 5), (0, 5)]] * int(data))
    share = {r["path"]: r["s"] for r in boxes.select("path", geometry.text_area(F.col("boxes"), F.lit(100), F.lit(10)).alias("s")).collect()}
    assert share == {"a": 0.1, "b": 0.0, "c": 0.0}
    v = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],), (None,)], "v array<float>")
    layers = [([[1, 0], [0, -1], [1, 1]], [0, 0, 0.5]), ([[2, 1, 1]], [0.25])]
    got = [r["s"] for r in v.select(models.layered_score(F.col("v"), layers).alias("s")).collect()]
    assert got[0] == pytest.approx(2 * 0.6 + 0 + (0.6 + 0.8 + 0.5) + 0.25) and got[1:] == [None, None]
    assert spark.range(1).select(hamming(F.lit(-1).cast("long"), F.lit(0).cast("long")).alias("n")).first()["n"] == 64


def test_stages_run_until_one_fails():
    seen = []
    stages = [("one", lambda: seen.append(1)), ("two", lambda: 0), ("three", lambda: 1 / 0), ("four", lambda: seen.append(4))]
    ran = runner.run_stages(stages)
    assert [(r.stage, bool(r.error)) for r in ran] == [("one", False), ("two", False), ("three", True)] and seen == [1]
    assert runner.run_stages([("a", lambda: 3), ("b", lambda: 0)])[-1].error == "exit code 3"
    assert runner.run_stages(stages, needs=lambda s: ["weights"] if s == "two" else [])[-1].error == "missing: weights"
