"""Column functions and operators on literal cases."""

import random

import pytest
from pyspark.sql import functions as F

from loam.config import Captions, Settings, load
from loam.functions import arrays, captions, geometry, text
from loam.operators import cluster, enrich, gates, manifest, ordered, report
from loam.sources import files, landing, sinks


def values(spark, rows, schema, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def test_clean_text(spark):
    got = values(spark, [("  a person.\n ",), ("a\u00a0b\t c...",), (None,), ("...",), ("x . .",)], "s string", text.clean_text(F.col("s")))
    assert got == ["a person", "a b c", "", "", "x ."]


def test_labels_and_types(spark):
    mapping = {"SAFE": "safe", "QUESTIONABLE": "sensitive", "UNSAFE": "explicit"}
    got = values(spark, [("SAFE",), ("QUESTIONABLE_CONTENT",), ("LABEL_unsafe",), ("weird",), (None,)], "s string", text.first_label(F.col("s"), mapping, "safe"))
    assert got == ["safe", "sensitive", "explicit", "safe", "safe"]
    known = {".jpg": "image/jpeg", ".png": "image/png", ".webp": "image/webp"}
    assert values(spark, [("a.jpg",), ("d/b.PNG",), ("c.webp",), ("x.y/c",)], "s string", text.mime_type(F.col("s"), known)) == ["image/jpeg", "image/png", "image/webp", "image/jpeg"]


@pytest.mark.parametrize(("tags", "hits"), [("1girl, child, indoor", ["child"]), ("woman, kitchen", []), ("a child sitting", []), ("CHILD,\tchair", ["child"]), ("aged_down, baby", ["aged down", "baby"]), ("Aged Down", ["aged down"]), ("", []), (None, [])])
def test_block(spark, tags, hits):
    assert values(spark, [(tags,)], "s string", text.block_hits(F.col("s"), Captions().blocked)) == [hits]


def test_block_cannot_be_turned_off(tmp_path):
    (tmp_path / "c.yaml").write_text("captions:\n  blocked: [extra]\ngates:\n  min_size: 5\n")
    got = load(str(tmp_path / "c.yaml"))
    assert set(Captions().blocked) < set(got.captions.blocked) and got.gates.min_size == 5 and got.ratios == Settings().ratios


def test_numbers(spark):
    rows = [("1024",), (" 1024 ",), ("1024.0",), ("x",), ("",), (None,)]
    assert values(spark, rows, "s string", text.to_int(F.col("s"))) == [1024, 1024, None, None, None, None]
    assert values(spark, [("1.5",), ("1.5d",), ("1e2",), ("",)], "s string", text.to_double(F.col("s"))) == [1.5, None, 100.0, None]
    assert values(spark, [("short",), ("abcdefghijkl",)], "s string", text.masked(F.col("s"))) == ["(len 5)", "abcd...ijkl (len 12)"]


def test_crops(spark):
    rows = [(2000, 1000), (1600, 1600), (1000, 2000), (4000, 1500), (3, 1), (5, 3)]
    got = values(spark, rows, "w long, h long", geometry.ratio_crop(F.col("w"), F.col("h")))
    assert [tuple(b) for b in got[:3]] == [(250, 0, 1750, 1000), (0, 0, 1600, 1600), (0, 242, 1000, 1757)]
    assert got[3]["b"] - got[3]["t"] == 1500 and tuple(got[4]) == (0, 0, 2, 1)
    box = geometry.padded_box(F.lit(0.5), F.lit(0.5), F.lit(0.5), F.lit(0.25), F.col("w"), F.col("h"), 0.1)
    assert tuple(values(spark, [(1000, 1000)], "w long, h long", box)[0]) == (450, 475, 1000, 775)


def test_resolution(spark):
    rows = [("3000", "2048"), ("2048", "4000"), ("1024", "1500"), ("1536", "1024"), ("800", "1200"), (None, "x")]
    assert values(spark, rows, "w string, h string", geometry.resolution_tag(F.col("w"), F.col("h"))) == ["absurdres", "absurdres", "highres", "highres", "", ""]


def test_reasons(spark):
    rows = [(True, True, True), (False, True, False), (False, False, True), (None, None, None)]
    off = gates.drop_reason(F.col("c"), F.col("s"), F.col("b"), False, False)
    on = gates.drop_reason(F.col("c"), F.col("s"), F.col("b"))
    schema = "c boolean, s boolean, b boolean"
    assert values(spark, rows, schema, off) == ["corrupt", "", "", ""] and values(spark, rows, schema, on) == ["corrupt", "too_small", "blurry", ""]


def test_tiles(spark):
    rows = [([200.0] * 16,), ([300.0] * 4 + [10.0] * 12,), ([],), ([200.0] * 8 + [10.0] * 8,), ([float("nan")] * 16,)]
    assert values(spark, rows, "t array<double>", arrays.passes_share(F.col("t"), 100.0, 0.5)) == [True, False, False, True, False]
    rng = random.Random(1)
    grid = [rng.random() * 255 if c < 8 else 100.0 for r in range(16) for c in range(16)]
    (tiles,) = values(spark, [(grid,)], "g array<double>", arrays.tile_sharpness(F.col("g"), 16, 16, 4))
    left, right = [tiles[i] for i in range(16) if i % 4 < 2], [tiles[i] for i in range(16) if i % 4 > 2]
    assert len(tiles) == 16 and min(left) > max(right)


def greedy(items, most):
    used, out = set(), {}
    for i, (o, h, _) in enumerate(items):
        if o in used:
            continue
        for p, k, _ in items[i:]:
            if p not in used and (h ^ k).bit_count() <= most:
                used.add(p)
                out[p] = o
    best = {}
    for o, _, px in items:
        if out[o] not in best or px > best[out[o]][0]:
            best[out[o]] = (px, o)
    return {(o, out[o], best[out[o]][1] == o) for o, _, _ in items}


@pytest.mark.parametrize("most", [3, 8, 20])
def test_clusters_are_those_of_the_greedy_walk(spark, most):
    rng = random.Random(most)
    items = []
    for i in range(120):
        h = rng.choice(items)[1] if items and rng.random() < 0.7 else rng.getrandbits(63)
        for _ in range(rng.randrange(most)):
            h ^= 1 << rng.randrange(63)
        items.append((i, h, rng.randrange(4)))
    got = cluster.greedy_clusters(spark.createDataFrame(items, "ord long, h long, px long"), most).collect()
    assert {(r["ord"], r["leader"], r["kept"]) for r in got} == greedy(items, most)


@pytest.mark.parametrize("grouped", [False, True])
@pytest.mark.parametrize("most", [8, 24])
def test_close_hashes_are_all_found(spark, grouped, most, monkeypatch):
    """By variants of bands and in pairs of blocks, within a group if there is one."""
    monkeypatch.setattr(cluster, "BLOCK", 16)
    rng = random.Random(6)
    items = [(rng.getrandbits(64) - (1 << 63), rng.choice((None, "a", "b"))) for _ in range(100)]
    items += [(h ^ sum({1 << rng.randrange(63) for _ in range(9)}), g) for h, g in items]
    hashes = spark.createDataFrame(items, "h long, _g string")
    got = cluster.close_hashes(hashes if grouped else hashes.select("h"), most).collect()
    bits = lambda x, y: ((x ^ y) % (1 << 64)).bit_count()
    true = {(g if grouped else 0, min(x, y), max(x, y)) for x, g in items for y, k in items if x != y and bits(x, y) <= most and (not grouped or g == k)}
    assert len(got) == len(true) > 20 and {(r["_g"] if grouped else 0, r["x"], r["y"]) for r in got} == true


@pytest.mark.parametrize("most", [8, 24])
def test_exploded_hashes_are_not_broadcast(spark, most, tmp_path):
    """However small the file of the hashes is: their variants, or their rows for pairs of blocks, are many times as many."""
    spark.range(1000).select(F.xxhash64("id").alias("h")).write.parquet(f"{tmp_path}/h")
    plan = cluster.close_hashes(spark.read.parquet(f"{tmp_path}/h"), most)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_pairs_of_copies(spark):
    got = cluster.close_pairs(spark.createDataFrame([(0, 5), (1, 5), (2, 4), (3, -1), (4, None)], "ord long, h long"), 3).collect()
    assert sorted(map(tuple, got)) == [(0, 1, 0), (0, 2, 1), (1, 2, 1)]


@pytest.mark.parametrize("group", [None, "g"])
def test_copies_make_no_pairs(spark, group, monkeypatch):
    """300 equal hashes are one walked item of each group; items without a hash stay."""
    seen = []
    monkeypatch.setattr(cluster, "leaders", lambda pairs, real=cluster.leaders: (seen.append(pairs.count()), real(pairs))[1])
    items = [(i, 7, i % 5, "ab"[i % 2]) for i in range(300)] + [(300, 6, 9, None), (301, None, 1, "a"), (302, 6, 9, None)]
    got = {r["ord"]: r for r in cluster.greedy_clusters(spark.createDataFrame(items, "ord long, h long, px long, g string"), 8, group).collect()}
    assert seen == [0 if group else 1] and len(got) == 303
    assert {got[i]["leader"] for i in range(300)} == ({0, 1} if group else {0}) and got[301]["kept"]
    assert (got[300]["leader"], got[302]["leader"]) == ((300, 300) if group else (0, 0))
    assert [i for i in range(303) if got[i]["kept"]] == ([4, 9, 300, 301] if group else [300, 301])


def test_chain_is_two_clusters(spark):
    items = [(0, 0, 1), (1, 0b111, 1), (2, 0b111111, 1)]
    got = cluster.greedy_clusters(spark.createDataFrame(items, "ord long, h long, px long"), 3)
    assert {(r["ord"], r["leader"]) for r in got.collect()} == {(0, 0), (1, 0), (2, 2)}
    assert cluster.greedy_clusters(spark.createDataFrame([], "ord long, h long, px long"), 3).count() == 0


def test_manifest(spark):
    base = spark.createDataFrame([("a", "800", ""), ("b", "512", "blurry"), ("b", "1", "")], "path string, width string, drop_reason string")
    new = spark.createDataFrame([("a", "good", None), ("b", "bad", "7"), ("z", "bad", None)], "path string, bucket string, width string")
    got = {tuple(r) for r in manifest.augment(base, new).collect()}
    assert got == {("a", "800", "", "good"), ("b", "7", "blurry", "bad"), ("b", "7", "", "bad")}
    assert [r["path"] for r in manifest.unmatched(base, new).collect()] == ["z"]
    both = manifest.union(base, new, export=True)
    assert both.columns == ["path", "width", "drop_reason", "bucket"] and both.where("bucket = '' or drop_reason = ''").count() == 6


def test_ratio(spark):
    target = {"detail": 0.6, "anchor": 0.35, "bg": 0.05}

    def check(**n):
        df = spark.createDataFrame([(k,) for k, v in n.items() for _ in range(v)], "bucket string")
        return tuple(report.first_failure(report.shares(df, "bucket", target, 0.10)).first())

    assert check(detail=60, anchor=35, bg=5) == (True, None)
    assert check(detail=10, anchor=80, bg=10) == (False, "detail")
    assert check() == (False, "detail")


def test_budget_and_names(spark):
    pages = spark.createDataFrame([(i, 10) for i in range(5)], "page int, n int")
    assert [r["page"] for r in ordered.within_budget(pages, "n", ["page"], 25).collect()] == [0, 1, 2]
    assert ordered.within_budget(pages, "n", ["page"], 25, spent=25).count() == 0
    names = spark.createDataFrame([(0, "a/x.png"), (1, "b\\x.webp"), (2, "c/y")], "i int, path string")
    got = ordered.output_names(names, F.lit("s"), "path", ["i"]).orderBy("i").collect()
    assert [r["out_name"] for r in got] == ["s_x.jpg", "s_x_1.jpg", "s_y.jpg"]
    got = ordered.pair_names(names, "path").orderBy("i").collect()
    assert [(r["image_name"], r["caption_name"]) for r in got] == [("x.png", "x.txt"), ("x.jpg", "x.txt"), ("y.jpg", "y.txt")]


VOCAB = captions.Vocabulary({"shot": ("full body",), "rating": ("rating:a", "rating:b"), "light": ("dawn", "noon", "dusk")}, arrays=("light",), required=("shot",))
ORDER = ("shot", "_resolution", "light", "_rating")


def test_captions(spark):
    raw = '{"shot":"full body","rating":"rating:b","light":["dawn","x","dawn","noon"],"has_watermark":true,"description":" a  cup.\\n"}'
    rows = [(raw, "a, b", "highres"), ("{}", "nude, bed", ""), ("not json", None, None), ('{"shot":"no","light":"dawn","has_watermark":"yes"}', "", "")]
    df = spark.createDataFrame(rows, "raw string, tags string, res string").withColumn("r", captions.coerce(F.col("raw"), VOCAB))
    got = df.select(captions.assemble(F.col("r"), ORDER, VOCAB, F.col("tags"), F.col("res"), F.lit("rating:a")).alias("c")).collect()
    assert [r["c"] for r in got] == ["full body, highres, dawn, dawn, rating:b, a, b, watermark, a cup", "rating:a, nude, bed", "rating:a", "rating:a"]
    assert VOCAB.json_schema()["properties"]["light"]["items"]["enum"] == ["dawn", "noon", "dusk"]


def test_enrichment_resumes(spark, tmp_path):
    items = spark.createDataFrame([("a", "t"), ("b", "t"), ("bad", "t")], "path string, tags string")
    log = tmp_path / "calls"

    def generate(path, tags):
        with open(log, "a") as f:
            f.write(path + "\n")
        if path == "bad":
            raise RuntimeError
        return {"shot": tags + path}

    cache = f"file://{tmp_path}/cache"
    for _ in range(2):
        got = {r["path"]: (r["response"], r["ok"]) for r in enrich.enrich(items, generate, cache, retries=1, pause=0).collect()}
        assert got == {"a": ('{"shot": "ta"}', True), "b": ('{"shot": "tb"}', True), "bad": ("{}", False)}
    calls = log.read_text().split()
    assert calls.count("a") == calls.count("b") == 1 and calls.count("bad") == 2
    assert enrich.enrich(items, generate, cache, version=2, retries=1, pause=0).where("ok").count() == 2
    waits = []
    with pytest.raises(ZeroDivisionError):
        enrich.with_retries(lambda: 1 / 0, retries=7, sleep=waits.append)
    assert waits == [1, 2, 4, 8, 16, 30]


def test_files(spark, tmp_path):
    for name in ("a/one.JPG", "a/b/two.png", "a/no.txt", "c/three.webp"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"12345")
    found = files.roots(spark, {"x": str(tmp_path / "a"), "none": str(tmp_path / "z"), "y": str(tmp_path / "c")})
    assert sorted((r["source"], r["path"].rsplit("/", 1)[1]) for r in found.collect()) == [("x", "one.JPG"), ("x", "two.png"), ("y", "three.webp")]
    assert files.of_size(found, 5).count() == 3
    in_buckets = files.buckets(spark, str(tmp_path), ("a", "none", "c")).groupBy("bucket").count().collect()
    assert {tuple(r) for r in in_buckets} == {("a", 2), ("c", 1)}
    assert report.read_cost(3, 4) == pytest.approx(0.035)
    out = str(tmp_path / "m.csv")
    assert files.read_manifest(spark, out).count() == 0
    df = spark.createDataFrame([('a "q", b', "line\nbreak"), ("", None)], "path string, caption string")
    sinks.write_manifest(out, df, csv=True)
    assert {tuple(r) for r in files.read_manifest(spark, out).collect()} == {('a "q", b', "line\nbreak"), ("", "")}
    with pytest.raises(ValueError, match="input"):
        sinks.write_pairs(df, "d/raw/", ("d\\raw",))
    assert sinks.check_pairs(df, df).count() == 1
    with pytest.raises(Exception, match="training set"):
        sinks.check_pairs(df, df.limit(0)).collect()


def test_landing(spark, tmp_path):
    (tmp_path / "p.json").write_text("\n".join('{"page":%d,"handle":"h","data":[{"id":"1"},{"id":"2"}],"media":[{"media_key":"k%d","type":"photo","url":"u","width":2000,"height":1600},{"media_key":"v","type":"video","url":"u","width":2000,"height":1600},{"media_key":"s","type":"photo","url":"u"}]}' % (i, i) for i in range(4)))
    pages = landing.pages(spark, str(tmp_path))
    assert landing.consumed(pages, 3).count() == 2
    landed = spark.createDataFrame([("k0",)], "media_key string")
    assert sorted(r["media_key"] for r in landing.media(pages, 1536, landed).collect()) == ["k1", "k2", "k3"]
    assert tuple(landing.figures(pages, 1536).first()) == (12, 4, 4)


def test_toml():
    import tomllib

    t = sinks.Training("C:\\work\\", "p", "m", "model.bin", "vae.bin", "te", 20, "6e-6")
    got = tomllib.loads(sinks.training_toml(t))
    assert "adapter" not in got and got["model"]["llm_adapter_lr"] == 0 and got["output_dir"] == "C:/work/outputs/p" and got["optimizer"]["lr"] == 6e-6
    from dataclasses import replace

    assert tomllib.loads(sinks.training_toml(replace(t, init_from="w/e10")))["model"]["transformer_path"] == "w/e10"
    got = tomllib.loads(sinks.dataset_toml("d\\x", [1536], 0.66, 1.5, 7, 1))
    assert got["resolutions"] == [1536] and got["directory"] == [{"path": "d/x", "num_repeats": 1}]


def test_streams(spark, tmp_path):
    from loam.streaming import events

    df = spark.createDataFrame([(1, "2024-01-01 00:10:00", 7, "view", 1.0), (1, "2024-01-01 00:10:00", 7, "view", 1.0), (2, "2024-01-01 00:20:00", 7, "view", 2.0), (3, "2024-01-01 05:00:00", 8, "click", 4.0)], "event_id long, ts string, user_id long, event_type string, value double").withColumn("ts", F.to_timestamp("ts"))
    df.write.parquet(str(tmp_path / "in"))
    stream = events.without_duplicates(events.folder_stream(spark, str(tmp_path / "in"), df.schema))
    q = stream.writeStream.format("memory").queryName("once").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("once").count() == 3
    for _ in range(2):
        q = events.resumable(events.folder_stream(spark, str(tmp_path / "in"), df.schema), lambda d: d.withColumn("done", F.lit(True)), f"file://{tmp_path}/out", str(tmp_path / "cp"), "event_id")
        q.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3
