"""The inner steps of the methods, each against a plain version of it."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests_llm_helpers import words_of

from loam.llm import embed, mixing, packing, pii, quality, secrets, sharding


def test_fair_queue_takes_the_words_of_a_plain_one(spark, docs, rows):
    """Every document's words, by walking the finish times one by one."""
    numbered = docs.where("doc_id < 125").select("doc_id", "source", mixing.size_of(F.col("text")).alias("size"), mixing.shuffled(F.col("doc_id")).alias("order")).collect()
    sizes = Counter()
    for r in numbered:
        sizes[r["source"]] += r["size"]
    goal = mixing.targets(dict(sizes))
    events = []
    for s in sizes:
        own = sorted((r for r in numbered if r["source"] == s), key=lambda r: (r["order"] < 0, r["order"], r["doc_id"]))
        start = 0
        for lap in range(3):
            for r in own:
                if r["size"]:
                    events.append(((start + r["size"]) / goal[s], s is not None, s or "", r["order"] < 0, r["order"], r["doc_id"], lap, start, r["size"]))
                start += r["size"]
    taken, left = Counter(), sum(sizes.values())
    for _, named, s, _, _, d, _, start, size in sorted(events):
        words = min(max(0, min(size, int(goal[s if named else None]) - start)), left)
        taken[d] += words
        left -= words
    got = {r["doc_id"]: r["taken"] for r in mixing.mix_figures(docs.where("doc_id < 125")).collect()}
    assert got == {d: taken[d] for d in got} and sum(got.values()) > 0


def brute_isotonic(y, w):
    """The greatest least mean: max over starts of min over ends."""
    mean = lambda a, b: (y[a:b] * w[a:b]).sum() / w[a:b].sum()
    return np.array([max(min(mean(a, b) for b in range(i + 1, len(y) + 1)) for a in range(i + 1)) for i in range(len(y))])


def test_isotonic():
    rng = np.random.default_rng(1)
    x, y, w = np.sort(rng.random(40)), rng.random(40), rng.integers(1, 9, 40).astype(float)
    at, to = quality.isotonic(x, y, w)
    assert (np.diff(to) > 0).all() and (np.diff(at) > 0).all()
    assert np.unique(brute_isotonic(y, w).round(9)) == pytest.approx(to.round(9))


def test_features_approximate_the_kernel():
    rng = np.random.default_rng(2)
    model = quality.Model(np.zeros(quality.STATISTICS), np.ones(quality.STATISTICS))
    x = rng.normal(size=(60, quality.STATISTICS))
    z = model.features(x)[:, :-1]
    kernel = np.exp(-((x[:, None] - x[None]) ** 2).sum(2) / (2 * quality.STATISTICS))
    assert abs(z @ z.T - kernel).mean() < 0.06


def test_fit_is_that_of_a_plain_one(spark):
    """Scores of a fit over partitions, and of one matrix on the driver."""
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice(["the", "Ab", "x!!", "12", "le"], int(rng.integers(3, 60)), p=p)) for p in rng.dirichlet(np.ones(5), 300)]
    label = [int("!!" not in t or t.count("!!") * 5 < len(t.split())) for t in texts]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    known = spark.createDataFrame([(i, y, 0) for i, y in enumerate(label)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r["score"] for r in quality.quality(docs, known).collect()}
    part = np.array([zlib.crc32(str(i).encode()) % 4 for i in range(300)])
    x, y = np.array([quality.statistics(t) for t in texts]), np.array(label, float)
    train = part < 2
    center, scale = x[train].mean(0), np.sqrt(np.maximum((x[train] ** 2).mean(0) - x[train].mean(0) ** 2, 1e-12))
    scale[scale < 1e-5] = 1
    model = quality.Model(center, scale)
    z, w = model.features(x[train]), np.where(y[train] > 0.5, 0.5 / y[train].sum(), 0.5 / (1 - y[train]).sum())
    model.weights = np.linalg.solve(z.T @ (z * w[:, None]) + quality.RIDGE * np.eye(z.shape[1]), z.T @ (w * y[train]))
    raw = np.clip(model.raw(x[part == 3]), -0.5, 1.5)
    bin_ = np.minimum((raw + 0.5) * 200, 399).astype(int)
    at = [(raw[bin_ == b].mean(), y[part == 3][bin_ == b].mean(), (bin_ == b).sum()) for b in np.unique(bin_)]
    model.steps = quality.isotonic(*np.array(at, float).T)
    assert [got[i] for i in range(300)] == pytest.approx(model.score(x).tolist(), abs=1e-4)


def test_reliabilities_are_those_of_a_plain_maximisation():
    rng = np.random.default_rng(4)
    counts = Counter()
    for _ in range(600):
        true = rng.random() < 0.4
        vote = tuple(int(v) for v in np.where(rng.random(5) < 0.15, 0, np.where(rng.random(5) < 0.85, 1, -1) * (1 if true else -1)))
        counts[pii.encode(int(rng.integers(0, 2)), (*vote, int(rng.integers(0, 4))))] += 1
    got = pii.reliabilities(dict(counts), rounds=20)
    for kind in (0, 1):
        cases = [(pii.decode(c)[1], n, c) for c, n in counts.items() if pii.decode(c)[0] == kind]
        post = {c: 1 / (1 + np.exp(-sum(v))) for v, _, c in cases}
        for _ in range(20):
            yes, all_ = sum(n * post[c] for _, n, c in cases), sum(n for _, n, _ in cases)
            share = min(max(yes / all_, 0.01), 0.99)
            chance = lambda j, x, side, total: (sum(n * (post[c] if side else 1 - post[c]) for v, n, c in cases if v[j] == x) + 1 + (x == (1 if side else -1))) / (total + 4)
            odds = {(j, x): chance(j, x, True, yes) / chance(j, x, False, all_ - yes) for j in range(5) for x in (-1, 0, 1)}
            post = {c: 1 / (1 + 1 / (share / (1 - share) * np.prod([odds[j, x] for j, x in enumerate(v)]))) for v, _, c in cases}
        assert all(got[c] == pytest.approx(p, abs=1e-6) for c, p in post.items())
        truth = np.mean([(got[c] > 0.5) == (sum(v) > 0) for v, _, c in cases if sum(v)])
        assert truth > 0.9


def test_span_classifier_is_the_regression_s_optimum():
    rng = np.random.default_rng(5)
    codes = {pii.encode(int(k), (*map(int, v), int(s))): int(n) for k, v, s, n in zip(rng.integers(0, 4, 60), rng.integers(-1, 2, (60, 5)), rng.integers(0, 4, 60), rng.integers(1, 50, 60), strict=True)}
    truth = {c: float(rng.random()) for c in codes}
    got = pii.classifier(codes, truth)
    names = []
    for c in codes:
        kind, vote, shape = pii.decode(c)
        names.append({"one", f"k{kind}" if kind else "one", f"s{shape}" if shape else "one", *(f"v{j}{x}" for j, x in enumerate(vote) if x)})
    every = sorted(set().union(*names))
    w = dict.fromkeys(every, 0.0)
    for _ in range(20_000):
        grad = {f: -0.1 * w[f] for f in every}
        for c, own in zip(codes, names, strict=True):
            gap = codes[c] * (truth[c] - 1 / (1 + np.exp(-sum(w[f] for f in own))))
            for f in own:
                grad[f] += gap
        if max(map(abs, grad.values())) < 1e-4:
            break
        w = {f: w[f] + 5e-4 * g for f, g in grad.items()}
    for c, own in zip(codes, names, strict=True):
        assert got[c] == pytest.approx(1 / (1 + np.exp(-sum(w[f] for f in own))), abs=2e-3)


def test_long_addresses_are_candidates():
    left, host = "a" * 300, "b" * 200
    text = f"mail {left} [at] {host} [dot] x dot y dot z dot com. x at y. j at k dot org"
    found = [text[m[1] : m[2]] for m in pii.scan(text)[1:2] for m in [m[i : i + 4] for i in range(0, len(m), 4)]]
    assert found == [f"{left} [at] {host} [dot] x dot y dot z dot com", "j at k dot org"]
    assert pii.scan(" at " * 20_000)[1] == []


def test_packed_tiers_and_steps():
    rng = np.random.default_rng(6)
    packer = packing.Packer(0)
    lengths = [int(x) for x in np.concatenate([rng.integers(1, 900, 700), rng.integers(1000, 9000, 60), [4096, 8192, 1]])]
    for i, n in enumerate(lengths):
        packer.add(i, np.arange(n, dtype="<u4"))
    first = packer.rows(False).to_pylist()
    rows = first + packer.rows(True).to_pylist()
    by_sequence, by_step = defaultdict(list), defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append(r)
    for parts in by_sequence.values():
        assert sum(p["length"] for p in parts) == parts[0]["tier"] <= 4096
        by_step[parts[0]["step_id"]].append(parts)
    covered = defaultdict(list)
    for r in rows:
        covered[r["doc_id"]] += range(r["start"], r["start"] + r["length"])
    assert all(sorted(covered[i]) == list(range(n)) for i, n in enumerate(lengths))
    in_first = {r["sequence_id"] for r in first}
    for parts in (by_sequence[s] for s in in_first):
        # A tier's window begins with a piece that no shorter tier holds.
        assert parts[0]["tier"] == 512 or parts[0]["length"] > parts[0]["tier"] // 2
    for step in by_step.values():
        assert len({s[0]["tier"] for s in step}) == 1 and sum(s[0]["tier"] for s in step) <= packing.STEP
    for tier in packing.TIERS:
        cost = [sum(p["length"] ** 2 for s in step for p in s) for step in by_step.values() if step[0][0]["tier"] == tier and step[0][0]["sequence_id"] in in_first]
        assert not cost or max(cost) < 1.5 * min(cost) or len(cost) == 1


def split_by(keys, bounds):
    return np.searchsorted(np.array(bounds), keys, side="right")


@pytest.mark.parametrize("sample", [64, 1])
def test_splitters_leave_no_overfull_range(spark, sample, monkeypatch):
    """Keys that crowd in one place: a poor first sample is mended by denser ones."""
    monkeypatch.setattr(sharding, "SAMPLE", sample)
    rng = np.random.default_rng(7)
    keys = np.unique(np.concatenate([rng.integers(-(1 << 62), 1 << 62, 500), 10**15 + rng.integers(0, 1000, 900)]))
    size = rng.integers(1, 100, len(keys))
    size[3] = 60_000
    df = spark.createDataFrame([(int(k), 0, int(s)) for k, s in zip(keys, size, strict=True)], "key long, crc long, bytes long")
    bounds = sharding.splitters(df, int(size.sum()), 20)
    sums, members = Counter(), Counter()
    for r, s in zip(split_by(keys, bounds).tolist(), size.tolist(), strict=True):
        sums[r] += s
        members[r] += 1
    even = size.sum() / 20
    assert bounds == sorted(set(bounds)) and all(s <= sharding.OVERFULL * even or members[r] == 1 for r, s in sums.items()) and len(sums) >= 10


def test_shards_are_those_of_a_plain_cut(spark):
    """All records in order of their texts' hashes, cut by bytes; equal texts together."""
    rng = np.random.default_rng(8)
    texts = [f"text {int(rng.integers(0, 1500))} " * int(rng.integers(1, 6)) for _ in range(3000)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["shard"] for r in sharding.shard(df, 8, group_limit=1.0).collect()}
    keyed = df.select("doc_id", F.xxhash64("text").alias("k"), F.crc32(F.col("text").cast("binary")).alias("c"), (F.octet_length("text") + 16).alias("s")).collect()
    groups = defaultdict(list)
    for r in keyed:
        groups[r["k"], r["c"], r["s"]].append(r["doc_id"])
    total, start, expected = sum(r["s"] for r in keyed), 0, {}
    for (_, _, s), own in sorted(groups.items()):
        shard = int((start + s * len(own) / 2) * 8 / total)
        expected |= dict.fromkeys(own, shard)
        start += s * len(own)
    assert sum(got[d] != s for d, s in expected.items()) == 0


def brute_vote(tree, x):
    feature, cut, left, right, value = tree
    at = 0
    while feature[at] >= 0:
        at = left[at] if x[feature[at]] <= cut[at] else right[at]
    return value[at]


def test_forest_votes():
    forest = secrets.default_forest()
    x, _ = secrets.labelled_findings(200, seed=5)
    expected = [np.mean([brute_vote(t, row) for t in forest.trees]) for row in x]
    assert forest.predict(x).tolist() == pytest.approx(expected)


def brute_candidates(text):
    """Spans by plain search: announced values, and what is left of runs once names and values are cut out of them."""
    name = r"(?i:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)"
    values = [(m.start(), m.start(1), m.end(1)) for m in re.finditer(name + r"[\"']?\s{0,4}[:=]\s{0,4}[\"']?([^\s\"',;]{8,})", text)]
    out = {(a, b) for _, a, b in values}
    for m in re.finditer(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{16,}", text):
        free, piece = [i for i in range(*m.span()) if not any(n <= i < b for n, _, b in values)], []
        for i in [*free, None]:
            if piece and (i is None or i != piece[-1] + 1):
                a, b = piece[0], piece[-1] + 1
                while g := re.match(r"[A-Za-z_][A-Za-z0-9_.-]*=(?=[^=]{16})", text[a:b]):
                    if secrets._is_run(text[a : a + g.end() - 1]):
                        out.add((a, a + g.end() - 1))
                    a += g.end()
                if secrets._is_run(text[a:b]):
                    out.add((a, b))
                piece = []
            if i is not None:
                piece.append(i)
    return sorted(out)


def test_candidates_are_those_of_a_plain_search():
    rng = np.random.default_rng(9)
    bits = ["token", "secret=", "password: ", "api_key='", "AWS_ACCESS_KEY=", "name=", "x", " ", '"', "=", "-", "3c4226790fc3f8022bcc", "hunter2hunter2x", "/usr/lib/python", "&%!", "abcdefghijklmnopqrst", "1234567890123456", ",", "\n", "é", "Tr0ub4dor&3-long"]
    for _ in range(3000):
        text = "".join(rng.choice(bits, int(rng.integers(1, 14))))
        assert [(a, b) for a, b, _ in secrets.candidates(text)] == brute_candidates(text), text


@pytest.mark.parametrize("alphabet", ["0123456789abcdef", "abcdefghijkXYZ0123456789&%!$@-", "ABCDEFabcdef0123456789+/"])
def test_nothing_of_a_long_value_is_left(spark, alphabet):
    value = "".join(np.random.default_rng(10).choice(list(alphabet), 10_000))
    texts = [f'so password="{value}" end', f"so token={value} end", f"so secret: '{value}'; end", f"my API_KEY = {value}\nend"]
    hidden = secrets.redacted(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    for r, t in zip(hidden, texts, strict=True):
        assert r["text"] == t.replace(value, "<SECRET>")


def test_small_announced_values():
    forest = secrets.default_forest()
    texts = ["so token=3c4226790fc3f8022bcc4434e93601b2005f1325 x", "so token=hunter2hunter2x x", "so secret=" + "3c42f6790f" * 120 + " x"]
    for t in texts:
        (_, spans), = secrets.secrets([t], forest)
        assert [t[a:b] for a, b in spans] == [t.split("=")[1].split(" ")[0]]


@pytest.mark.parametrize(("classes", "hashes"), [(1000, 2), (200_000, 3), (10**8, 4)])
def test_recall_of_shapes(classes, hashes):
    """Pairs at a cosine of exactly the threshold share a bucket, whatever the size of the table."""
    got = embed.shape(classes, 64)
    assert got[0] == hashes
    rng = np.random.default_rng(11)
    x, z = rng.normal(size=(2, 1500, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    z -= (z * x).sum(1)[:, None] * x
    z /= np.linalg.norm(z, axis=1)[:, None]
    y = embed.LEAST * x + (1 - embed.LEAST**2) ** 0.5 * z
    a, b = embed.codes(x, *got), embed.codes(y, *got)
    assert (a[:, :, :, None] == b[:, :, None, :]).any((1, 2, 3)).mean() > 0.99
    spread = Counter(a[:, 0, 0].tolist())
    assert max(spread.values()) < 30 and (np.diff(a.min(2), axis=1) > 0).all()


@pytest.mark.parametrize("unlike", [8, 1e-4])
def test_links_of_any_shape(spark, unlike, monkeypatch):
    """More hashes a bucket, as larger tables have, find the links that brute force does."""
    monkeypatch.setattr(embed, "UNLIKE", unlike)
    rng = np.random.default_rng(12)
    centers = rng.normal(size=(60, 64))
    v = [(centers[i % 60] + rng.normal(size=64) * 0.18).astype("f4") for i in range(400)]
    df = spark.createDataFrame([(i, x.tolist(), i % 2) for i, x in enumerate(v)], "vec_id long, embedding array<float>, label int")
    u = np.array(v, float)
    u /= np.linalg.norm(u, axis=1)[:, None]
    same = np.arange(400) % 2
    linked = (u @ u.T >= 0.93) & (same[:, None] == same[None]) & ~np.eye(400, dtype=bool)
    got = {r["vec_id"]: r["n_links"] for r in embed.near_duplicates(df).collect()}
    assert linked.sum() > 500 and all(got[i] <= linked[i].sum() for i in got)
    assert sum(got.values()) >= 0.99 * linked.sum()


def test_words_are_those_of_the_contract(spark):
    text = "a b c\td\x0be\x0cf\rg\nh  i"
    assert spark.createDataFrame([(text,)], "t string").select(mixing.size_of(F.col("t")).alias("n")).first()["n"] == len(words_of(text))
