"""Every operator against a plain version of its contract, on documents with all the odd cases."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests_llm_helpers import brute_components, brute_simhash, reach, words_of

from loam.llm import embed, fingerprint, mixing, packing, pii, quality, secrets, sharding, simhash, substring

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def test_fingerprints(spark, docs, rows, none):
    got = fingerprint.document_fingerprints(docs).collect()
    assert len(got) == len(rows)
    order = sorted(rows, key=lambda r: -r[0])
    texts = [r[1] or "" for r in order]
    expected = []
    for i, t in enumerate(texts):
        half, after = len(t) // 2, texts[(i + 1) % len(texts)]
        expected.append((order[i][0], t[: len(t) - half] + after[:half]))
    plain = {(r["doc_id"], r["edited_sha256"]): r for r in got}
    assert len(plain) == len({r[0] for r in rows}) + 1
    direct = spark.createDataFrame(expected, "doc_id long, text string")
    direct = {(r["doc_id"], hashlib.sha256(r["text"].encode()).hexdigest()): r["fingerprint"] for r in fingerprint.fingerprints(direct).collect()}
    assert set(direct) == set(plain)
    assert all(plain[k]["edited_fingerprint"] == v for k, v in direct.items())
    by_text = defaultdict(set)
    text_of = defaultdict(set)
    for r in rows:
        text_of[r[0]].add(r[1] or "")
    for r in got:
        (text,) = text_of[r["doc_id"]]
        by_text[text].add(r["fingerprint"])
        assert r["n_chars"] == len(text) and 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        assert (r["fingerprint"] == "") == (not words_of(text))
    assert all(len(v) == 1 for v in by_text.values())
    assert fingerprint.document_fingerprints(none).count() == 0


def test_winnowing_is_that_of_every_window(spark):
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice(["a", "b", "cc", "d"], n)) for n in (1, 3, 4, 5, 11, 12, 200)]
    got = fingerprint.fingerprints(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    grams = spark.createDataFrame([(i, j, *(words[j + k] if j + k < len(words) else None for k in range(4))) for i, t in enumerate(texts) for words in [t.split()] for j in range(max(1, len(words) - 3))], "d long, j long, a string, b string, c string, e string")
    h = defaultdict(dict)
    for r in grams.selectExpr("d", "j", "shiftrightunsigned(xxhash64(a, b, c, e), 24) h").collect():
        h[r["d"]][r["j"]] = r["h"]
    for i, r in enumerate(got):
        hs = [h[i][j] for j in sorted(h[i])]
        chosen = []
        for j in range(max(1, len(hs) - 7)):
            window = range(j, min(len(hs), j + 8))
            best = min(window, key=lambda p: (hs[p], -p))
            if best not in chosen:
                chosen.append(best)
        assert r["positions"] == chosen
        assert r["fingerprint"] == "".join(f"{hs[p]:010x}" for p in chosen)


def test_runs_without_spaces_share_grams_at_any_offset(spark):
    rng = np.random.default_rng(12)
    for alphabet in ("日本語文章検索重複文書比較", "abcdefghijklmnop0123456789+/", "w\u00a0"):
        run = "".join(rng.choice(list(alphabet), 400))
        texts = [run, "X" + run, "Yyyyy" + run[100:300] + "Z", "".join(reversed(run)) if "w" not in alphabet else "q" * 300]
        items = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("items", fingerprint.selected(F.col("text")))
        got = [r["h"] for r in items.orderBy("doc_id").select(fingerprint.hashes(F.col("items")).alias("h")).collect()]
        shared = [len(set(got[0]) & set(h)) / len(set(h)) for h in got[1:]]
        assert shared[0] > 0.9 and shared[1] > 0.8 and shared[2] < 0.2
    assert fingerprint.fingerprints(spark.createDataFrame([("a bb " + "c" * 16 + " dd e" * 5,)], "text string")).first()["positions"][-1] < 13


def test_mixing(docs, rows, none):
    got = mixing.mix_figures(docs).collect()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(words_of(r[1]))
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((r[0], len(words_of(r[1]))) for r in rows)
    source = {r[0]: r[3] for r in rows}
    wanted, taken = mixing.targets(dict(sizes)), Counter()
    for r in got:
        s = source[r["doc_id"]]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(wanted[s])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[s] += r["taken"]
    assert all(abs(taken[s] - wanted[s]) <= 1 for s in sizes)
    assert sorted(map(str, mixing.mix_figures(docs.repartition(3)).collect())) == sorted(map(str, got))
    assert mixing.mix_figures(none).count() == 0
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns
    by_doc = Counter(r["doc_id"] for r in mixed.collect())
    full = {r["doc_id"]: r["taken"] / r["size"] for r in got if r["size"]}
    assert all(abs(by_doc[d] - full[d]) <= 1 for d in full if d != 125)


def test_targets():
    assert mixing.targets({"a": 100, "b": 100, None: 100}) == pytest.approx({"a": 50, "b": 100, None: 150})
    assert mixing.targets({"a": 10, "b": 290}) == pytest.approx({"a": 30, "b": 270})
    assert mixing.targets({}) == {} and mixing.targets({"a": 0}) == {"a": 0}


@pytest.fixture(params=[None, (40, 2, 16)])
def bucket_sizes(request, monkeypatch):
    """Small limits, so that buckets are compared by reaching, cut into chunks and split into pairs of blocks."""
    for name, value in zip(("CHUNK", "SMALL", "SPLIT"), request.param or (), strict=False):
        monkeypatch.setattr(simhash, name, value)


def test_simhash(docs, rows, none, bucket_sizes):
    got = simhash.near_duplicates(docs).collect()
    fp = {r[0]: brute_simhash(r[1]) for r in rows}
    edges = [(a, b) for a in fp for b in fp if a < b and (fp[a] ^ fp[b]).bit_count() <= 4]
    label = reach(fp, edges)
    assert Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got) == Counter((r[0], f"{fp[r[0]]:016x}", label[r[0]]) for r in rows)
    assert simhash.near_duplicates(none).count() == 0


NODES = "node long, fp long, sketch long, choice long"


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def chains(rng, flips):
    """Fingerprints of which each differs from the one before in a few bits."""
    fps = set()
    for _ in range(12):
        x = int(rng.integers(0, 1 << 63)) * 2 + int(rng.integers(0, 2))
        for _ in range(25):
            fps.add(x)
            for b in rng.choice(64, int(rng.integers(1, flips)), replace=False):
                x ^= 1 << int(b)
    return sorted(fps)


@pytest.mark.parametrize("rule", [simhash.FINGERPRINTS, simhash.Rule(radius=8, parts=3), simhash.NEAR_COPIES])
def test_links_of_close_numbers(spark, rule, bucket_sizes):
    """Chains and balls of fingerprints: every pair within the radius is connected, and no other."""
    rng = np.random.default_rng(7)
    fps = chains(rng, 12 if rule.radius > 4 else 6)
    ball = int(rng.integers(0, 1 << 63))
    fps += sorted({ball} | {ball ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 64, (150, 2))} - set(fps))
    sketch = [int(rng.integers(0, 1 << 21)) << 43 if rule.sketched else 0 for _ in fps]
    rows = [(i, signed(f), signed(s), 0) for i, (f, s) in enumerate(zip(fps, sketch, strict=True))]
    links = simhash.links(spark.createDataFrame(rows, NODES), rule).collect()

    def close(a, b):
        return (fps[a] ^ fps[b]).bit_count() <= rule.radius and (sketch[a] ^ sketch[b]).bit_count() <= rule.apart

    true = [(a, b) for a in range(len(fps)) for b in range(a) if close(a, b)]
    assert reach(range(len(fps)), true) == reach(range(len(fps)), [(r["a"], r["b"]) for r in links])


@pytest.mark.parametrize("parts", [2, 3, 4])
def test_variants(spark, parts):
    """Each part's value and what differs from it in one bit, apart by the number of the part."""
    x = 0xF123456789ABCDEF
    got = spark.createDataFrame([(signed(x),)], "fp long").select(simhash._variants(F.col("fp"), parts).alias("v")).first()["v"]
    cuts, expected = [round(i * 64 / parts) for i in range(parts + 1)], []
    for p, (low, high) in enumerate(zip(cuts, cuts[1:], strict=False)):
        part = (x >> low) % (1 << (high - low)) + (p << (high - low))
        expected += [part] + [part ^ (1 << i) for i in range(high - low)]
    assert got == expected and len(set(got)) == 64 + parts


def test_a_large_ball_leaves_one_row_a_member(spark):
    """10,000 near copies in one bucket: links grow with the members, not with their pairs."""
    rng = np.random.default_rng(2)
    high = sorted({sum(1 << int(b) for b in rng.choice(32, 4, replace=False)) for _ in range(14_000)})[:10_000]
    rows = [(i, signed(h << 32 | 12345), 0, 0) for i, h in enumerate(high)]
    links = simhash.links(spark.createDataFrame(rows, NODES))
    got = links.collect()
    assert len(got) <= 66 * len(rows) and set(reach(range(len(rows)), [(r["a"], r["b"]) for r in got]).values()) == {0}


def test_embeddings(spark):
    rng = np.random.default_rng(5)
    rows, i = [], 0
    for c in range(40):
        center = rng.normal(size=64)
        for _ in range(int(rng.integers(1, 12))):
            v = (center + rng.normal(size=64) * rng.choice([0, 0.15, 0.3])).astype("f4").tolist()
            rows += [(i, v, c % 4)] + ([(i + 1, v, c % 4)] if i % 7 == 0 else [])
            i += 2
    rows += [(i, None, 1), (i + 1, [0.0] * 64, 1), (i + 2, [float("nan")] * 64, 1), (i + 3, rows[0][1], None), (i + 4, [], 1), (i + 5, [1.0, None], 1), (i + 6, [2.0, 3.0], 1), (i + 7, [4.0, 6.0], 1)]
    got = {r["vec_id"]: r for r in embed.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(5)).collect()}
    assert len(got) == len(rows)
    good = [(a, np.array(v, float), l) for a, v, l in rows if v and l is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    edges = [(a, b) for a, x, l in good for b, y, m in good if a < b and l == m and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.93]
    n = Counter(x for e in edges for x in e)
    assert all(got[a]["n_links"] <= n[a] for a, _, _ in rows)
    assert sum(r["n_links"] for r in got.values()) >= 0.97 * 2 * len(edges)
    label = reach([r[0] for r in rows], edges)
    assert np.mean([got[a]["component_id"] == label[a] for a in label]) > 0.97
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.values())
    assert embed.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_crowded_bucket(spark, monkeypatch):
    """Blocks of a bucket lose no link and count none twice."""
    monkeypatch.setattr(embed, "BLOCK", 16)
    rng = np.random.default_rng(6)
    center = rng.normal(size=32)
    rows = [(i, (center + rng.normal(size=32) * 0.05).astype("f4").tolist(), 1) for i in range(150)]
    got = embed.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()
    assert {r["component_id"] for r in got} == {0} and {r["n_links"] for r in got} == {149}


def test_quality(spark):
    rng = np.random.default_rng(8)
    words = ["the", "other", "thing", "reads", "rather", "well", "on", "its", "own"]
    rows, labels = [], []
    for i in range(600):
        w = rng.choice(words, int(rng.integers(20, 120)))
        bad = i % 3 == 0
        text = (" | ".join(w) if i % 2 else " ".join(x.upper() + "!!" for x in w)) if bad else " ".join(w).capitalize() + "."
        rows.append((i, text))
        labels.append((i, int(not bad), 0))
    rows += [(600, ""), (601, None), (None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in quality.quality(docs, known).collect()}
    assert len(got) == len(rows)
    held = [i for i in range(600) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(got[i]["held_out"] == (i in set(held)) for i in range(600))
    assert np.mean([got[i]["predicted"] == labels[i][1] for i in held]) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got.values())
    nothing = quality.quality(docs, known.limit(0)).collect()
    assert len(nothing) == len(rows)
    assert quality.quality(docs.limit(0), known).count() == 0


def test_packing(docs, rows, none):
    got = packing.pack(docs, TOKENIZER).collect()
    encode = Tokenizer.from_file(TOKENIZER).encode
    ids = {r[0]: np.array([*encode(r[1] or "", add_special_tokens=False).ids, 2], "<u4") for r in rows}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        own = ids[r["doc_id"]]
        assert r["doc_tokens"] == len(own) and r["length"] > 0
        assert zlib.crc32(own[r["start"] : r["start"] + r["length"]].tobytes()) == r["ids_crc32"]
        pieces[r["doc_id"]].append((r["start"], r["length"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    copies = Counter(r[0] for r in rows)
    for d, own in pieces.items():
        seen = np.zeros(len(ids[d]), int)
        for a, n in own:
            seen[a : a + n] += 1
        assert (seen == copies[d]).all()
    assert set(pieces) == set(ids)
    padding = 0
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 4096
        padding += 0 if at.bit_count() == 1 else 4096 - at
    assert padding == 0
    assert packing.pack(none, TOKENIZER).count() == 0


def test_words_give_the_tokenizer_ids():
    from loam.llm.tokens import document_ids

    texts = ["It's the DOG'S 42nd étude, n'est-ce pas?", "ΑΣ ς Σ", "a b c\x1cd\x85e", "x<|endoftext|>y", "½ ² ª º µ ÿ ß", "é é ﬁ", "日本語 😀 don't", "  \n\n ", "İI ǅ", "a" * 300]
    ids, whole = document_ids(TOKENIZER), Tokenizer.from_file(TOKENIZER)
    for t in texts:
        assert np.frombuffer(ids(t), "<u4").tolist() == whole.encode(t, add_special_tokens=False).ids


BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute_pii(text):
    out = []
    for k, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")) or kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            if kind == "card":
                total = sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits)))
                if not 14 <= len(digits) <= 19 or total % 10:
                    continue
            out.append((m.start(), k, m.end()))
    return [f"{list(BASE)[k]}:{a}:{b}" for a, k, b in sorted(out)]


def test_pii(spark, docs, none):
    rng = np.random.default_rng(9)
    bits = ["4111 1111 1111 1111", "4111-1111-1111-1112", "a.b@c.de", "@x.y", "a@b@c.org", "a@b..c", "x@y.", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "1.2.3.04", "+1 (234) 555-6789", "+12", "+1-2-3-4-5-6-7-8-9-0-", "12345678901234567890", "é", " ", ".", "-", "+", "@", "5", "call 555-123-4567", "john at example dot com", "mail: jo (at) ex (dot) org", "card 4111 1111 1111 1113", "0" * 30, "a" * 50]
    texts = ["".join(rng.choice(bits, int(rng.integers(1, 12)))) for _ in range(400)] + ["", None, "1" * 6000, "+" * 500, "a@" * 500, "1.1.1.1." * 50]
    got = pii.personal_data(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert len(got) == len(texts)
    for r in got:
        own = brute_pii(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(",".join(own).encode()).hexdigest(), texts[r["doc_id"]]
        spans = r["spans"].split(",") if r["spans"] else []
        assert not Counter(own) - Counter(spans)
        assert [r[f"n_{k}"] for k in BASE] == [sum(s.startswith(k) for s in own) for k in BASE]
    assert pii.personal_data(none).count() == 0


def test_spelled_out_addresses_need_no_other_word():
    texts = ["mail: jane [at] example.com", "jane (at) example (Dot) com", "jane at example [dot] com", "we met at home. Then"]
    more = [pii.scan(t)[1] for t in texts]
    assert [t[m[1] : m[2]] for t, m in zip(texts, more, strict=True) if m] == ["jane [at] example.com", "jane (at) example (Dot) com", "jane at example [dot] com"]


def test_pii_without_words_before(spark):
    """The classifier decides alone: what it takes for likely is added in any context."""
    texts = ["write to jane [at] example [dot] com now", "the jane [at] example [dot] com now"] + [f"mail: ab{i}@cd.com now" for i in range(40)] + [f"so ab{i}@cd.com now" for i in range(40)] + [f"so 256.1.{i}.1 now" for i in range(40)]
    got = {r["doc_id"]: r["spans"] for r in pii.personal_data(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [got[0], got[1]] == ["email:9:36", "email:4:31"] and not any(got[i] for i in range(82, 122))


def brute_repeats(rows):
    first, texts = {}, sorted(((r[0], r[1]) for r in rows), key=lambda r: r[0])
    for d, t in texts:
        w = words_of(t)
        for i in range(len(w) - 19):
            k = tuple(w[i : i + 20])
            first[k] = min(first.get(k, (d, i)), (d, i))
    out = []
    for d, t in texts:
        w = words_of(t)
        gone = set()
        for i in range(len(w) - 19):
            if first[tuple(w[i : i + 20])] < (d, i):
                gone |= set(range(i, i + 20))
        kept = [x for i, x in enumerate(w) if i not in gone]
        out.append((d, len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return out


@pytest.mark.parametrize("together", [substring.TOGETHER, 50])
def test_substring(docs, rows, none, together, monkeypatch):
    monkeypatch.setattr(substring, "TOGETHER", together)
    got = [tuple(r) for r in substring.repeats_removed(docs).collect()]
    assert sorted(got) == sorted(brute_repeats(rows))
    assert substring.repeats_removed(none).count() == 0


def test_repeated_ids_lose_nothing(spark):
    a, b = " ".join(f"w{i}" for i in range(40)), " ".join(f"v{i}" for i in range(40))
    docs = spark.createDataFrame([(1, a), (1, b), (None, a), (None, b), (2, b)], "doc_id long, text string")
    got = Counter((r["doc_id"], r["n_removed"]) for r in substring.repeats_removed(docs).collect())
    assert got == Counter({(1, 0): 2, (None, 40): 2, (2, 40): 1})


def test_sharding(spark, docs, rows, none):
    got = sharding.shard(docs, 8).collect()
    texts = {r[0]: (r[1] or "").encode() for r in rows}
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in rows)
    slots, bytes_ = defaultdict(list), Counter()
    for r in got:
        assert r["size"] == len(texts[r["doc_id"]]) + 16 and r["text_crc32"] == zlib.crc32(texts[r["doc_id"]])
        slots[r["shard"]].append(r["slot"])
        bytes_[r["shard"]] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(8))
    assert sharding.shard(none).count() == 0
    many = spark.createDataFrame([(i, "copy of one text" if i % 3 == 0 else f"text number {i} " * (i % 7)) for i in range(3000)], "doc_id long, text string")
    even = Counter()
    for r in sharding.shard(many, 8).collect():
        even[r["shard"]] += r["size"]
    assert max(even.values()) < 1.05 * sum(even.values()) / 8 and min(even.values()) > 0.95 * sum(even.values()) / 8


def test_secrets(spark, docs, none):
    x, y = secrets.labelled_findings(2000, seed=77)
    assert np.mean((secrets.default_forest().predict(x) >= secrets.ACCEPT) == y) > 0.95
    key = "3c4226790fc3f8022bcc4434e93601b2005f1325"
    texts = [f'so token = "{key}" here', "a donaudampfschifffahrtsgesellschaft here", None, "", f'TOKEN = "{key.upper()}"!!', "x" * 40_000, 'the password: "hunter2-Ab9-zz" is']
    found = secrets.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r["n_secrets"] for r in found] == [1, 0, 0, 0, 1, 0, 1]
    a, b = map(int, found[0]["spans"].split(":"))
    assert texts[0][a:b] == key
    hidden = secrets.redacted(spark.createDataFrame([(0, texts[0], 5)], "doc_id long, text string, n_chars int")).first()
    assert hidden["text"] == 'so token = "<SECRET>" here' and hidden["n_chars"] == len(hidden["text"])
    assert secrets.scan(docs).count() == docs.count() and secrets.scan(none).count() == 0


def test_announced_values_are_masked_whole(spark):
    key, phrase = "3c4226790fc3f8022bcc4434e93601b2005f1325", "".join(np.random.default_rng(4).choice(list("abcdefghijkXYZ0123456789&%!$@-"), 400))
    texts = ["so PASSWORD=Tr0ub4dor&3-longtail here", f"the password: {phrase} end", f"my AWS_SECRET_ACCESS_KEY={key} is", f"so token=https://a.b.org/d?sig={key}&e=1 it"]
    hidden = secrets.redacted(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r["text"] for r in hidden] == ["so PASSWORD=<SECRET> here", "the password: <SECRET> end", "my AWS_SECRET_ACCESS_KEY=<SECRET> is", "so token=<SECRET> it"]
    glued = f"{key}-password=abcdefgh12 x" * 2
    spans = [s[:2] for s in secrets.candidates(glued)]
    assert all(b <= c for (_, b), (c, _) in zip(spans, spans[1:], strict=False)) and (0, 41) in spans


def test_long_values_are_judged_to_their_end():
    key, path = "3c4226790fc3f8022bcc4434e93601b2005f1325", "/usr/share/" + "/".join(["library", "modules", "handler"] * 40)
    texts = ["token = " + "=" * 600 + key + " x", "so " + "-" * 700 + " x", f"in {path} x", "token = " + "your_api_key_" * 60]
    assert [len(s) for _, s in secrets.secrets(texts, secrets.default_forest())] == [1, 0, 0, 0]


@pytest.mark.parametrize("rule", [simhash.FINGERPRINTS, simhash.NEAR_COPIES])
def test_one_document_of_each_component(spark, docs, rows, rule):
    kept = simhash.one_of_each(docs, rule)
    assert kept.columns == docs.columns
    label = brute_components({r[0]: r[1] for r in rows}, rule)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(label.values()))
    odd = spark.createDataFrame([(None, "a b c d e"), (None, "a b c d e"), (3, "a b c d e"), (3, "q r s t u v w"), (3, "q r s t u v w"), (None, "z z z y y y")], "doc_id long, text string")
    assert sorted(map(str, (r["doc_id"] for r in simhash.one_of_each(odd, rule).collect()))) == ["3", "3", "None"]


@pytest.mark.parametrize(("nodes", "samples"), [(10**6, 0), (3 * 10**6, 1), (10**8, 2), (10**9, 3)])
def test_larger_tables_lose_no_near_copies(nodes, samples, spark, monkeypatch):
    """Texts of which one word in 150 differs are one component, however many samples a bucket is made up with."""
    assert simhash.chosen(nodes, simhash.NEAR_COPIES) == samples and simhash.chosen(nodes, simhash.FINGERPRINTS) == 0
    monkeypatch.setattr(simhash, "UNLIKE", simhash.UNLIKE * 40 / nodes)
    rng = np.random.default_rng(13)
    texts = []
    for g in range(40):
        base = [f"w{int(x)}" for x in rng.integers(0, 5000, 300)]
        for c in range(3):
            own = list(base)
            for at in rng.choice(300, 2 if c else 0, replace=False):
                own[at] = f"new{g}{c}{at}"
            texts.append(" ".join(own))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = [r["doc_id"] for r in simhash.one_of_each(docs).select("doc_id").collect()]
    assert set(range(0, 120, 3)) <= set(kept) and len(kept) <= 40 + 3


@pytest.mark.parametrize("unlike", [simhash.UNLIKE, 1e-3, 1e-9])
def test_links_are_the_same_at_any_size(spark, unlike, bucket_sizes, monkeypatch):
    """Unlike nodes of one bucket and, of each, one at both limits, one beyond either: whatever the size that a table is taken for and
    whatever other samples of their shingles are, those within the limits are connected, and no others."""
    monkeypatch.setattr(simhash, "UNLIKE", unlike)
    rng = np.random.default_rng(17)
    flipped = lambda x, bits: x ^ sum(1 << int(b) for b in rng.choice(64, bits, replace=False))
    nodes = []
    for _ in range(150):
        fp, sketch = int(rng.integers(0, 1 << 47)) << 16 | 0xBEEF, int(rng.integers(0, 1 << 63))
        nodes += [(fp, sketch), (flipped(fp, 11), flipped(sketch, 10)), (flipped(fp, 12), sketch), (fp, flipped(sketch, 11))]
    rows = [(i, signed(f), signed(s), int(rng.integers(0, 1 << 60))) for i, (f, s) in enumerate(nodes)]
    assert (simhash.chosen(len(rows), simhash.NEAR_COPIES) > 0) == (unlike < 1)
    links = simhash.links(spark.createDataFrame(rows, NODES), simhash.NEAR_COPIES).collect()
    near = [(a, b) for a, (f, s) in enumerate(nodes) for b, (g, t) in enumerate(nodes[:a]) if (f ^ g).bit_count() <= 11 and (s ^ t).bit_count() <= 10]
    got = reach(range(len(nodes)), [(r["a"], r["b"]) for r in links])
    assert got == reach(range(len(nodes)), near) and all(got[i] == got[i + 1] for i in range(0, len(nodes), 4))


@pytest.mark.parametrize("apart", [2, 10, 13])
def test_meetings_lose_no_close_sketches(apart, monkeypatch):
    """Sketches as far apart as the rule allows have a key in common, in which all that share it come at once."""
    monkeypatch.setattr(simhash, "CHUNK", 100)
    rng = np.random.default_rng(18)
    a = rng.integers(0, 1 << 63, 200, dtype="u8")
    b = a ^ np.array([sum(1 << int(i) for i in rng.choice(64, apart, replace=False)) for _ in a], "u8")
    met = set()
    for keys, members in simhash._meetings(np.r_[a, b], simhash.Rule(apart=apart).sketch_parts):
        assert (keys[1:] >= keys[:-1]).all()
        for k in np.unique(keys):
            here = set(members[keys == k].tolist())
            met |= {i for i in here if i + 200 in here}
    assert met == set(range(200))


def test_unlike_short_texts_stay(spark):
    """Few shingles set few bits, so that fingerprints of unlike short texts are close: their sketches keep them apart."""
    texts = [f"w{i} x{i} y{i} z{i} v{i} u{i}" for i in range(3000)]
    assert simhash.one_of_each(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).count() == len(texts)
