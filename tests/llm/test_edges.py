"""Odd tables: null ids, repeated rows, null, empty and long texts, no rows, and extra columns with any names."""

import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from loam.llm import embed, fingerprint, mixing, packing, pii, quality, secrets, sharding, simhash, substring

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
SECRET = "3c4226790fc3f8022bcc4434e93601b2005f1325"
#: Names that helper columns of the operators have, or once had.
CLASHES = (
    "_id _mark _source _pass _score _accepted id mark of pass negative order score accepted row key crc size part shard slot range bytes n start rank fp sketch node component component_id first least "
    "h g grp rep vector codes items after after_items new changed keep take n_chars_ _hash _range _ghost _step _at doc starts kept words target source_size before finish fits span at taken base more spans"
).split()


@pytest.fixture(scope="module")
def odd(spark):
    rng = random.Random(3)
    words = "an er th in on reads the other thing rather well its own été über".split()
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    same, shared = text(60), text(30)
    rows = [(i, text(rng.randint(1, 90)), "en", f"src{i % 3}") for i in range(30)]
    rows += [(i, f"{text(9)} {shared} {text(4)}", "en", "src0") for i in range(30, 36)]
    rows += [(36, same, "fr", None), (36, same, "fr", None), (None, same, "fr", "src1"), (None, text(40), None, "src1"), (None, None, None, None), (None, "", "en", "src2"), (37, None, None, None), (38, " \t\n", "de", "src2")]
    rows += [(39, f'so token = "{SECRET}" mail a.b@c.de or +1 (234) 555-6789', "en", "src1"), (40, text(9000), "en", "src0"), (41, "z" * 30_000, "en", "src0"), (42, same, "en", "src1")]
    return spark.createDataFrame([(*r, len(r[1]) if r[1] else None) for r in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, 0) for i in range(40)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")


def with_clashes(df):
    return df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASHES) if c not in df.columns])


def plain(rows):
    return sorted(map(repr, rows))


OPERATORS = {
    "fingerprints": lambda d, l: fingerprint.document_fingerprints(d),
    "mixing": lambda d, l: mixing.mix_figures(d),
    "simhash": lambda d, l: simhash.near_duplicates(d),
    "quality": lambda d, l: quality.quality(d, l),
    "packing": lambda d, l: packing.pack(d, TOKENIZER).groupBy("doc_id", "doc_tokens").agg(F.sum("length").alias("length")),
    "pii": lambda d, l: pii.personal_data(d),
    "substring": lambda d, l: substring.repeats_removed(d),
    "sharding": lambda d, l: sharding.shard(d, 5),
    "secrets": lambda d, l: secrets.scan(d),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_operators_take_odd_tables(odd, labels, name):
    run = OPERATORS[name]
    got = run(odd, labels).collect()
    assert plain(run(with_clashes(odd), labels).collect()) == plain(got)
    empty = run(with_clashes(odd).limit(0), labels)
    assert empty.count() == 0 and empty.columns == run(odd, labels).columns
    if name not in ("packing", "sharding"):
        assert plain([r["doc_id"] for r in got]) == plain([r["doc_id"] for r in odd.collect()])
        same = {36: set()}
        for r in got:
            if r["doc_id"] == 36:
                same[36].add(repr({k: v for k, v in r.asDict().items() if k not in ("slot", "taken", "first_at", "near_next", "near_edited", "edited_sha256", "edited_fingerprint")}))
        assert len(same[36]) == 1


@pytest.mark.parametrize("number", range(5))
def test_stages_take_odd_tables(spark, odd, number, tmp_path):
    """Each stage keeps all columns, whatever their names, and gives the same rows as without them."""
    spark.createDataFrame([(i, i % 2, 0) for i in range(40)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    name, stage = corpus_pipeline.STAGES[number]
    wide = with_clashes(odd)
    got, bare = stage(spark, wide, str(tmp_path)), stage(spark, odd, str(tmp_path))
    if name != "packing":
        assert got.columns == wide.columns and plain(got.select(*odd.columns).collect()) == plain(bare.collect())
    else:
        assert got.columns == bare.columns and got.agg(F.sum("length")).first() == bare.agg(F.sum("length")).first()
    assert stage(spark, wide.limit(0), str(tmp_path)).count() == 0
    if name == "dedup":
        kept = bare.collect()
        assert [r["doc_id"] for r in kept if r["text"] is None or not r["text"].strip()] == [37] and sum(r["doc_id"] == 36 for r in kept) == 1
    if name == "secrets":
        assert bare.where(F.col("text").contains(SECRET)).count() == 0 and bare.count() == odd.count()
    if name == "mixing":
        assert bare.where("text is null or trim(text) = ''").count() == 0


def test_embeddings_of_odd_tables(spark):
    a, b = [1.0, 2.0, 3.0, 4.0], [-1.0, 2.0, 0.5, 0.0]
    rows = [(1, a, 1), (1, a, 1), (None, a, 1), (2, b, 1), (None, b, 2), (None, None, 1), (3, [2.0, 4.0, 6.0, 8.1], 1), (4, a, None), (4, a, 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = embed.near_duplicates(df).collect()
    expected = [(1, 3, 1, True), (1, 3, 1, True), (None, 3, 1, False), (2, 0, 2, True), (None, 0, None, False), (None, 0, None, False), (3, 3, 1, False), (4, 0, 4, True), (4, 0, 4, True)]
    assert plain(map(tuple, got)) == plain(expected)
    wide = df.select("*", *[F.lit(1).alias(c) for c in (*CLASHES, "links", "members", "sound", "root", "code", "block") if c not in df.columns])
    assert plain(map(tuple, embed.near_duplicates(wide).collect())) == plain(expected)
    assert embed.near_duplicates(wide.limit(0)).count() == 0


def test_embeddings_keep_their_precision(spark):
    """In single precision both pairs would have the cosine 0.93 or less."""
    c = 0.93
    above, below = [c + 1e-9, (1 - (c + 1e-9) ** 2) ** 0.5], [c - 1e-9, (1 - (c - 1e-9) ** 2) ** 0.5]
    df = spark.createDataFrame([(0, [1.0, 0.0], 1), (1, above, 1), (2, [1.0, 0.0], 2), (3, below, 2)], "vec_id long, embedding array<double>, label int")
    assert {r["vec_id"]: r["n_links"] for r in embed.near_duplicates(df).collect()} == {0: 1, 1: 1, 2: 0, 3: 0}


def test_one_id_of_many_rows_spreads(spark):
    """Rows of one id, or of none, are cut into ranges by their text, and follow one another over the ranges' ends."""
    rows = [(7 if i % 3 == 0 else None if i % 3 == 1 else i, f"text number {i} " * (i % 5 + 1)) for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    ranged = fingerprint.in_descending_ranges(df, 8)
    sizes = [r["n"] for r in ranged.groupBy("_range").agg(F.sum(F.length("text")).alias("n")).collect()]
    assert len(sizes) == 8 and max(sizes) < 1.7 * sum(sizes) / 8
    assert ranged.where("_ghost").count() == 8
    lie = ranged.select("_range", F.spark_partition_id().alias("at")).distinct().collect()
    assert len(lie) == len({r["at"] for r in lie}) == 8
    assert fingerprint.document_fingerprints(df)._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    order = [r["text"] for r in df.orderBy(F.desc_nulls_last("doc_id"), F.desc(F.xxhash64("text"))).collect()]
    after = dict(zip(order, [*order[1:], order[0]], strict=True))
    got = fingerprint.document_fingerprints(df).groupBy("doc_id", "edited_sha256").count().collect()
    import hashlib

    expected = {hashlib.sha256((t[: len(t) - len(t) // 2] + after[t][: len(t) // 2]).encode()).hexdigest() for t in order}
    assert {r["edited_sha256"] for r in got} == expected and sum(r["count"] for r in got) == 900


def test_places_beyond_a_lap(spark, monkeypatch):
    rng = random.Random(8)
    texts = [(i, " ".join(f"w{rng.randrange(10_000)}" for _ in range(n))) for i, n in enumerate((5, 40, 300))]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    plain_places = [r["positions"] for r in fingerprint.fingerprints(df).orderBy("doc_id").collect()]
    monkeypatch.setattr(fingerprint, "PLACE", 4)
    assert [r["positions"] for r in fingerprint.fingerprints(df).orderBy("doc_id").collect()] == plain_places and plain_places[2][-1] > 200
