"""Mixing sources to target weights by weighted fair queueing.

Each source's documents are shuffled by a hash of their ids. A document's virtual finish time is the words of its source
up to and with it, divided by the source's target; a source that must be repeated goes on in a second and third pass. All
are sorted by that time over ranges of it, and the mix ends at the budget, the words of all sources. The document that
crosses its source's target is cut there.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, partitions, saved, unused, with_offsets

WEIGHTS, MOST_PASSES, SEED = (1, 2, 3), 3, 42
#: Rows of a table of sources up to which it is broadcast; with more sources it is joined by them.
MOST_BROADCAST = 10_000


def targets(sizes: dict[str | None, int], weights: tuple[int, ...] = WEIGHTS, most: int = MOST_PASSES) -> dict[str | None, float]:
    """Words by source. Shares go by weight; what is above `most` times a source's size is shared again by the others."""
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, out = float(sum(sizes.values())), list(order), {}
    while open_:
        total = sum(weight[s] for s in open_)
        full = [s for s in open_ if left * weight[s] / total > most * sizes[s]]
        if not full:
            return out | {s: left * weight[s] / total for s in open_}
        out |= {s: float(most * sizes[s]) for s in full}
        left -= sum(out[s] for s in full)
        open_ = [s for s in open_ if s not in full]
    return out


def _by_source(spark, rows: list[tuple], schema: str) -> DataFrame:
    """A few figures a source, which the driver holds anyway; so no document moves to meet them."""
    df = spark.createDataFrame(rows, schema)
    return F.broadcast(df) if len(rows) <= MOST_BROADCAST else df


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def shuffled(doc_id: Column) -> Column:
    """The order within a source: a hash of the id, the same in every run."""
    return F.xxhash64(F.lit(SEED), doc_id)


def plan(sized: DataFrame) -> tuple[DataFrame, dict]:
    """The mix of a written table (row, doc_id, source, size): one row a document and pass, with the words taken.

    One figure for each source is held on the driver; documents never are.
    """
    spark = sized.sparkSession
    sizes = {r["source"]: r["size"] for r in sized.groupBy("source").agg(F.sum("size").alias("size")).collect()}
    wanted = targets(sizes)
    sources = _by_source(spark, [(s, sizes[s], wanted[s]) for s in sizes], "_source string, source_size long, target double")
    n = partitions(spark)
    rows = sized.join(sources, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
    rows = rows.withColumn("order", shuffled(F.col("doc_id"))).withColumn("part", F.pmod(F.shiftrightunsigned("order", 40), F.lit(1 << 24)))
    rows = rows.withColumn("part", F.floor(F.col("part") * n / (1 << 24)).cast("int"))
    rows = with_offsets(rows, ["source"], "part", {"words": F.col("size")})
    # pmod of the high bits sorts negative hashes last; so does the order within a part.
    unsigned = [F.col("order") < 0, F.col("order"), F.col("doc_id"), F.col("row")]
    upto = Window.partitionBy("source", "part").orderBy(*unsigned).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("before", F.col("words_before") + F.coalesce(F.sum("size").over(upto), F.lit(0))).drop("words_before", "part")
    passes = F.least(F.ceil(F.col("target") / F.col("source_size")), F.lit(MOST_PASSES)).cast("int")
    items = rows.where(F.col("size") > 0).withColumn("pass", F.explode(F.sequence(F.lit(0), passes - 1)))
    start = F.col("pass") * F.col("source_size") + F.col("before")
    items = items.withColumns({"finish": (start + F.col("size")) / F.col("target"), "fits": F.greatest(F.lit(0), F.least(F.col("size"), F.floor(F.col("target")) - start)).cast("long")})
    # What starts beyond its source's target can't be in the mix. Of the rest only a source's last one ends after 1.
    items = items.where("fits > 0").withColumn("span", F.least(F.floor(F.col("finish") * n), F.lit(n)).cast("int"))
    items = with_offsets(items, [], "span", {"fits": F.col("fits")})
    earlier = Window.partitionBy("span").orderBy("finish", "source", *unsigned, "pass").rowsBetween(Window.unboundedPreceding, -1)
    at = F.col("fits_before") + F.coalesce(F.sum("fits").over(earlier), F.lit(0))
    budget = sum(sizes.values())
    items = items.withColumn("at", at).withColumn("taken", F.greatest(F.lit(0), F.least(F.col("fits"), F.lit(budget) - F.col("at"))))
    return items.select("row", "doc_id", "source", "order", "size", "pass", "at", "taken"), {s: (sizes[s], wanted[s]) for s in sizes}


def sized_table(docs: DataFrame) -> DataFrame:
    """The narrow table that plan() takes, written once; a row number tells repeated rows apart."""
    return saved(docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), size_of(F.col("text")).alias("size")))


def mix_figures(docs: DataFrame) -> DataFrame:
    """One row a document: its words, its source's words and target, and how many of its words the mix takes.

    A null text has no words, a null source is a source of its own, the last. A source without words has target 0.
    Repeated doc_ids are rows of their own; a null doc_id is shuffled like any other. No rows give none.
    """
    sized = sized_table(docs)
    items, figures = plan(sized)
    sources = _by_source(docs.sparkSession, [(s, a, b) for s, (a, b) in figures.items()], "_source string, source_size long, target double")
    taken = items.groupBy("row").agg(F.sum("taken").alias("taken"), F.min("at").alias("first_at"))
    rows = sized.join(sources, F.col("source").eqNullSafe(F.col("_source")), "left").join(taken, "row", "left")
    return rows.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "first_at")


def mixed(docs: DataFrame) -> DataFrame:
    """The mix itself: docs, each as often as the mix takes it, with docs' columns.

    A source's passes all follow one order, so that for each source two figures tell what is taken: whole passes, and
    the place in the order up to which the last one goes. The document at that place is taken whole if half of it is.
    No text is shuffled. Documents without words, null texts among them, are in no mix and drop out. A null source is a source of
    its own. Rows that share a doc_id (or have none) lie at one place in the order, and are taken together. All columns are
    kept, whatever their names. No rows give none.
    """
    sized = sized_table(docs)
    items, figures = plan(sized)
    place = F.struct((F.col("order") < 0).alias("negative"), F.col("order"), F.col("doc_id"))
    taken = F.col("taken") * 2 >= F.col("size")
    last = items.where(taken).groupBy("source", "pass").agg(F.max(place).alias("upto"))
    upto = {}
    for r in last.collect():
        upto[r["source"], r["pass"]] = r["upto"]
    rows = []
    for s in figures:
        for p in range(MOST_PASSES):
            if (s, p) in upto:
                u = upto[s, p]
                rows.append((s, p, u["negative"], u["order"], u["doc_id"]))
    names = unused(docs.columns, "of", "pass", "negative", "order", "id")
    passes = _by_source(docs.sparkSession, rows, ", ".join(f"`{n}` {t}" for n, t in zip(names, ("string", "int", "boolean", "long", "long"), strict=True)))
    of, _, negative, order, id_ = names
    own = F.struct((shuffled(F.col("doc_id").cast("long")) < 0).alias("negative"), shuffled(F.col("doc_id").cast("long")).alias("order"), F.col("doc_id").cast("long").alias("doc_id"))
    to = F.struct(F.col(negative).alias("negative"), F.col(order).alias("order"), F.col(id_).alias("doc_id"))
    wide = docs.where(size_of(F.col("text")) > 0)
    return wide.join(passes, F.col("source").cast("string").eqNullSafe(F.col(of)) & (own <= to)).select(*[docs[f"`{c}`"] for c in docs.columns])
