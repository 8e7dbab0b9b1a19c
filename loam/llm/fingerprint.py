"""Document fingerprints by winnowing, in DataFrame functions only.

A text is a sequence of tokens: words, and of runs of over LONGEST characters (scripts without spaces, no-break spaces,
base64) the PIECE characters from each character on, so that grams roll there by characters. A gram is K consecutive tokens and its
hash slides over the text; a window is W consecutive grams. Every window selects its gram of least hash, the rightmost of
equals; what is selected, with its position, is the fingerprint. Two texts that share K + W - 1 tokens in a row
therefore share a selected gram, as do two long runs that share PIECE + K + W - 2 characters in a row.

Other grams are of tokens and not of characters as the latter cost five times the work: 2.5 microseconds a character, measured.
"""

from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import let, literal_array, partitions, range_of

K, W, LONGEST, PIECE = 4, 8, 16, 5
_ANY = r"[^\x20\x09-\x0D]"
_WORD = rf"(?<!{_ANY}){_ANY}{{1,{LONGEST}}}+(?!{_ANY})"
#: Its group 1 is the token; a match takes up the whole word, or one character of a long run.
TOKEN = rf"(?=({_WORD}|{_ANY}{{1,{PIECE}}}+))(?:{_WORD}|{_ANY})"
#: A key holds 40 bits of hash above the last 23 bits of the place. Grams are compared within a window only, and selected places
#: ascend by less than a window, so that the rest of a place is known from the ones before it.
PLACE = 23


def selected(text: Column) -> Column:
    """array<bigint>: the keys of the selected grams in order of place; empty for a text without tokens, or null.

    A text of fewer tokens than a gram has one gram of what there is, one of fewer grams than a window has one window.
    """
    mask = (1 << PLACE) - 1

    def gram(tokens: Column):
        def key(token: Column, i: Column) -> Column:
            h = F.xxhash64(token, *[F.get(tokens, i + j) for j in range(1, K)])
            return F.shiftleft(F.shiftrightunsigned(h, 24), PLACE) + (F.lit(mask) - i.bitwiseAND(F.lit(mask)))

        return key

    def least(keys: Column):
        return lambda key, i: F.least(key, *[F.get(keys, i + j) for j in range(1, W)])

    def first(array: Column, n: int) -> Column:
        """Without the last n - 1, but one at least."""
        return F.slice(array, 1, F.greatest(F.size(array) - (n - 1), F.lit(1)))

    tokens = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), 1)
    keys = let(tokens, lambda t: first(F.transform(t, gram(t)), K))
    chosen = let(keys, lambda k: first(F.transform(k, least(k)), W))
    # A gram that several windows in a row select is selected once.
    return let(chosen, lambda c: F.filter(c, lambda x, i: (i == 0) | (x != F.get(c, i - 1))))


def places(items: Column) -> Column:
    """The number of the first token of each selected gram, from 0."""
    mask = (1 << PLACE) - 1
    low = lambda x: F.lit(mask) - x.bitwiseAND(F.lit(mask))
    # Where the last bits fall, a lap of 2^PLACE tokens is over. Few texts have any, so laps are counted for those alone.
    falls = lambda v: F.filter(F.sequence(F.lit(1), F.size(v) - 1), lambda i: F.get(v, i) < F.get(v, i - 1))

    def unrolled(v: Column) -> Column:
        laps = lambda f: F.transform(v, lambda x, i: x + F.shiftleft(F.size(F.filter(f, lambda at: at <= i)).cast("long"), PLACE))
        return F.when(F.size(v) < 2, v).otherwise(let(falls(v), lambda f: F.when(F.size(f) == 0, v).otherwise(laps(f))))

    return let(F.transform(items, low), unrolled)


def hashes(items: Column) -> Column:
    return F.transform(items, lambda x: F.shiftright(x, PLACE))


def digest(items: Column) -> Column:
    """The selected hashes in order of place, ten hexadecimal digits each."""
    return F.array_join(F.transform(items, lambda x: F.lower(F.lpad(F.hex(F.shiftright(x, PLACE)), 10, "0"))), "")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of the sets of selected hashes; 1 for two empty ones."""
    common = F.size(F.array_intersect(hashes(a), hashes(b)))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(common / F.size(F.array_union(hashes(a), hashes(b))))


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with `fingerprint` (string), and `positions` (the places of the selected grams, in tokens)."""
    items = docs.withColumn("_items", selected(F.col(text)))
    return items.withColumns({"fingerprint": digest(F.col("_items")), "positions": places(F.col("_items"))}).drop("_items")


#: Sampled steps a range, which are put together to ranges of even bytes.
STEPS = 4


def _firsts(sizes: list[int], n: int) -> list[int]:
    """Where up to n ranges of steps begin, of about even size."""
    total, seen, firsts = sum(sizes), 0, [0]
    for i, size in enumerate(sizes):
        if i > firsts[-1] and seen * n >= total * len(firsts):
            firsts.append(i)
        seen += size
    return firsts


def in_descending_ranges(docs: DataFrame, n: int) -> DataFrame:
    """docs (doc_id, text) in ranges of the descending order of (doc_id, nulls last, `_hash` of the text): `_range` is a partition's
    number, and where a range ends, the first row after it comes along as `_ghost`; after the last row comes the first.

    Ranges hold about as many bytes each. An id that many rows share, or null, is cut by the hash of the text, and so spreads like
    any others. Only boundaries and one row a step reach the driver.
    """
    rows = docs.withColumn("_hash", F.xxhash64("text"))
    id_, hash_ = F.col("doc_id"), F.col("_hash")
    spots = [i / (STEPS * n) for i in range(1, STEPS * n)]
    found = rows.agg(F.percentile_approx("doc_id", spots, 20 * STEPS * n).alias("at"), F.count("*").alias("all"), F.count("doc_id").alias("ids")).first()
    at, unnamed = found["at"] or [], found["all"] - found["ids"]
    # An id that takes whole steps lies between bounds of its own, and is cut into as many parts.
    often = {x: k + 1 for x, k in Counter(at).items() if k > 1}
    bounds = sorted(set(at) | {x + 1 for x in often if x < (1 << 63) - 1})
    parts = F.when(id_.isNull(), 1 + unnamed * STEPS * n // max(1, found["all"])).otherwise(1)
    if often:
        ids = sorted(often)
        k = range_of(id_, ids) - 1
        parts = F.when(F.get(literal_array(ids, "long"), k) == id_, F.get(literal_array([often[x] for x in ids], "int"), k)).otherwise(parts)
    below = F.shiftrightunsigned(hash_.bitwiseXOR(F.lit(-(1 << 63))), 1) / F.lit(float(1 << 63))
    step = F.when(id_.isNull(), len(bounds) + 1).otherwise(F.lit(len(bounds)) - range_of(id_, bounds)).cast("long")
    rows = rows.withColumn("_step", F.shiftleft(step, 31) + F.floor((1 - below) * parts))
    place = F.struct(id_.isNull().alias("none"), F.bitwise_not(id_), F.bitwise_not(hash_), id_.alias("id"), hash_.alias("hash"))
    steps = rows.groupBy("_step").agg(F.sum(F.octet_length("text") + 64).alias("bytes"), F.min(place).alias("first")).orderBy("_step").collect()
    starts = [steps[i] for i in _firsts([r["bytes"] for r in steps], n)] if steps else []
    last = max(1, len(starts))
    rows = rows.withColumn("_range", range_of(F.col("_step"), [r["_step"] for r in starts[1:]]))
    of = lambda values: F.get(literal_array(values or [0], "long"), F.col("_range"))
    same_id = F.coalesce(id_ == of([r["first"]["id"] or 0 for r in starts]), F.lit(False))
    head = (hash_ == of([r["first"]["hash"] for r in starts])) & F.when(of([int(r["first"]["none"]) for r in starts]) == 1, id_.isNull()).otherwise(same_id)
    own = F.struct(F.col("_range").alias("r"), F.lit(False).alias("g"))
    before = F.struct(F.pmod(F.col("_range") - 1, F.lit(last)).alias("r"), F.lit(True).alias("g"))
    dealt = rows.withColumn("_at", F.explode(F.when(head, F.array(own, before)).otherwise(F.array(own))))
    return dealt.select("doc_id", "text", "_hash", F.col("_at.r").alias("_range"), F.col("_at.g").alias("_ghost")).repartitionById(last, F.col("_range"))


def document_fingerprints(docs: DataFrame) -> DataFrame:
    """One row a document (doc_id, text): its fingerprint and that of its edited text.

    The edited text has its last floor(n/2) characters replaced by the first as many (or all) of the next document's,
    in descending doc_id; after the last comes the first. A null text counts as empty and has the fingerprint "".
    Repeated doc_ids follow one another in the descending order of their texts' hashes; null doc_ids come last, likewise. Other
    columns are ignored, whatever their names. No rows give none.
    """
    n = partitions(docs.sparkSession)
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = in_descending_ranges(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")), n)
    rows = rows.withColumn("items", selected(F.col("text")))
    following = Window.partitionBy("_range").orderBy("_ghost", F.desc_nulls_last("doc_id"), F.desc("_hash"))
    rows = rows.withColumns({"after": F.lead("text").over(following), "after_items": F.lead("items").over(following)}).where(~F.col("_ghost"))
    # A single document follows itself.
    rows = rows.withColumns({"after": F.coalesce("after", "text"), "after_items": F.coalesce("after_items", "items"), "n_chars": F.length("text")})
    half = F.floor(F.col("n_chars") / 2).cast("int")
    keep, take = F.col("n_chars") - half, F.least(half, F.length("after"))
    rows = rows.withColumns({"keep": keep, "take": take})
    new = F.concat(F.substring("text", F.lit(1), F.col("keep")), F.substring("after", F.lit(1), F.col("take")))
    rows = rows.withColumn("new", new)
    rows = rows.withColumn("changed", selected(F.col("new")))
    return rows.select(
        "doc_id",
        F.col("n_chars").cast("long").alias("n_chars"),
        F.sha2(F.col("new"), 256).alias("edited_sha256"),
        digest(F.col("items")).alias("fingerprint"),
        digest(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("items"), F.col("changed")).alias("near_edited"),
        likeness(F.col("items"), F.col("after_items")).alias("near_next"),
        places(F.col("items")).alias("positions"),
    )
