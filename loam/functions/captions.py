"""Structured annotations against closed vocabularies, and captions put together from them.

A vocabulary is data: a mapping from slot to its values. Slots in `arrays` hold up to `most` values, others one.
"""

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrays import bound
from .text import clean_text, join_filled


@dataclass(frozen=True)
class Vocabulary:
    values: Mapping[str, Sequence[str]]
    arrays: tuple[str, ...] = ()
    most: int = 2
    required: tuple[str, ...] = ()
    flag: str = "has_watermark"
    text: str = "description"
    singles: tuple[str, ...] = field(init=False)

    def __post_init__(self):
        object.__setattr__(self, "singles", tuple(k for k in self.values if k not in self.arrays))

    def schema(self) -> T.StructType:
        """What from_json reads a response as."""
        fields = [T.StructField(k, T.StringType()) for k in self.singles]
        fields += [T.StructField(k, T.ArrayType(T.StringType())) for k in self.arrays]
        return T.StructType([*fields, T.StructField(self.flag, T.BooleanType()), T.StructField(self.text, T.StringType())])

    def json_schema(self) -> dict:
        """What a model is asked to answer by."""
        one = lambda k: {"type": "string", "enum": list(self.values[k])}
        fields = {k: one(k) for k in self.singles} | {k: {"type": "array", "items": one(k)} for k in self.arrays}
        fields |= {self.flag: {"type": "boolean"}, self.text: {"type": "string"}}
        return {"type": "object", "properties": fields, "required": list(self.required)}


def coerce(raw: Column, vocab: Vocabulary) -> Column:
    """A response (JSON text) as a struct: single values out of the vocabulary are '', lists keep those within it, in order
    and with repeats, up to the most; what can't be read is blank."""
    known = lambda k: [F.lit(v) for v in vocab.values[k]]

    def parts(got: Column) -> Column:
        cols = [F.when(got[k].isin(*known(k)), got[k]).otherwise("").alias(k) for k in vocab.singles]
        cols += [F.slice(_kept(got[k], known(k)), 1, vocab.most).alias(k) for k in vocab.arrays]
        return F.struct(*cols, F.coalesce(got[vocab.flag], F.lit(False)).alias(vocab.flag), clean_text(got[vocab.text]).alias("nl"))

    return bound(F.from_json(raw, vocab.schema()), parts)


def _kept(values: Column, known: list[Column]) -> Column:
    return F.filter(F.coalesce(values, F.array().cast("array<string>")), lambda v: v.isin(*known))


def assemble(parts: Column, order: Sequence[str], vocab: Vocabulary, tags: Column, resolution: Column, rating: Column) -> Column:
    """A caption: slots in their order ('_resolution' and '_rating' stand for those columns), then tags, the word for a
    flagged one, and the text. `rating` is the fallback for an empty one."""
    empty = F.array().cast("array<string>")

    def caption(parts: Column) -> Column:
        pieces = []
        for slot in order:
            if slot == "_resolution":
                pieces.append(F.array(resolution))
            elif slot == "_rating":
                pieces.append(F.array(rating_of(parts, rating)))
            elif slot in vocab.arrays:
                pieces.append(F.coalesce(parts[slot], empty))
            else:
                pieces.append(F.array(parts[slot]))
        pieces += [F.array(tags), F.array(F.when(parts[vocab.flag], F.lit("watermark"))), F.array(parts["nl"])]
        return join_filled(F.concat(*pieces))

    return bound(parts, caption)


def rating_of(parts: Column, fallback: Column) -> Column:
    return F.coalesce(F.nullif(parts["rating"], F.lit("")), fallback)


def prompt(instructions: str, tags: Column) -> Column:
    """What a model is asked: instructions, then the tags as context."""
    return F.concat(F.lit(instructions), F.coalesce(tags, F.lit("")))
