"""Text expressions. All take and give columns; nulls are treated as the docstrings say."""

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

#: All white space, as Unicode has it; Java's plain \s and trim() know less.
SPACES = r"(?U)\s+"


def strip(text: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def clean_text(text: Column) -> Column:
    """Runs of white space as one space, none at the ends, no full stops at the end; null gives ''."""
    one_line = strip(F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " "))
    return strip(F.regexp_replace(one_line, r"\.+$", ""))


def join_filled(parts: Column, separator: str = ", ") -> Column:
    """The strings of an array that are neither null nor empty, joined in their order; repeats stay."""
    return F.array_join(F.filter(parts, lambda x: x.isNotNull() & (x != "")), separator)


def first_label(label: Column, mapping: Mapping[str, str], default: str) -> Column:
    """The value of the longest key that the label contains, whatever the case; else the default."""
    found, upper = F.lit(default), F.upper(F.coalesce(label, F.lit("")))
    for key in sorted(mapping, key=len):
        found = F.when(upper.contains(key.upper()), F.lit(mapping[key])).otherwise(found)
    return found


def mime_type(path: Column, known: Mapping[str, str], default: str = "image/jpeg") -> Column:
    """By the file name's ending, whatever its case."""
    ending = F.lower(F.regexp_extract(path, r"(\.[^./\\]+)$", 1))
    table = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    return F.coalesce(F.try_element_at(table, ending), F.lit(default))


def masked(secret: Column) -> Column:
    """Enough of a secret to recognise it: four characters at each end if it has over eight, and its length."""
    n = F.length(secret)
    size = F.concat(F.lit("(len "), n.cast("string"), F.lit(")"))
    return F.when(n > 8, F.concat(F.substring(secret, 1, 4), F.lit("..."), F.right(secret, F.lit(4)), F.lit(" "), size)).otherwise(size)


def normal_token(token: Column) -> Column:
    return strip(F.lower(F.regexp_replace(token, "_", " ")))


def block_hits(tags: Column, blocked: Iterable[str]) -> Column:
    """Sorted blocked terms among comma-separated tags: whole tokens only, whatever the case; '_' and ' ' are equal.

    A null list of tags has none. An empty array means that nothing is blocked.
    """
    terms = sorted({b.lower().replace("_", " ").strip() for b in blocked})
    tokens = F.transform(F.split(F.coalesce(tags, F.lit("")), ","), normal_token)
    return F.array_sort(F.array_intersect(tokens, F.array(*[F.lit(t) for t in terms]).cast("array<string>")))


def stem(path: Column) -> Column:
    """The last part of a path without its ending; both kinds of slash separate."""
    name = F.regexp_extract(F.regexp_replace(path, r"\\", "/"), r"([^/]*)/*$", 1)
    return F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")


def path_order(path: Column) -> Column:
    """A sort key that compares paths part by part."""
    return F.split(path, "/")


def to_int(text: Column) -> Column:
    """Null for what isn't a whole number."""
    return text.try_cast("int")


def to_double(text: Column) -> Column:
    """Null for what isn't a decimal number; Java's suffixes are none."""
    return F.when(text.cast("string").rlike(r"^\s*[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?\s*$"), text.cast("string").try_cast("double"))
