"""Composite ids and hashed row keys."""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from weftwork.constants import ID_SEPARATOR, KEY_SEPARATOR


def as_column(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def has_text(text: Column) -> Column:
    """True when the text holds anything but blanks and control characters; null is false.

    A text that starts with a printable character compares above a blank, so
    the pattern is only tried on the few that do not.
    """
    return F.coalesce((text >= "!") | text.rlike(r"[^\x00-\x20]"), F.lit(False))


def all_have_text(parts: list[Column]) -> Column:
    """True when there is a part and every part holds text."""
    if not parts:
        return F.lit(False)
    return reduce(lambda a, b: a & b, [has_text(part.cast("string")) for part in parts])


def joined_id(root, parts: list[Column]) -> Column:
    """``root ~`# part ~`# …`` of parts that are all there; an empty root adds no separator."""
    prefix = F.nullif(as_column(root), F.lit(""))
    return F.concat_ws(ID_SEPARATOR, prefix, *[part.cast("string") for part in parts])


def composite_id(root, parts: list[Column]) -> Column:
    """`joined_id`, or null when there is no part or any part is null or blank.

    ``concat_ws`` alone would skip a null part and give two records one id.
    """
    if not parts:
        return F.lit(None).cast("string")
    return F.when(all_have_text(parts), joined_id(root, parts))


_UNROLLED = 4


def composite_id_from(root, names: Column, values: Column) -> Column:
    """`composite_id` where the part names come from a column and the parts from a map.

    Up to four names are read one by one, which compiles to straight code;
    beyond the end of ``names`` a part is null and ``concat_ws`` skips it.
    """
    parts = [F.try_element_at(values, F.get(names, F.lit(i))) for i in range(_UNROLLED)]
    complete = F.size(names) > 0
    for i, part in enumerate(parts):
        complete = complete & ((F.size(names) <= i) | has_text(part))
    every = F.transform(names, lambda name: F.try_element_at(values, name))
    prefix = F.nullif(as_column(root), F.lit(""))
    return F.when(
        F.size(names) <= _UNROLLED, F.when(complete, F.concat_ws(ID_SEPARATOR, prefix, *parts))
    ).otherwise(F.when(F.forall(every, has_text), F.concat_ws(ID_SEPARATOR, prefix, every)))


def row_key(res_id, element_id: Column) -> Column:
    """``resource@id``; a record without a resource is keyed under the text ``null``."""
    return F.concat(
        F.coalesce(as_column(res_id).cast("string"), F.lit("null")),
        F.lit(KEY_SEPARATOR),
        element_id,
    )


def row_hash(key: Column) -> Column:
    return F.md5(key)
