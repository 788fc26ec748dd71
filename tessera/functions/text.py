"""Text scalar helpers and the fixed lookup values of the cleaning rules."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's rules.
# Gender spellings mapped to a canonical value (case-sensitive, after strip):
GENDER_MAP = {
    "male": "Male", "m": "Male", "MALE": "Male", "M": "Male",
    "female": "Female", "f": "Female", "FEMALE": "Female", "F": "Female",
}
# Values accepted as already canonical (kept and not counted):
GENDER_CANONICAL = ("Male", "Female")
# The characters Python's str.strip() removes, derived from str.isspace.
PY_WHITESPACE = "".join(chr(i) for i in range(0x110000) if chr(i).isspace())


def py_strip(c: Column) -> Column:
    """Python ``str.strip()``: ``trim`` with Python's whitespace set (plain
    ``trim`` removes only spaces); a codegen'd string function, no regex.

    ``trim`` looks every character up in the set and lists the places of all
    before it starts from the right, so a text that begins and ends with a
    visible ASCII character is handed back as it is."""
    visible = c.between("!", "~") & F.substring(c, -1, 1).between("!", "~")
    return F.when(visible, c).otherwise(F.trim(c, F.lit(PY_WHITESPACE)))


def title_case(c: Column) -> Column:
    """``str.title`` for single words (``initcap`` capitalises after blanks only)."""
    return F.initcap(c)


def lookup(c: Column, mapping: dict[str, str]) -> Column:
    """Literal map lookup (a ``create_map`` constant, evaluated in codegen)."""
    m = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return m[c]
