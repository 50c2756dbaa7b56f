"""Names, paths and small text formats."""

from __future__ import annotations

import unicodedata
from functools import cache, reduce
from itertools import chain

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Letters and punctuation whose ASCII form is not "base letter without its marks".
ASCII_FORMS = {
    "ß": "ss", "ẞ": "Ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "þ": "th", "Þ": "Th",
    "ð": "d", "Ð": "D", "đ": "d", "Đ": "D", "ħ": "h", "Ħ": "H", "ı": "i", "ł": "l", "Ł": "L",
    "ø": "o", "Ø": "O", "ŧ": "t", "Ŧ": "T",
    " ": " ", "‐": "-", "–": "-", "—": "--", "‘": "'", "’": "'", "“": '"', "”": '"', "…": "...",
}

# Fixed value: a three-capital code that starts the file name of a Parquet or JSON document.
FILE_CODE = r"/([A-Z]{3})[^/]*\.(?:parquet|json)$"
# Fixed value: the value of the last ``name=value`` folder of a path.
FOLDER_VALUE = r"/[^/=]+=([^/]+)/[^/]*$"


@cache
def ascii_table() -> dict[str, str]:
    """Character → ASCII text for the Latin blocks, by the rule "decompose and drop the combining marks"."""
    table = {chr(mark): "" for mark in range(0x0300, 0x0370)}
    for letter in map(chr, chain(range(0x00C0, 0x0250), range(0x1E00, 0x1F00))):
        parts = unicodedata.normalize("NFKD", letter)
        plain = "".join(part for part in parts if not unicodedata.combining(part))
        if plain.isascii():
            table[letter] = plain
    return table | ASCII_FORMS


def fold_ascii(text: Column) -> Column:
    """Latin letters with marks → ASCII, natively: ``Määttä`` → ``Maatta``.

    Text that is ASCII already (as many bytes as characters) skips the mapping.
    """
    table = ascii_table()
    singles = [letter for letter, plain in table.items() if len(plain) == 1]
    dropped = [letter for letter, plain in table.items() if plain == ""]
    longer = [(letter, plain) for letter, plain in table.items() if len(plain) > 1]
    folded = F.translate(text, "".join(singles + dropped), "".join(table[letter] for letter in singles))
    folded = reduce(lambda out, pair: F.replace(out, F.lit(pair[0]), F.lit(pair[1])), longer, folded)
    return F.when(F.octet_length(text) == F.char_length(text), text).otherwise(folded)


def _fold_udf():
    table = str.maketrans(ascii_table())

    # A nested function travels to the executors by value, so they need no copy of this package.
    def fold(text: pd.Series) -> pd.Series:
        return text.map(lambda value: value.translate(table), na_action="ignore")

    return F.pandas_udf(fold, T.StringType())


def fold_ascii_udf(text: Column) -> Column:
    """The same mapping as an Arrow-batched UDF; ``fold_ascii`` is the faster one."""
    return _fold_udf()(text)


def full_name(*parts: Column | str) -> Column:
    """Parts joined by a blank, NULL parts skipped; all parts NULL gives the empty string."""
    return F.concat_ws(" ", *parts)


def whole_number(text: Column) -> Column:
    """Number in text → int, fractions cut (``'12.5'`` → 12), anything else NULL."""
    return text.try_cast("double").try_cast("int")


def split_ratio(text: Column, part: int, separator: str = "/") -> Column:
    """Part ``0`` or ``1`` of a ``made/attempts`` text as int; NULL where it is missing or no number."""
    return whole_number(F.get(F.split(text, separator), F.lit(part)))


def path_key(path: Column, pattern: str = FILE_CODE) -> Column:
    """Key that only the path of a document carries; NULL where the path has none."""
    return F.nullif(F.regexp_extract(path, pattern, 1), F.lit(""))
