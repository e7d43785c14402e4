"""Fill-in-the-middle examples: each text is cut into prefix, middle and suffix, and the middle goes last.

Units are what a pattern matches, left to right; by default runs of ASCII letters, and any other character by itself.
A SHA-256 of a seed and the row's id draws where to cut and which form to write, so the result does not depend on
partitions or on other rows. Forms: plain (the text), psm (prefix, suffix, middle) and spm (suffix, prefix, middle),
with a mark before each part. A text that contains a mark is written plain, so parts can be told apart again.

A pandas UDF reads Arrow batches. A text's unit ends are four bytes each in one array, which is what a very long text
takes besides itself; two of them give the slices.

Null texts are empty ones: no units, plain, empty output. Texts are taken whole, whatever their length. Repeated rows
get equal results; so do rows of one id and one text. A null id draws as an id without digits. An empty table gives an
empty result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Callable, Iterator

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Marks before prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")
UNITS = r"[A-Za-z]+|[^A-Za-z]"
SEED = 1
#: Of 100 rows so many are rearranged; of 100 rearranged ones so many have the suffix first.
REARRANGED, SUFFIX_FIRST = 90, 20

PARTS = "n long, form string, prefix_chars long, middle_chars long"


def draws(seed: int, id: int | None) -> list[int]:
    """Four 32-bit numbers for a row."""
    digest = hashlib.sha256(f"{seed}:{'' if id is None else id}".encode()).hexdigest()
    return [int(digest[k : k + 8], 16) for k in (0, 8, 16, 24)]


def rearranged(text: str, numbers: list[int], units: regex.Pattern) -> tuple[int, str, int | None, int | None, str]:
    """Units, form, characters of prefix and middle, and the output."""
    ends = array("I", (m.end() for m in units.finditer(text)))
    n = len(ends)
    if not text or any(mark in text for mark in MARKS) or numbers[2] % 100 >= REARRANGED:
        return n, "plain", None, None, text
    first, second = sorted(h % (n + 1) for h in numbers[:2])
    a, b = (ends[k - 1] if k else 0 for k in (first, second))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    p, s, m = MARKS
    if numbers[3] % 100 < SUFFIX_FIRST:
        return n, "spm", a, b - a, f"{s}{suffix}{p}{prefix}{m}{middle}"
    return n, "psm", a, b - a, f"{p}{prefix}{s}{suffix}{m}{middle}"


def restored(output: str, form: str) -> str:
    """The text that an output was made of."""
    if form == "plain":
        return output
    p, s, m = MARKS
    head, between = (p, s) if form == "psm" else (s, p)
    if not output.startswith(head):
        raise ValueError(f"not an output of form {form}")
    one, _, rest = output[len(head) :].partition(between)
    two, _, middle = rest.partition(m)
    return one + middle + two if form == "psm" else two + middle + one


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def _over_texts(row: Callable[[tuple], tuple], schema: str, units: str, seed: int) -> Callable[[Column, Column], Column]:
    """A pandas UDF of (text, id) that gives what `row` makes of each rearranged text."""
    names = [field.split()[0] for field in schema.split(", ")]

    @F.pandas_udf(schema)
    def udf(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        pattern = regex.compile(units)
        for texts, ids in batches:
            ids = [int(i) if i else None for i in ids]
            found = [row(rearranged(t or "", draws(seed, i), pattern)) for t, i in zip(texts, ids)]
            yield pd.DataFrame({name: pd.Series(values, dtype=object) for name, values in zip(names, zip(*found) if found else [()] * len(names))})

    return udf


def _rows(docs: DataFrame, text: str, id: str, row: Callable[[tuple], tuple], schema: str, units: str, seed: int) -> DataFrame:
    key = F.col(id).cast("long")
    cut = _over_texts(row, schema, units, seed)(F.col(text), key.cast("string"))  # as text: pandas has no null among integers
    return docs.select(key.alias("doc_id"), cut.alias("cut")).select("doc_id", "cut.*")


def transform(docs: DataFrame, text: str = "text", id: str = "doc_id", units: str = UNITS, seed: int = SEED) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of each row. Characters are code points, null if plain."""
    return _rows(docs, text, id, lambda x: x, f"{PARTS}, output string", units, seed)


@F.pandas_udf(T.StringType())
def restore(output: pd.Series, form: pd.Series) -> pd.Series:
    """The text that transform() made an output of."""
    return pd.Series([None if o is None else restored(o, f) for o, f in zip(output, form)], dtype=object)


def digests(docs: DataFrame, text: str = "text", id: str = "doc_id", units: str = UNITS, seed: int = SEED) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256): outputs, and the texts rebuilt from them."""

    def row(cut: tuple) -> tuple:
        return (*cut[:4], _sha256(cut[4]), _sha256(restored(cut[4], cut[1])))

    return _rows(docs, text, id, row, f"{PARTS}, output_sha256 string, restored_sha256 string", units, seed)
