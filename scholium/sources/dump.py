"""One huge gzipped XML dump: cut into records in one pass, parsed by all tasks.

A gzip file can only be read from its beginning, by one task. That task does as little as can be: Spark's reader hands on
lines as it unpacks them, and they are put together to whole records, which leave in batches of bounded size. What costs,
reading the XML, is then dealt out to all.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from itertools import chain

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import once, unescape
from .parsers import _author, record

TAGS = ("article", "inproceedings", "incollection", "proceedings", "phdthesis")
#: Characters that a batch of records holds before it leaves, and that a record can have; a longer one has lost its end.
BATCH_CHARS, RECORD_CHARS = 4 << 20, 1 << 24


def cut(lines: Iterable[str], tags: Sequence[str] = TAGS, most: int = RECORD_CHARS) -> Iterator[tuple[str, bool]]:
    """(text, whole) of each element with one of the tags, in order; one inside another is part of it.

    An element without an end within `most` characters, or before the lines end, comes as far as it was read, not whole,
    and the search for the next one goes on after that line. Lines may come many at a time, joined by line feeds.
    """
    start = re.compile(rf"<({'|'.join(map(re.escape, tags))})(?=[\s>]|$)")
    held: list[str] = []
    size, end = 0, ""
    coming, single = iter(lines), iter(())
    while (line := next(single, None)) is not None or (line := next(coming, None)) is not None:
        at = 0
        while True:
            if not end:
                found = start.search(line, at)
                if not found:
                    break
                at, end = found.start(), f"</{found[1]}>"
            close = line.find(end, at)
            ends = line.rfind("\n", at, close) if close >= 0 else len(line) if "\n" in line else -1
            if ends >= at and size + ends - at + 1 > most:  # too long by then: which line is the last one shows line by line
                single = chain(line[at:].split("\n"), single)
                break
            if close < 0:
                held += [line[at:], "\n"]
                size += len(line) - at + 1
                if size > most:
                    yield "".join(held), False
                    held, size, end = [], 0, ""
                break
            close += len(end)
            yield "".join(held) + line[at:close], True
            held, size, end, at = [], 0, "", close
    if held:
        yield "".join(held), False


def dump_records(spark: SparkSession, path: str, tags: Sequence[str] = TAGS, parts: int | None = None) -> DataFrame:
    """(file, text, whole): the records of gzipped files, dealt out to tasks. Other files may be read too, if Spark does not split them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def joined() -> Iterator[tuple[str, str]]:
            """(file, lines) of one file, joined."""
            for b in batches:
                runs, first = pc.run_end_encode(b.column("file")), 0
                for name, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist()):
                    yield name, "\n".join(b.column("value").slice(first, end - first).to_pylist())
                    first = end

        def files() -> Iterator[tuple[str, Iterator[str]]]:
            """Each file with its lines; files come one after the other."""
            pairs = joined()
            ahead = next(pairs, None)

            def lines(name: str) -> Iterator[str]:
                nonlocal ahead
                while ahead and ahead[0] == name:
                    yield ahead[1]
                    ahead = next(pairs, None)

            while ahead:
                yield ahead[0], lines(ahead[0])

        def batch(name: str, first: int, texts: list[str], whole: list[bool]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([name] * len(texts)), pa.array(texts), pa.array(whole), pa.array(range(first, first + len(texts)))], names=["file", "text", "whole", "_at"])

        for name, lines in files():
            texts, whole, size, first = [], [], 0, 0
            for text, is_whole in cut(lines, tags):
                texts.append(text)
                whole.append(is_whole)
                size += len(text)
                if size > BATCH_CHARS:
                    yield batch(name, first, texts, whole)
                    texts, whole, size, first = [], [], 0, first + len(texts)
            if texts:
                yield batch(name, first, texts, whole)

    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), "value")
    found = lines.mapInArrow(run, "file string, text string, whole boolean, _at long")
    # dealt out by number: without a key, Spark sorts all that a task has first, here a whole file
    return found.repartition(parts or int(spark.conf.get("spark.sql.shuffle.partitions")), "file", "_at").drop("_at")


ENTRY = "_key string, author array<string>, title string, year string, booktitle array<string>, journal array<string>, ee array<string>"


def _parsed(text: Column) -> Column:
    """An entry's fields. Attributes and markup within a field are dropped, its text stays."""
    named = F.regexp_replace(text, r"&(amp|lt|gt|quot|apos|#\d+|#x[0-9A-Fa-f]+);", "\u0001$1;")
    known = F.regexp_replace(once(named, unescape), r"&(?=[A-Za-z])", "&amp;")
    kept = F.replace(known, F.lit("\u0001"), F.lit("&"))
    bare = F.regexp_replace(kept, r"<(/?)(i|b|sub|sup|tt|ref|u|em|span)(?:\s[^<>]*)?>", "")
    plain = F.regexp_replace(bare, r"<(author|title|year|booktitle|journal|ee)\s[^<>]*>", "<$1>")
    return F.from_xml(plain, ENTRY)


def index_entries(dump: DataFrame, harvested_at: str = "") -> DataFrame:
    """Papers of a computing index's dump (dump_records' rows): whole records that have authors and a title.

    A record is parsed once and after it was dealt out: as a generator's input it is not copied into the filter, which
    would go down to the task that reads the file.
    """
    raw = dump.filter("whole").select(F.regexp_extract("text", r"^<(\w+)", 1).alias("kind"), F.inline(F.array(_parsed(F.col("text"))))).filter("size(author) > 0 and trim(title) <> ''")
    name = lambda a: F.regexp_replace(F.trim(a), r"\s+\d{4}$", "")
    address = F.get(F.filter("ee", lambda e: F.contains(e, F.lit("doi.org/"))), 0)
    return record(
        raw, harvested_at, title=F.regexp_replace(F.trim("title"), r"\.$", ""), authors=F.transform("author", lambda a: _author(name(a))), year=F.col("year").try_cast("int"), doi=F.get(F.split(address, "doi.org/", 2), 1), source=F.lit("dblp"),
        source_id=F.col("_key"), url=F.get("ee", 0), venue=F.coalesce(F.get("booktitle", 0), F.get("journal", 0)), publication_type=F.col("kind"),
    )
