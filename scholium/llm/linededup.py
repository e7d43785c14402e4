"""Line dedup by winnowing over line hashes, in DataFrame operations only.

Lines end at line feeds. With BOUNDARY they also end before a capitalised word that follows a space, so that a passage
which was set into another line is still made of the same lines; what is deleted then are such parts of lines. Lines are
equal if they are without white space around them. From each
line on, and back from each line, the shortest run of LEAST bytes is a window. Of each window the line with the least
hash is a fingerprint, a blank line only if there is no other. Equal windows have equal fingerprints, so a run of LEAST
bytes that is repeated has a fingerprint that is found at another place too: fingerprints of one place only go, with
their windows. Around the others the match is extended ahead and back, by the windows that they are fingerprints of:
each is joined with the first place of all that has the same lines, documents in order of id and lines in order, and
its lines go if that is another place. A run is made up of its windows, so it is followed as far as it goes, whichever
earlier places have its parts. What a line is deleted for stands earlier, so one copy of everything stays.

A line has the bytes it has, or those without the white space around it and one for its end: windows of both measures
are made, so that copies with other white space are found by the second one. The end of a text counts as a line's end.
Very long texts are taken whole, with work in proportion to their lines, however often a line is repeated.

Hot lines and windows: places and first documents are aggregated map-side, and each join has one row a key on one
side, so that the other can be split. What a task holds of a document is its windows, at most four a line, none of over
LEAST lines.

Null texts and ids: such rows stay as they are and are not compared. Empty texts are one empty line; an empty table
gives an empty result. Rows with the same id are one document, whose lines are those of either row: a repeated row
keeps what its original keeps. Texts and ids only are read; deduplicated() keeps other columns whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

LEAST = 160
#: Lines that are looked at for the end of a window, further ones only if these are too short together.
NEAR = (6, 24, LEAST)
#: What a blank line has in the place of its hash when the least one is sought.
BLANK = (1 << 63) - 1
#: Where lines end, and where they do if sentences within a line count too.
LINES = r"(?<=\n)"
BOUNDARY = LINES + r"|(?<= )(?=\p{Lu}\p{Ll})"


def _lines(text: Column, boundary: str) -> Column:
    return F.split(text, boundary, -1)


def _plain(lines: Column) -> Column:
    return F.transform(lines, lambda x: F.btrim(x, F.lit(" \t\r\n")))


def _length(n: Column, i: Column) -> Column:
    """How many of the sizes from i on make LEAST bytes; null if all together do not."""
    full = LEAST * 256

    def within(lines: int) -> Column:
        step = lambda s, x: F.when(s >= full, s).otherwise(s + F.least(x, F.lit(LEAST)) * 256 + 1)  # noqa: E731  bytes and lines so far
        return F.aggregate(F.slice(n, i + 1, lines), F.lit(0), step, lambda s: F.when(s >= full, s % 256))

    return F.coalesce(*[within(n) for n in NEAR])


def _spans(n: str) -> Column:
    """Windows by the sizes in column n: 256 times the first line, and the number of lines."""
    every = F.sequence(F.lit(0), F.size(n) - 1)
    size = F.size(n)
    ahead = F.transform(every, lambda i: i.cast("long") * 256 + _length(F.col(n), i))
    back = lambda i, k: (size - i - k).cast("long") * 256 + k
    behind = F.transform(F.transform(every, lambda i: F.struct(i.alias("i"), _length(F.col(f"{n}_back"), i).alias("k"))), lambda w: back(w["i"], w["k"]))
    return F.array_union(ahead, behind)


def _once(value: str, use) -> Column:
    """use(value), with value through an array, or Spark would make it again for each window."""
    return F.get(F.transform(F.array(F.col(value)), use), 0)


def _key(h: Column, span: Column) -> Column:
    return F.xxhash64(F.slice(h, F.shiftright(span, 8).cast("int") + 1, span.bitwiseAND(F.lit(255)).cast("int")))


def _mark(ranks: Column, span: Column) -> Column:
    """The fingerprint of a window: the least rank in it and the line that has it."""
    return F.array_min(F.slice(ranks, F.shiftright(span, 8).cast("int") + 1, span.bitwiseAND(F.lit(255)).cast("int")))


def prepared(docs: DataFrame, text: str = "text", id: str = "doc_id", boundary: str = LINES) -> DataFrame:
    """(doc_id, spans, keys, marks): the windows of each document, hashes of their lines, and their fingerprints."""
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text")).filter("doc_id is not null and text is not null")
    split = rows.select("doc_id", _lines(F.col("text"), boundary).alias("line"))
    plain = split.select("doc_id", "line", _plain(F.col("line")).alias("plain"))
    sized = plain.select("doc_id", F.transform("plain", lambda x: F.xxhash64(x)).alias("h"), F.transform("plain", lambda x: F.octet_length(x) + 1).alias("n"), F.transform("line", F.octet_length).alias("raw"))
    wide = sized.withColumn("wide", F.zip_with("n", "raw", lambda a, b: F.greatest(a, b))).drop("raw")
    turned = wide.withColumns({"n_back": F.reverse("n"), "wide_back": F.reverse("wide"), "ranks": F.transform(F.arrays_zip("h", "n"), lambda x, i: F.struct(F.when(x["n"] == 1, F.lit(BLANK)).otherwise(x["h"]).alias("print"), i.alias("at")))})
    spans = F.when(F.col("n") == F.col("wide"), _spans("n")).otherwise(F.array_union(_spans("n"), _spans("wide")))
    found = turned.select("doc_id", "h", "ranks", F.filter(spans, lambda x: x.isNotNull()).alias("spans"))
    return found.select("doc_id", "spans", _once("h", lambda h: F.transform("spans", lambda x: _key(h, x))).alias("keys"), _once("ranks", lambda r: F.transform("spans", lambda x: _mark(r, x))).alias("marks"))


def repeats(windows: DataFrame) -> DataFrame:
    """(doc_id, key, span) from prepared() rows: windows whose first occurrence is elsewhere."""
    each = windows.select("doc_id", F.explode(F.arrays_zip("spans", "keys", "marks")).alias("e"))
    each = each.select("doc_id", F.col("e.spans").alias("span"), F.col("e.keys").alias("key"), F.col("e.marks.print").alias("print"), F.col("e.marks.at").alias("at"))
    ends = [f(c).alias(f"{n}_{c}") for c in ("doc_id", "at") for n, f in (("min", F.min), ("max", F.max))]
    shared = each.groupBy("print").agg(*ends).filter("min_doc_id < max_doc_id or min_at < max_at").select("print")  # found at two places
    near = stored(each.select("doc_id", "span", "key", "print").join(stored(shared, "line-prints"), "print", "left_semi").drop("print"), "line-near")
    firsts = near.groupBy("key").agg(F.min(F.struct("doc_id", "span")).alias("first"), F.count(F.lit(1)).alias("times")).filter("times > 1")
    firsts = stored(firsts.select("key", F.col("first.doc_id").alias("first"), F.col("first.span").alias("start")), "line-firsts")  # so that hot windows can be split in the join
    return near.join(firsts, "key").filter("doc_id > first or span > start").select("doc_id", "key", "span")


def repeated(docs: DataFrame, text: str = "text", id: str = "doc_id", boundary: str = LINES) -> DataFrame:
    """docs with its columns as one struct `row`, and where earlier places hold lines of it, its `line`s and `gone`: the places of those that go."""
    windows = stored(prepared(docs, text, id, boundary), "line-windows")
    of_doc = repeats(windows).groupBy("doc_id").agg(F.collect_list(F.struct("key", "span")).alias("spans")).withColumnRenamed("doc_id", "_id")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id).cast("long").alias("id"))
    met = rows.join(of_doc, F.col("id") == F.col("_id"), "left")
    split = met.select("row", "spans", F.when(F.col("spans").isNotNull(), _lines(F.col("row")[text], boundary)).alias("line"))
    hashed = split.select("row", "line", "spans", F.transform(_plain(F.col("line")), lambda x: F.xxhash64(x)).alias("h"))
    own = _once("h", lambda h: F.filter("spans", lambda s: s["key"] == _key(h, s["span"])))  # another row may have the same id
    first = lambda s: F.shiftright(s["span"], 8).cast("int")
    places = F.transform(own, lambda s: F.sequence(first(s), first(s) + s["span"].bitwiseAND(F.lit(255)).cast("int") - 1))
    return hashed.select("row", "line", F.array_distinct(F.flatten(places)).alias("gone"))


def _kept(text: str) -> Column:
    stay = F.array_except(F.sequence(F.lit(0), F.size("line") - 1), F.col("gone"))
    return F.when(F.col("gone").isNull(), F.col("row")[text]).otherwise(F.array_join(F.transform(stay, lambda i: F.get("line", i)), ""))


def deduplicated(docs: DataFrame, text: str = "text", id: str = "doc_id", boundary: str = LINES) -> DataFrame:
    """docs without repeated runs: the same rows and columns, with shorter texts."""
    done = repeated(docs, text, id, boundary).select("row", _kept(text).alias("kept"))
    return done.select(*[(F.col("kept") if c == text else F.col("row")[c]).alias(c) for c in docs.columns])


def report(docs: DataFrame, text: str = "text", id: str = "doc_id", boundary: str = LINES) -> DataFrame:
    """(doc_id, n_deleted, text): how many lines of each text go, and what stays."""
    found = repeated(docs, text, id, boundary)
    return found.select(F.col("row")[id].alias("doc_id"), F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).alias("n_deleted"), _kept(text).alias("text"))
