"""Scalar functions on texts, names, identifiers and dates, as Column to Column."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from functools import lru_cache
from html.entities import html5, name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

# Markup that is taken out of titles and abstracts.
INLINE_TAGS = ["title", "p", "i", "b", "em", "strong", "sub", "sup", "scp", "sc", "small", "span", "br", "hr", r"jats:[a-zA-Z\-]+", r"mml:[a-zA-Z\-]+", "tex-math"]
DOI_PREFIXES = ["https://doi.org/", "http://doi.org/", "doi:", "doi.org/"]
STOP_FRAGMENTS = ["meet our", "faculty &", "result", "department", "division", "refine", "also see", "recent news", "upcoming", "award", "previous", "academic", "about", "research", "contact", "overview", "program", "major", "minor"]
SOURCE_LABELS = {
    "openalex": "OpenAlex", "dblp": "DBLP", "openbu": "OpenBU", "pubmed": "PubMed", "nih_reporter": "NIH Reporter", "semantic_scholar": "Semantic Scholar",
    "ssrn": "SSRN", "scholarly_commons": "Scholarly Commons", "crossref": "CrossRef", "nsf_awards": "NSF Awards", "biorxiv_medrxiv": "bioRxiv/medRxiv",
}
KEY_STOP_WORDS = ["with", "from", "that", "this", "have", "been"]


def blank(c: Column) -> Column:
    """Null for the empty text: what counts as missing."""
    return F.nullif(c, F.lit(""))


#: What the references 128 to 159 stand for: characters of Windows, and controls where it has none.
_WINDOWS = bytes(range(0x80, 0xA0)).decode("cp1252", errors="replace")
_WINDOWS = "".join(chr(0x80 + i) if ch == "\ufffd" else ch for i, ch in enumerate(_WINDOWS))


def _character(code: Column) -> Column:
    """The character of a numeric reference; the replacement character where there is none, nothing for controls."""
    none = (code == 0) | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF)
    control = code.between(1, 8) | (code == 11) | code.between(14, 31) | (code == 127) | code.between(0xFDD0, 0xFDEF) | (code.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE)
    char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    return F.when(none, F.lit("\ufffd")).when(control, F.lit("")).when(code.between(0x80, 0x9F), F.substring(F.lit(_WINDOWS), code.cast("int") - 0x7F, F.lit(1))).otherwise(char)


#: Names of references with what they stand for, as one text to look in, those of HTML 4 first: a table in the plan would be copied and sorted there.
_NAMES = "\u0001" + "".join(f"{name}\u0002{html5[name]}\u0001" for name in sorted(html5, key=lambda n: n.rstrip(";") not in name2codepoint))
_BARE = "|".join(sorted((n for n in html5 if not n.endswith(";")), key=len, reverse=True))


def unescape(c: Column) -> Column:
    """Numeric character references, and the named ones of HTML 5, each replaced once.

    A name that is none takes as its reference the longest old name that it begins with, which needs no semicolon.
    The text is read once for its references, however many there are.
    """
    pattern = "&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]*;?)"
    names = F.lit(_NAMES)

    def found(name: Column) -> Column:
        at = F.position(F.concat(F.lit("\u0001"), name, F.lit("\u0002")), names)
        return once(at, lambda a: F.when(a > 0, F.split_part(F.substring(names, a + F.length(name) + 2, F.lit(3)), F.lit("\u0001"), F.lit(1))))

    def value(ref: Column) -> Column:
        hexadecimal = F.lower(F.left(ref, F.lit(3))) == "&#x"
        digits = F.ltrim(F.regexp_replace(ref, "[&#xX;]", ""), F.lit("0"))
        read = F.call_function("conv", F.concat(F.lit("0"), digits), F.when(hexadecimal, 16).otherwise(10), F.lit(10)).cast("long")
        numeric = once(F.when(F.length(digits) > 8, F.lit(0x110000)).otherwise(read), _character)
        name = F.substring(ref, 2, 1 << 20)
        bare = F.regexp_extract(ref, f"^&({_BARE})", 1)
        begun = once(bare, lambda b: F.concat(found(b), F.substring(ref, F.length(b) + 2, F.lit(1 << 20))))
        named = F.coalesce(once(name, found), begun, ref)
        return F.when(F.startswith(ref, F.lit("&#")), numeric).otherwise(named)

    refs = F.regexp_extract_all(c, F.lit(pattern), F.lit(0))
    parts = F.zip_with(F.split(c, pattern), refs, lambda p, ref: F.concat(p, F.coalesce(value(ref), F.lit(""))))
    return F.when(F.contains(c, F.lit("&")), F.array_join(parts, "")).otherwise(c)


def collapse(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)\s+", " ")


def sanitize(c: Column) -> Column:
    """Without inline markup and references, white space collapsed and trimmed."""
    return F.trim(collapse(F.regexp_replace(unescape(c), rf"(?i)</?(?:{'|'.join(INLINE_TAGS)})\s*[^>]*>", "")))


def normalize_clean(c: Column) -> Column:
    """normalize_title() of what sanitize() gave."""
    return F.coalesce(collapse(F.regexp_replace(F.trim(F.lower(c)), r"(?U)[^\w\s]", "")), F.lit(""))


def normalize_title(c: Column) -> Column:
    """Lower case, letters, digits and underscores only; what deletion leaves at the ends stays."""
    return normalize_clean(sanitize(c))


def fingerprint(c: Column) -> Column:
    return F.md5(normalize_title(c))


def normalize_doi(c: Column) -> Column:
    c = F.lower(F.trim(c))
    for p in DOI_PREFIXES:
        c = F.when(F.startswith(c, F.lit(p)), F.substring(c, len(p) + 1, 1 << 30)).otherwise(c)
    return blank(c)


def once(c: Column, f: Callable[[Column], Column]) -> Column:
    """f(c), for which c is worked out once however often f uses it: it is the only element of an array."""
    return F.get(F.transform(F.array(c), f), 0)


@lru_cache(1)
def _accents() -> tuple[str, str]:
    """Characters that are one character and marks, and that character."""
    pairs = [(chr(c), "".join(x for x in unicodedata.normalize("NFKD", chr(c)) if not unicodedata.combining(x))) for r in ((0xA0, 0x250), (0x1E00, 0x1F00)) for c in range(*r)]
    pairs = [(a, b) for a, b in pairs if len(b) == 1 and a != b]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def fold(c: Column) -> Column:
    """Latin letters without their accents, whether they are one character or several. Texts of one byte a character have none."""
    return F.when(F.octet_length(c) == F.char_length(c), c).otherwise(F.regexp_replace(F.translate(c, *_accents()), r"\p{M}+", ""))


def name_hyphenated(c: Column) -> Column:
    """Name form that keeps hyphens."""
    return collapse(F.regexp_replace(F.trim(F.lower(fold(c))), r"[^a-z\s-]", ""))


def name_plain(c: Column) -> Column:
    """Name form without hyphens."""
    return collapse(F.regexp_replace(F.trim(F.lower(fold(c))), r"[^a-z\s]", ""))


def alphanumeric(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(fold(c)), r"[^a-z0-9]+", " "))


def folded(c: Column) -> Column:
    """Accents and case only."""
    return F.trim(collapse(F.lower(fold(c))))


def keep_accents(c: Column) -> Column:
    return F.trim(collapse(F.regexp_replace(F.lower(c), r"(?U)[^\w\s]", "")))


def words(c: Column) -> Column:
    return F.filter(F.split(F.trim(c), r"\s+"), lambda w: w != "")


def name_key(c: Column) -> Column:
    """`last first`, or the whole form of a name of one part."""
    key = lambda x: F.when(F.size(x["parts"]) >= 2, F.concat_ws(" ", F.element_at(x["parts"], -1), F.element_at(x["parts"], 1))).otherwise(x["form"])
    return once(name_hyphenated(c), lambda h: once(F.struct(h.alias("form"), words(h).alias("parts")), key))


def plain_key(c: Column) -> Column:
    parts = words(name_plain(c))
    return F.when(F.size(parts) >= 2, F.concat_ws(" ", F.element_at(parts, -1), F.element_at(parts, 1))).otherwise(F.concat(name_plain(c), F.lit(" ")))


def initial_key(c: Column) -> Column:
    """`last f`."""
    parts = words(name_plain(c))
    return F.when(F.size(parts) >= 2, F.concat_ws(" ", F.element_at(parts, -1), F.substring(F.element_at(parts, 1), 1, 1))).otherwise(F.concat(name_plain(c), F.lit(" ")))


def surname(c: Column) -> Column:
    return F.coalesce(F.get(F.reverse(words(alphanumeric(c))), 0), F.lit(""))


def strip_number_suffix(c: Column) -> Column:
    return F.regexp_replace(c, r"\s+\d{4}$", "")


def clean_name(c: Column) -> Column:
    """Without titles, degrees and parentheses."""
    c = F.regexp_replace(c, r"(?i)\b(Ph\.?D\.?|M\.?D\.?|J\.?D\.?|M\.?S\.?|M\.?A\.?|Dr\.?|Prof\.?|Professor)\b", "")
    c = F.trim(F.regexp_replace(F.regexp_replace(c, r"\(.*?\)", ""), r"\s+", " "))
    return F.btrim(c, F.lit("., "))


def is_person_name(c: Column) -> Column:
    stop = "|".join(f"\\Q{s}\\E" for s in STOP_FRAGMENTS)
    return F.size(words(c)).between(2, 6) & ~c.rlike(r"(?U)\d") & (F.length(c) <= 60) & ~F.lower(c).rlike(stop)


def first_last(c: Column) -> Column:
    """`Last, First` as `First Last`."""
    parts = F.split(c, ",", 2)
    return F.when(F.contains(c, F.lit(",")), F.trim(F.concat_ws(" ", F.trim(F.get(parts, 1)), F.trim(F.get(parts, 0))))).otherwise(c)


def last_first(c: Column) -> Column:
    """`First Middle Last` as `Last, First Middle`."""
    parts = words(c)
    return F.when(F.size(parts) >= 2, F.concat(F.element_at(parts, -1), F.lit(", "), F.array_join(F.slice(parts, 1, F.size(parts) - 1), " "))).otherwise(c)


def author_line(names: Column) -> Column:
    """Five names at most, and how many there are if there are more."""
    return F.when(F.size(names) > 5, F.concat(F.array_join(F.slice(names, 1, 5), ", "), F.lit(", et al. ("), F.size(names).cast("string"), F.lit(" authors)"))).otherwise(F.array_join(names, ", "))


def first_year(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, r"(\d{4})", 1), F.lit("")).try_cast("int")


def title_similarity(a: Column, b: Column) -> Column:
    """Shared words by the larger number of words; 0 if either has none."""
    x, y = (F.array_distinct(words(alphanumeric(F.coalesce(c, F.lit(""))))) for c in (a, b))
    most = F.greatest(F.size(x), F.size(y))
    return F.when((F.size(x) == 0) | (F.size(y) == 0), F.lit(0.0)).otherwise(F.size(F.array_intersect(x, y)) / most)


def best_url(pdf: Column, url: Column, doi: Column) -> Column:
    """The file, else an address that is not the aggregator's, else the DOI's."""
    return F.coalesce(blank(pdf), F.when(~F.contains(url, F.lit("openalex.org")), blank(url)), F.concat(F.lit("https://doi.org/"), blank(doi)))


def export_url(pdf: Column, url: Column, doi: Column) -> Column:
    """For exports the DOI comes first."""
    return F.coalesce(F.concat(F.lit("https://doi.org/"), blank(doi)), blank(pdf), blank(url), F.lit(""))


def bar(n: Column, step: int) -> Column:
    return F.repeat(F.lit("█"), F.floor(n / step).cast("int"))


def source_label(c: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in SOURCE_LABELS.items() for x in pair])
    return F.coalesce(table[c], c)


def tokens(c: Column) -> Column:
    """Estimated tokens of a text."""
    return F.floor(F.length(F.coalesce(c, F.lit(""))) / 4)


def thousands(c: Column) -> Column:
    return F.format_number(c, 0)


def percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, F.round(part * 100.0 / whole, 1)).otherwise(F.lit(0.0))


def slashed_date(c: Column) -> Column:
    return F.date_format(F.to_date(c), "yyyy/MM/dd")


def american_date(c: Column) -> Column:
    return F.date_format(F.to_date(c), "MM/dd/yyyy")


def compact_date(c: Column) -> Column:
    return F.date_format(F.to_date(c), "yyyyMMdd")


def inverted_text(index: Column) -> Column:
    """The text of a map from words to their positions."""
    placed = F.flatten(F.transform(F.map_entries(index), lambda e: F.transform(e["value"], lambda p: F.struct(p.alias("at"), e["key"].alias("word")))))
    return F.array_join(F.transform(F.sort_array(placed), lambda x: x["word"]), " ")


def inverted_index(words: Column) -> Column:
    """The map from an array's distinct words to their positions, which inverted_text() reads. Built within the row, from one sort."""
    word = lambda placed, i: F.get(placed, i)["word"]

    def entries(placed: Column) -> Column:
        begins = F.filter(F.sequence(F.lit(0), F.size(placed) - 1), lambda i: (i == 0) | (word(placed, i) != word(placed, i - 1)))
        ends = lambda b: F.concat(F.slice(b, F.lit(2), F.size(b)), F.array(F.size(placed)))
        entry = lambda i, j: F.struct(word(placed, i), F.transform(F.slice(placed, i + 1, j - i), lambda x: x["at"]))
        return once(begins, lambda b: F.zip_with(b, ends(b), entry))

    placed = F.sort_array(F.transform(words, lambda w, i: F.struct(w.alias("word"), i.alias("at"))))
    none = F.create_map().cast("map<string,array<int>>")
    return F.when(F.size(words) > 0, F.map_from_entries(once(placed, entries))).when(F.size(words) == 0, none)


RESPONSE = "ai_relevance string, confidence double, publication_status string, one_line_summary string, domains array<string>, subfields array<string>, annotation string"


def parse_response(c: Column) -> Column:
    """A model's JSON answer, fenced or not, with defaults; text that is no JSON is kept as the annotation."""
    clean = F.trim(c)
    fenced = F.trim(F.regexp_replace(F.regexp_replace(clean, r"(?s)^```[^\n]*\n", ""), r"(?s)```(?!.*```).*$", ""))
    body = F.when(F.startswith(clean, F.lit("```")), fenced).otherwise(clean)
    good = F.try_parse_json(body).isNotNull()
    read = F.from_json(body, RESPONSE)
    empty = F.array().cast("array<string>")
    return F.struct(
        F.when(good, F.coalesce(read["ai_relevance"], F.lit("peripheral"))).otherwise("peripheral").alias("ai_relevance"),
        F.when(good, F.coalesce(read["confidence"], F.lit(0.5))).otherwise(0.5).alias("confidence"),
        F.when(good, F.coalesce(read["publication_status"], F.lit("other"))).otherwise("other").alias("publication_status"),
        F.when(good, F.coalesce(read["one_line_summary"], F.lit(""))).otherwise("").alias("one_line_summary"),
        F.when(good, F.coalesce(read["domains"], empty)).otherwise(empty).alias("domains"),
        F.when(good, F.coalesce(read["subfields"], empty)).otherwise(empty).alias("subfields"),
        F.when(good, F.coalesce(read["annotation"], F.lit(""))).otherwise(F.substring(c, 1, 300)).alias("annotation"),
        (~good).alias("parse_error"),
    )


def character(code: Column) -> Column:
    """The character of a code point; char() takes a number's last eight bits only. Numbers from 0xD800 on skip the surrogates."""
    point = F.when(code < 0xD800, code).otherwise(code + 0x800)
    return F.decode(F.unhex(F.concat(F.lit("0000FEFF"), F.lpad(F.hex(point), 8, "0"))), "UTF-32")  # the mark tells the order of bytes


def bibtex_key(first_author: Column, year: Column, title: Column, unknown: str = "unknown") -> Column:
    """Last name, year, and the first longer word of the title, of letters, numerals and underscores; `unknown` for a name without words."""
    plain = lambda w: F.regexp_replace(w, r"[^\p{L}\p{N}_]", "")
    name = F.coalesce(F.get(F.reverse(words(F.coalesce(first_author, F.lit("Unknown")))), 0), F.lit(unknown))
    cleaned = F.transform(words(F.coalesce(title, F.lit(""))), plain)
    long = F.filter(cleaned, lambda w: (F.length(w) > 3) & ~F.lower(w).isin(KEY_STOP_WORDS))
    return F.concat(plain(name), F.coalesce(year.cast("string"), F.lit("nodate")), F.lower(F.coalesce(F.get(long, 0), F.lit(""))))
