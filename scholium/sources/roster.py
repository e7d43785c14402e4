"""Rosters: people from directory pages, their profiles, and what is harvested by their identifiers.

Pages are read as landed. Selectors and page styles are parameters.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import clean_name, folded, is_person_name
from ..operators.analytics import count_values, per_decade
from ..operators.dedup import keep_first, new_records, within_batch
from ..operators.filters import has_term
from ..operators.maintain import numbered
from ..storage import stored


@dataclass(frozen=True)
class Strategy:
    """Where names stand: cards, then the first of `names` in a card (all of them with `every`, the card itself with none).

    `fallback` is looked for where a card has none of `names`. `comma` cuts the text at commas: "title" takes the second part as
    the title, "name" drops it. `within` keeps elements whose address has one of its parts.
    """

    cards: str
    names: str = ""
    titles: str = ""
    fallback: str = ""
    every: bool = False
    comma: str = ""
    within: tuple[str, ...] = ()


# The selectors of directory pages, in the order in which they are tried.
STRATEGIES = (
    Strategy(".sph-profile-basic-card", ".sph-profile-basic-content", comma="title"),
    Strategy("div.profile-item, li.profile-item", ".profile-name, h3 a, h4 a, h3, h4", ".profile-title, .profile-department"),
    Strategy("li.bu-filtering-result-item", "a"),
    *(
        Strategy(card, "span.name, h3.name, h2.name, a.name, .profile-name, h3 a, h2 a", "span.title, .profile-title, p.title, .position", fallback="h3, h2, h4")
        for card in ("div.faculty-card", "div.person-card", "div.profile-card", "article.profile", "div.faculty-member")
    ),
    Strategy("div.profile-listing", "a", every=True, within=("profile",)),
    Strategy("h3, h4, h5", comma="name"),
    Strategy("h2 a, h3 a, h4 a", within=("profile", "people", "faculty")),
)

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
SILENT = {"script", "style", "template"}


class Node:
    __slots__ = ("tag", "classes", "href", "parent", "children")

    def __init__(self, tag: str, attrs: dict[str, str | None], parent: Node | None):
        self.tag, self.classes, self.href, self.parent = tag, set((attrs.get("class") or "").split()), attrs.get("href") or "", parent
        self.children: list[Node | str] = []

    def all(self) -> Iterator[Node]:
        """The elements within, in page order."""
        left = [c for c in reversed(self.children) if isinstance(c, Node)]
        while left:
            node = left.pop()
            yield node
            left.extend(c for c in reversed(node.children) if isinstance(c, Node))

    def text(self) -> str:
        """Its trimmed texts, joined without a space."""
        out, left = [], [self]
        while left:
            node = left.pop()
            if isinstance(node, str):
                out.append(node.strip())
            elif node is self or node.tag not in SILENT:
                left.extend(reversed(node.children))
        return "".join(out)


class Tree(HTMLParser):
    """Elements of a page; an end tag closes the nearest open element of its name."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)
        self.open: dict[str, int] = {}
        self.feed(html)
        self.close()

    def handle_starttag(self, tag, attrs):
        node = Node(tag, dict(attrs), self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at, self.open[tag] = node, self.open.get(tag, 0) + 1

    def handle_startendtag(self, tag, attrs):
        self.at.children.append(Node(tag, dict(attrs), self.at))

    def handle_endtag(self, tag):
        if self.open.get(tag):
            while True:
                closed, self.at = self.at, self.at.parent
                self.open[closed.tag] -= 1
                if closed.tag == tag:
                    break

    def handle_data(self, data):
        self.at.children.append(data)


def _fits(node: Node, simple: str) -> bool:
    tag, *classes = simple.split(".")
    return (not tag or node.tag == tag) and node.classes.issuperset(classes)


def _select(top: Node, selector: str) -> Iterator[Node]:
    """Elements within `top` that a list of selectors of tags, classes and descent takes, in page order."""
    chains = [s.split() for s in selector.split(",")]
    for node in top.all():
        for *before, last in chains:
            if not _fits(node, last):
                continue
            up, wanted = node.parent, list(before)
            while wanted and up is not None:
                if _fits(up, wanted[-1]):
                    wanted.pop()
                up = up.parent
            if not wanted:
                yield node
                break


def names_of_page(html: str, strategies: Sequence[Strategy] = STRATEGIES) -> list[tuple[int, str, str]]:
    """(strategy, text, title) of all that each strategy finds; which of them are names is told by people()."""
    root, found = Tree(html).root, []
    for i, s in enumerate(strategies):
        for card in _select(root, s.cards):
            if not s.names:
                at = [card]
            else:
                at = list(_select(card, s.names)) if s.every else [n for n in [next(_select(card, s.names), None) or (next(_select(card, s.fallback), None) if s.fallback else None)] if n is not None]
            title = next(_select(card, s.titles), None) if s.titles else None
            for node in at:
                if s.within and not any(w in node.href for w in s.within):
                    continue
                text, role = node.text(), title.text() if title is not None else ""
                if s.comma:
                    parts = [p.strip() for p in text.split(",")]
                    text, role = parts[0], parts[1] if s.comma == "title" and len(parts) > 1 else role
                found.append((i, text, role))
    return found


def scan(pages: DataFrame, html: str = "html", strategies: Sequence[Strategy] = STRATEGIES) -> DataFrame:
    """pages, without `html`, with `names`: (strategy, at, text, title) of all strategies. A null or empty page has none."""
    kept = [f for f in pages.schema.fields if f.name != html]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + ["names array<struct<strategy:int,at:int,text:string,title:string>>"])

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = batch[[f.name for f in kept]].copy()
            out["names"] = [[{"strategy": s, "at": i, "text": t, "title": r} for i, (s, t, r) in enumerate(names_of_page(h, strategies))] if h else [] for h in batch[html]]
            yield out

    return pages.select(*[F.col(f"`{f.name}`") for f in kept], html).mapInPandas(read, schema)


def people(scanned: DataFrame) -> DataFrame:
    """scanned with `people`: cleaned names of persons with titles, of the first strategy that finds any, each name once a page."""
    cleaned = F.transform("names", lambda n: F.struct(n["strategy"].alias("strategy"), n["at"].alias("at"), clean_name(n["text"]).alias("name"), n["title"].alias("title")))
    persons = F.filter(cleaned, lambda n: is_person_name(n["name"]))
    first = F.array_min(F.transform("_persons", lambda n: n["strategy"]))
    taken = F.filter("_persons", lambda n: n["strategy"] == F.col("_first"))
    keys = F.transform("_taken", lambda n: F.lower(n["name"]))
    once = F.filter("_taken", lambda n, i: F.array_position(F.col("_keys"), F.lower(n["name"])) == i + 1)
    out = scanned.withColumn("_persons", persons).withColumn("_first", first).withColumn("_taken", taken).withColumn("_keys", keys)
    return out.withColumn("people", F.transform(once, lambda n: F.struct(n["name"].alias("name"), n["title"].alias("title")))).drop("names", "_persons", "_first", "_taken", "_keys")


def page_url(url: Column, page: Column, style: Column) -> Column:
    """The address of a directory's page: `num`, `paged`, or a path; the first is the directory's own."""
    bare, n = F.regexp_replace(url, "/+$", ""), page.cast("string")
    num = F.concat(F.when(F.endswith(url, F.lit("/")), url).otherwise(F.concat(url, F.lit("/"))), F.lit("?num="), n)
    return F.when(page == 1, url).when(style == "num", num).when(style == "paged", F.concat(bare, F.lit("?paged="), n)).otherwise(F.concat(bare, F.lit("/page/"), n, F.lit("/")))


def reached(listings: DataFrame, directory: str = "source_url", page: str = "page", n: str = "n", free: int = 3) -> DataFrame:
    """Pages of each directory that paging comes to: up to a page that is not there, or an empty one beyond the first few."""
    w = Window.partitionBy(directory).orderBy(page)
    stops = F.sum(F.when((F.col(page) > free) & (F.col(n) == 0), 1).otherwise(0)).over(w)
    return listings.withColumn("_stops", stops).withColumn("_at", F.row_number().over(w)).filter((F.col("_stops") == 0) & (F.col("_at") == F.col(page))).drop("_stops", "_at")


def roster(pages: DataFrame, strategies: Sequence[Strategy] = STRATEGIES) -> tuple[DataFrame, DataFrame]:
    """pages (school, ord of its directory, source_url, page, html) as people (name, title, school, source_url) and counts (school, n).

    Each name once a school for the counts, then once of all: the first by school's directory, page and place, in any case.
    """
    listed = people(scan(pages.select("school", "ord", "source_url", "page", "html"), strategies=strategies)).withColumn("n", F.size("people"))
    each = reached(listed).select("school", "ord", "source_url", "page", F.posexplode("people").alias("at", "p")).select("school", "ord", "source_url", "page", "at", "p.*")
    each = each.withColumn("_key", F.lower("name"))
    counts = each.groupBy("school").agg(F.countDistinct("_key").alias("n"))
    return keep_first(each, ["_key"], ["ord", "page", "at"]).select("name", "title", "school", "source_url"), counts


def profiles(raw: DataFrame) -> DataFrame:
    """(id, name, alt_names, works_count, last_institution) of author records (id, display_name, display_name_alternatives, …)."""
    none = F.array().cast("array<string>")
    last = F.coalesce(F.get("last_known_institutions", 0)["display_name"], F.lit(""))
    return raw.select("id", F.col("display_name").alias("name"), F.coalesce("display_name_alternatives", none).alias("alt_names"), F.coalesce("works_count", F.lit(0)).alias("works_count"), last.alias("last_institution"))


def unknown_profiles(fresh: DataFrame, known: DataFrame) -> DataFrame:
    """Fresh profiles whose name no known one has: how many there are is what a refresh reports."""
    key = F.trim(F.lower(F.coalesce("name", F.lit(""))))
    return fresh.withColumn("_k", key).join(known.select(key.alias("_k")).distinct(), "_k", "left_anti").drop("_k")


def by_author(papers: DataFrame, people: DataFrame, master: DataFrame, terms: Sequence[str]) -> DataFrame:
    """Papers of people by identifier that master lacks and that speak of the subject, each once.

    papers (author_id, title, abstract, doi, fp, arrival, …) with a row for each author that a paper was asked for by, people
    (openalex_id, name, school). `_harvested_via` and `_faculty_school` tell the person by whom a paper was met first.
    """
    of = people.filter(F.nullif("openalex_id", F.lit("")).isNotNull()).groupBy(F.col("openalex_id").alias("author_id")).agg(F.min(F.struct("name", F.coalesce("school", F.lit("")).alias("school"))).alias("_who"))
    text = F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("abstract", F.lit("")))
    met = papers.filter(has_term(text, terms)).join(of, "author_id")
    fresh = within_batch(new_records(met, [master]))
    return fresh.withColumn("_harvested_via", F.col("_who.name")).withColumn("_faculty_school", F.col("_who.school")).drop("_who")


def cached(authors: DataFrame, path: str, harvest: Callable[[DataFrame], DataFrame], today: Column, days: int = 30, author: str = "author_id") -> DataFrame:
    """What harvest() gives for authors (author_id), of whom only those without a harvest of the last `days` are asked for again.

    The cache is a table in folders by author. A new harvest replaces the folders of its authors, and no others; each gets
    a row that tells when, also an author of whom nothing came. Authors that are not asked for are not read: their folders
    are pruned. harvest() is called once at most, with the authors that are due, and gives rows with their author_id.
    """
    spark = authors.sparkSession
    of = F.concat(F.lit("of "), F.col(author).cast("string")).alias("_of")  # a text, whatever the identifiers look like in a folder's name
    wanted = stored(authors.select(author, of).filter("_of is not null").distinct(), "cache-wanted")
    if wanted.isEmpty():
        return harvest(wanted.select(author))
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)
    due = wanted
    if there:
        due = wanted.join(spark.read.parquet(path).filter(F.col("_at") > F.date_sub(today, days)).select("_of"), "_of", "left_anti")
    due = stored(due.select(author), "cache-due")
    if not (there and due.isEmpty()):
        rows = harvest(due).join(due, author, "left_semi").withColumn("_at", F.lit(None).cast("date"))
        marked = rows.unionByName(due.withColumn("_at", today), allowMissingColumns=True).withColumn("_of", of)
        marked.repartition("_of").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_of").parquet(path)
    return spark.read.option("mergeSchema", True).parquet(path).filter("_at is null").join(wanted.select("_of"), "_of", "left_semi").drop("_at", "_of")


def author_breakdown(harvested: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(school, n) and (decade, n) of what by_author() found."""
    return count_values(harvested.select(F.array("_faculty_school").alias("v")), "v", "school"), per_decade(harvested)


def backfill(papers: DataFrame, names: DataFrame, people: DataFrame, most: int = 20, order: str = "ord") -> DataFrame:
    """Whole histories (author_id, …) of the first few new names (name, ord) that have an identifier in people (name, openalex_id)."""
    first = names.orderBy(order, "name").limit(most)
    ids = people.select(folded(F.col("name")).alias("_n"), "openalex_id").join(first.select(folded(F.col("name")).alias("_n")).distinct(), "_n")
    return papers.join(ids.select(F.col("openalex_id").alias("author_id")).filter("author_id <> ''").distinct(), "author_id", "left_semi")


def search_text(affiliation: str, subjects: Sequence[str], words: Sequence[str]) -> str:
    """A search of a medical index: an affiliation and any subject heading or word of titles and abstracts."""
    either = [f'"{s}"[MeSH Terms]' for s in subjects] + [f'"{w}"[Title/Abstract]' for w in words]
    return f'("{affiliation}"[Affiliation]) AND ({" OR ".join(either)})'


def id_batches(ids: DataFrame, id: str = "id", size: int = 200) -> DataFrame:
    """(batch, ids): distinct identifiers in order, as many a request as it takes."""
    ranked = numbered(ids.select(F.col(id).alias("id")).filter("id is not null").distinct(), "id", "_place")
    return ranked.groupBy(F.floor(F.col("_place") / size).alias("batch")).agg(F.array_sort(F.collect_list("id")).alias("ids"))
