"""Matching of people, affiliations, identifiers and titles by prioritised rules.

Rosters, profiles and rule tables are parameters. Joins leave their strategy to Spark, which broadcasts a side only
if it knows it to be small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.arrays import has
from ..functions.text import name_key, surname
from ..storage import stored


def first_rule(text: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The value of the first (pattern, value) whose pattern is found in a text, in either case; null for none."""
    found = F.lit(None).cast("string")
    for pattern, value in reversed(list(rules)):
        found = F.when(text.rlike(f"(?i){pattern}"), F.lit(value)).otherwise(found)
    return found


def roster_ids(roster: DataFrame) -> DataFrame:
    """(id, name, school, secondary_school): by id and by each alternate id, the last row of an id counts."""
    every = F.array_distinct(F.concat(F.array("openalex_id"), F.coalesce("alternate_openalex_ids", F.array().cast("array<string>"))))
    rows = roster.withColumn("id", F.explode(every)).filter("id is not null and id <> ''")
    return rows.groupBy("id").agg(F.max_by(F.struct("name", "school", "secondary_school"), "ord").alias("r")).select("id", "r.*")


def roster_keys(roster: DataFrame) -> DataFrame:
    """(key, n, schools, school): how many entries share a name key, and the school if they share it."""
    keyed = roster.withColumn("key", name_key(F.col("name"))).filter("trim(key) <> ''")
    sums = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_set("school")).alias("schools"), F.collect_set("openalex_id").alias("ids"))
    return sums.withColumn("school", F.when(F.size("schools") == 1, F.col("schools")[0]))


def unambiguous(names: DataFrame, name: str, owner: str) -> DataFrame:
    """(name, owner) of names that one owner alone has."""
    return names.groupBy(name).agg(F.min(owner).alias(owner), F.max(owner).alias("_most")).filter(F.col(owner) == F.col("_most")).drop("_most")


def verify_authors(papers: DataFrame, roster: DataFrame, id: str = "paper_id") -> DataFrame:
    """Papers with an author that is flagged, or known by id, or by a name that one roster entry alone has.

    Authors that are known by either get the flag; their order stays.
    """
    each = papers.select(id, F.posexplode("authors").alias("at", "a"))
    ids = roster_ids(roster).select(F.col("id").alias("_id"), F.lit(True).alias("_known"))
    keys = roster_keys(roster).filter("n = 1").select(F.col("key").alias("_key"), F.lit(True).alias("_alone"))
    met = each.join(ids, F.col("a.openalex_id") == F.col("_id"), "left").withColumn("_k", name_key(F.col("a.name"))).join(keys, F.col("_k") == F.col("_key"), "left")
    flag = F.coalesce(F.col("a.is_bu"), F.lit(False)) | F.col("_known").isNotNull() | F.col("_alone").isNotNull()
    checked = met.groupBy(id).agg(F.array_sort(F.collect_list(F.struct("at", F.col("a").withField("is_bu", flag).alias("a")))).alias("x"))
    rebuilt = checked.select(F.col(id).alias("_paper"), F.transform("x", lambda e: e["a"]).alias("_authors")).filter(has(F.col("_authors"), lambda a: a["is_bu"]))
    return papers.join(rebuilt, papers[id] == F.col("_paper")).select(*[(F.col("_authors") if c == "authors" else F.col(c)).alias(c) for c in papers.columns])


def assign_schools(papers: DataFrame, roster: DataFrame, rules: Sequence[tuple[str, str, str]], institution: Sequence[str], unspecified: str, alternates: DataFrame | None = None, blocked: Sequence[tuple[str, str]] = (), unblock: str = "dental", id: str = "paper_id", most_authors: int = 30) -> DataFrame:
    """papers with bu_schools, bu_category and bu_authors_classified, by four tiers for each author.

    1. The author's id is in the roster. 2. The affiliation, of an author of the institution, meets a rule; it may
    make an unspecified school specific. 3. In papers of few authors, the name key has one school in the roster,
    unless the author has another roster entry's id. 4. The name is an alternate name of one entry. Authors of the
    institution without any have the unspecified school. `rules` are (pattern, school, category), `institution` the
    patterns of the institution's own name, `blocked` (name key, school) pairs that never go together unless the
    affiliation has `unblock`.
    """
    each = papers.select(id, F.size("authors").alias("_n"), F.posexplode("authors").alias("at", "a"))
    each = each.withColumn("key", name_key(F.coalesce("a.name", F.lit("")))).withColumn("aff", F.lower(F.coalesce("a.affiliation", F.lit(""))))
    ids = roster_ids(roster).select(F.col("id").alias("_id"), F.col("school").alias("id_school"), "secondary_school")
    keys = roster_keys(roster).select(F.col("key").alias("_key"), F.col("school").alias("key_school"), F.col("ids").alias("key_ids"))
    met = each.join(ids, F.col("a.openalex_id") == F.col("_id"), "left").join(keys, F.col("key") == F.col("_key"), "left")
    if alternates is not None:
        alt = unambiguous(alternates.select(F.col("name_key").alias("_alt"), "school"), "_alt", "school").withColumnRenamed("school", "alt_school")
        met = met.join(alt, F.col("key") == F.col("_alt"), "left")
    else:
        met = met.withColumn("alt_school", F.lit(None).cast("string"))
    is_blocked = lambda school: F.lit(False) if not blocked else F.coalesce(F.struct("key", school).isin([F.struct(F.lit(k), F.lit(s)) for k, s in blocked]), F.lit(False)) & ~F.contains("aff", F.lit(unblock))
    vague = lambda s: s.isNull() | F.endswith(s, F.lit("(unspecified)"))
    flagged = F.coalesce(F.col("a.is_bu"), F.lit(False))
    one = F.when(~is_blocked(F.col("id_school")), F.col("id_school"))
    met = met.withColumn("s1", one)
    ours = flagged | F.col("s1").isNotNull() | F.col("aff").rlike("|".join(institution))
    by_rule = F.when((F.col("aff") != "") & ours, first_rule(F.col("aff"), [(p, s) for p, s, _ in rules]))
    met = met.withColumn("s2", F.when(vague(F.col("s1")), F.when(F.col("s1").isNull() | ~vague(by_rule), F.coalesce(by_rule, "s1")).otherwise(F.col("s1"))).otherwise(F.col("s1")))
    other_id = F.col("_id").isNotNull() & ~F.coalesce(F.array_contains("key_ids", F.col("a.openalex_id")), F.lit(False))
    third = F.when(~is_blocked(F.col("key_school")) & ~other_id, F.col("key_school"))
    may = (flagged | F.col("s2").isNotNull()) & (F.col("_n") <= most_authors) & (F.trim("key") != "") & vague(F.col("s2"))
    met = met.withColumn("s3", F.when(may, F.coalesce(third, "alt_school", "s2")).otherwise(F.col("s2")))
    met = met.withColumn("school", F.coalesce("s3", F.when(flagged, F.lit(unspecified))))
    category_of = dict((s, c) for _, s, c in reversed(list(rules)))
    category = lambda s: F.coalesce(F.create_map(*[F.lit(x) for pair in category_of.items() for x in pair])[s], F.when(F.contains(s, F.lit("Law")), F.lit("LAW")).otherwise(F.lit("NON-LAW")))
    second = F.when(F.col("school").isNotNull(), F.col("secondary_school"))
    tagged = met.filter("school is not null").select(id, "at", F.struct(F.col("a.name").alias("name"), "school", category(F.col("school")).alias("category")).alias("c"), F.filter(F.array("school", second), lambda s: s.isNotNull()).alias("schools"))
    tagged = tagged.withColumn("categories", F.transform("schools", category))
    by_paper = tagged.groupBy(F.col(id).alias("_paper")).agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("schools")))).alias("_s"), F.array_distinct(F.flatten(F.collect_list("categories"))).alias("_c"), F.transform(F.array_sort(F.collect_list(F.struct("at", "c"))), lambda x: x["c"]).alias("bu_authors_classified")
    )
    schools = F.when(F.size("_s") > 1, F.array_remove("_s", unspecified)).otherwise(F.col("_s"))
    law, other = F.array_contains("_c", F.lit("LAW")), F.array_contains("_c", F.lit("NON-LAW"))
    kind = F.when(law & other, "BOTH").when(law, "LAW").when(other, "NON-LAW").otherwise("UNCLASSIFIED")
    out = papers.drop("bu_schools", "bu_category", "bu_authors_classified").join(by_paper, papers[id] == F.col("_paper"), "left")
    return out.withColumn("bu_schools", F.coalesce(schools, F.array().cast("array<string>"))).withColumn("bu_category", kind).drop("_paper", "_s", "_c")


def resolve_best(candidates: DataFrame, key: str, at_target: Column, works: str, ord: str) -> DataFrame:
    """The best candidate of each key: one at the target before others, then most works, then the first; `rare` if alone."""
    counted = candidates.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_candidates"), F.max_by(F.struct(*candidates.columns), F.struct(F.coalesce(at_target, F.lit(False)).cast("int"), F.coalesce(works, F.lit(0)), -F.col(ord))).alias("best")
    )
    return counted.select("best.*", "n_candidates", (F.col("n_candidates") == 1).alias("rare"))


def canonical_names(authors: DataFrame, by_id: DataFrame, by_alt: DataFrame, by_key: DataFrame) -> DataFrame:
    """authors (id, name, is_bu) with `canonical` and `tier`: roster names by id, alternate name or name key.

    by_id is (id, canonical), by_alt (alt, canonical), by_key (key, canonical); the first two must agree in last names.
    """
    met = authors.join(by_id.select(F.col("id").alias("_i"), F.col("canonical").alias("c1")), authors["id"] == F.col("_i"), "left")
    met = met.join(by_alt.select(F.col("alt").alias("_a"), F.col("canonical").alias("c2")), F.lower("name") == F.lower("_a"), "left")
    met = met.withColumn("_k", name_key(F.col("name"))).join(by_key.select(F.col("key").alias("_key"), F.col("canonical").alias("c3")), F.col("_k") == F.col("_key"), "left")
    agree = lambda c: surname(F.col(c)) == surname(F.col("name"))
    ours = F.coalesce("is_bu", F.lit(False))
    tier = F.when(ours & agree("c1"), 1).when(ours & agree("c2"), 2).when(ours & F.col("c3").isNotNull(), 3)
    name = F.when(tier == 1, F.col("c1")).when(tier == 2, F.col("c2")).when(tier == 3, F.col("c3")).otherwise(F.col("name"))
    return met.select(*authors.columns, name.alias("canonical"), F.coalesce(tier, F.lit(0)).alias("tier"))


def backfill_ids(pairs: DataFrame, ours: str = "authors", theirs: str = "fresh_authors") -> DataFrame:
    """Author ids from a fresh record: by position if both have as many authors, else by name (the last of a name)."""
    plain = lambda n: F.lower(F.trim(n))
    named = F.map_from_entries(F.array_distinct(F.transform(theirs, lambda t: F.struct(plain(t["name"]).alias("k"), F.element_at(F.filter(theirs, lambda u: plain(u["name"]) == plain(t["name"])), -1)["openalex_id"].alias("v")))))
    by_name = F.transform(ours, lambda a: a.withField("openalex_id", F.coalesce(F.nullif(a["openalex_id"], F.lit("")), named[plain(a["name"])])))
    by_place = F.transform(ours, lambda a, i: a.withField("openalex_id", F.coalesce(F.nullif(a["openalex_id"], F.lit("")), F.get(theirs, i)["openalex_id"])))
    return pairs.withColumn(ours, F.when(F.size(ours) == F.size(theirs), by_place).otherwise(by_name))


def similar_sets(left: DataFrame, right: DataFrame, least: float) -> DataFrame:
    """(l, r, similarity) of word sets (column `words`, distinct texts of words apart by single blanks) that share `least` of the larger one's.

    With words in one order, rarest first, a set of n words that shares `least` of them with another has one of its first
    n - ceil(least * n) + 1 words in common with it, so only those are joined on; and from where the first of them stands
    in both sets it follows how many they can share at most.
    """
    both = left.select("words").union(right.select("words"))
    counts = both.select(F.explode(F.split("words", " ")).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("times"))
    need = lambda n: F.ceil(F.lit(least) * n - 1e-9).cast("int")

    def rare(df: DataFrame, p: str) -> DataFrame:
        sized = df.select(F.col("words").alias(p), F.explode(F.split("words", " ")).alias("w"), F.size(F.split("words", " ")).alias(f"{p}_n")).join(counts, "w")
        by = sized.groupBy(p, f"{p}_n").agg(F.array_sort(F.collect_list(F.struct("times", "w"))).alias("by"))  # a title's words
        return by.select(p, f"{p}_n", F.posexplode(F.transform(F.slice("by", F.lit(1), F.col(f"{p}_n") - need(F.col(f"{p}_n")) + 1), lambda x: x["w"])).alias(f"{p}_at", "w"))

    sizes = F.least("l_n", "r_n") >= need(F.greatest("l_n", "r_n"))
    met = rare(left, "l").join(rare(right, "r"), "w").filter(sizes)
    placed = met.groupBy("l", "r").agg(F.min("l_at").alias("i"), F.min("r_at").alias("j"), F.first("l_n").alias("n"), F.first("r_n").alias("m"))
    able = placed.filter(F.least(F.col("n") - F.col("i"), F.col("m") - F.col("j")) >= need(F.greatest("n", "m")))
    shared = F.size(F.array_intersect(F.split("l", " "), F.split("r", " ")))
    return able.select("l", "r", (shared / F.greatest("n", "m")).alias("similarity")).filter(F.col("similarity") >= least)


def best_titles(ours: DataFrame, candidates: DataFrame, least: float = 0.85, rank: str = "rank", years: int = 1) -> DataFrame:
    """(id, candidate, score) of the best candidate for each title.

    Both have id, title, year, surnames; candidates also a rank of their source. A pair must share enough words of
    their titles, be at most a year apart and share a surname where both tell; within the best source the score counts.
    Titles without words match none.

    Equal titles are one set of words, compared once. Of the rows of one set, those of one year that share a surname, or
    have none, differ in rank and id only, so the least stands for all of them: ten thousand equal titles on either side
    don't meet in pairs.
    """
    from ..functions.text import alphanumeric, words

    none = F.array().cast("array<string>")
    key = F.array_join(F.array_sort(F.array_distinct(words(alphanumeric(F.coalesce("title", F.lit("")))))), " ")

    def rows(df: DataFrame, *more: str) -> DataFrame:
        return df.select("id", key.alias("words"), F.coalesce("year", F.lit(0)).alias("y"), F.array_distinct(F.coalesce("surnames", none)).alias("names"), *more).filter("words <> ''")

    a, b = rows(ours), rows(candidates, F.col(rank).alias("rank"))
    pairs = stored(similar_sets(a.select("words").distinct(), b.select("words").distinct(), least), "similar-sets")
    close = (F.col("y") == 0) | (F.col("c_y") == 0) | (F.abs(F.col("y") - F.col("c_y")) <= years)
    alike = F.when((F.col("y") != 0) & (F.col("y") == F.col("c_y")), 0.1).otherwise(0.0)

    def best(mine: DataFrame, theirs: DataFrame, on: list[str], of: list[str], extra: float) -> DataFrame:
        """The best candidate of each profile of ours (words, y and what `of` adds) among theirs, which are reduced likewise."""
        least_of = theirs.groupBy(F.col("words").alias("r"), F.col("y").alias("c_y"), *on).agg(F.min(F.struct("rank", "id")).alias("c"))
        met = mine.join(pairs, mine["words"] == F.col("l")).join(least_of, ["r", *on]).filter(close)
        score = F.col("similarity") + alike + extra
        return met.groupBy("words", "y", *of).agg(F.min(F.struct(F.col("c.rank").alias("rank"), (-score).alias("s"), F.col("c.id").alias("id"))).alias("b"))

    without, named = b.filter(F.size("names") == 0), b.filter(F.size("names") > 0)
    each = lambda df: df.withColumn("name", F.explode("names"))
    profiles = a.select("words", "y", "names").distinct()
    sharing = best(each(profiles), each(b), ["name"], ["names"], 0.05)
    nameless = best(profiles.select("words", "y").distinct(), without, [], [], 0.0)
    silent = best(profiles.filter(F.size("names") == 0).select("words", "y"), named, [], [], 0.0)
    found = sharing.unionByName(profiles.join(nameless, ["words", "y"])).unionByName(profiles.filter(F.size("names") == 0).join(silent, ["words", "y"]))
    top = found.groupBy("words", "y", "names").agg(F.min("b").alias("b"))
    return a.join(top, ["words", "y", "names"]).select("id", F.col("b.id").alias("candidate"), F.round(-F.col("b.s"), 6).alias("score"))


def beginnings(left: DataFrame, right: DataFrame) -> DataFrame:
    """Pairs of rows (last, first, …) of two sides with one last name, of which one first name begins the other.

    One side's first names are taken whole and meet each beginning of the other's, so pairs are found by equality of last
    name and beginning: a last name that very many share is dealt out by first names. Other columns of both are kept.
    """

    def begun(df: DataFrame, proper: int) -> DataFrame:
        some = df.filter(F.length("first") > proper)
        return some.withColumn("_k", F.explode(F.transform(F.sequence(F.lit(1), F.length("first") - proper), lambda n: F.substring("first", 1, n))))

    whole = lambda df: df.withColumn("_k", F.col("first"))
    theirs = lambda df: df.withColumnsRenamed({"last": "_last", "first": "_first"})

    def met(a: DataFrame, b: DataFrame) -> DataFrame:
        b = theirs(b).withColumnRenamed("_k", "_b")
        return a.join(b, (F.col("last") == F.col("_last")) & (F.col("_k") == F.col("_b"))).drop("_k", "_b", "_last", "_first", "last", "first")

    return met(whole(left), begun(right, 0)).union(met(begun(left, 1), whole(right)))


def same_person(left: DataFrame, right: DataFrame) -> DataFrame:
    """Pairs (left id, right id) whose last names are equal and one first name begins the other."""
    from ..functions.text import name_plain, words

    def parts(df: DataFrame, p: str) -> DataFrame:
        w = words(name_plain(F.col("name")))
        return df.select(F.col("id").alias(f"{p}id"), F.get(w, 0).alias("first"), F.get(F.reverse(w), 0).alias("last")).filter(F.col("last").isNotNull())

    return beginnings(parts(left, "l_"), parts(right, "r_")).select("l_id", "r_id")


def missing_names(known: DataFrame, harvested: DataFrame) -> DataFrame:
    """Rows of known whose (last name, first initial) no harvested name has."""
    from ..functions.text import initial_key

    return known.withColumn("_k", initial_key(F.col("name"))).join(harvested.select(initial_key(F.col("name")).alias("_k")).distinct(), "_k", "left_anti").drop("_k")


def name_hits(queries: DataFrame, hits: DataFrame) -> DataFrame:
    """(id, hit): of a name's first two hits the first if last names agree, else the second if they do."""
    ranked = hits.withColumn("_n", F.row_number().over(Window.partitionBy("id").orderBy("ord"))).filter("_n <= 2")
    met = ranked.join(queries.select("id", F.col("name").alias("_name")), "id").filter(surname(F.col("name")) == surname(F.col("_name")))
    return met.groupBy("id").agg(F.min_by("hit", "_n").alias("hit"))


def audit_affiliations(people: DataFrame, histories: DataFrame, target: str) -> DataFrame:
    """people with `status`: confirmed if any affiliation is the target's, unreachable without a history, else wrong."""
    agg = histories.groupBy("id").agg(F.max(F.contains(F.lower("institution"), F.lit(target.lower())).cast("int")).alias("_hit"))
    return people.join(agg, "id", "left").withColumn("status", F.when(F.col("_hit").isNull(), "unreachable").when(F.col("_hit") == 1, "confirmed").otherwise("wrong")).drop("_hit")


def responses(inputs: DataFrame, answers: DataFrame) -> DataFrame:
    """inputs (index, …) with the parsed answer of the response whose custom id names their index."""
    from ..functions.text import parse_response

    read = answers.select(F.get(F.split("custom_id", "_"), 1).try_cast("int").alias("_i"), "ok", "text", "input_tokens", "output_tokens")
    met = inputs.join(read, inputs["index"] == F.col("_i"), "left")
    done = F.coalesce("ok", F.lit(False))
    parsed = parse_response(F.coalesce("text", F.lit("")))
    failed = parsed.withField("ai_relevance", F.lit("unknown")).withField("parse_error", F.lit(True))
    return met.withColumn("classification", F.when(done, parsed).otherwise(failed)).drop("_i", "ok", "text")


def split_profiles(roster: DataFrame, profiles: DataFrame, nearby: Sequence[str], least: int = 10, deals: int = 64) -> DataFrame:
    """(name, primary_id, id, works): other profiles that a person may have.

    roster (name, openalex_id) against profiles (id, display_name, alternatives, works_count, last_institutions): enough works, not the
    person's own profile, any of its names that agrees in the last name while one first name begins the other, and, where last
    institutions are known, one that has a fragment of `nearby`. Names are compared once, however many people and profiles have
    them: what is paired, and kept apart from its repetitions, are distinct names and distinct sets of a profile's names (see
    beginnings() for that join). People and profiles meet last, dealt out to `deals` parts of a name, and their pairs are not moved.
    They meet sorted: a hash join of the repeated people would be judged by their size before they are repeated, and sent through the driver.
    """
    from ..functions.text import name_plain, words

    none = F.array().cast("array<string>")
    parts = lambda c: words(name_plain(c))
    last = F.lower(F.array_join(F.coalesce("last_institutions", none), " "))
    near = (F.size(F.coalesce("last_institutions", none)) == 0) | F.greatest(*[F.contains(last, F.lit(n.lower())) for n in nearby], F.lit(False), F.lit(False))
    big = profiles.filter((F.coalesce("works_count", F.lit(0)) >= least) & near)
    names = big.select(F.col("id"), F.col("works_count").alias("works"), F.explode(F.concat(F.array("display_name"), F.coalesce("alternatives", none))).alias("_n"))
    halves = lambda w: (F.get(F.reverse(w), 0).alias("last"), F.get(w, 0).alias("first"))
    halved = names.select("id", "works", parts(F.col("_n")).alias("_w")).select("id", "works", *halves(F.col("_w"))).filter("last is not null")
    theirs = halved.groupBy("id", "works").agg(F.array_sort(F.collect_set(F.struct("last", "first"))).alias("_names"))
    ours = roster.select("name", F.col("openalex_id").alias("primary_id"), parts(F.col("name")).alias("_w")).select("name", "primary_id", *halves(F.col("_w"))).filter("last is not null").distinct()

    kinds = ours.select("last", "first", F.struct("last", "first").alias("_kind")).distinct()
    alike = beginnings(kinds, theirs.select("_names").distinct().select("_names", F.inline("_names"))).distinct()
    dealt = theirs.join(alike, "_names").select("id", "works", "_kind", F.pmod(F.xxhash64("id"), F.lit(deals)).alias("_deal")).repartition(deals, "_kind", "_deal")
    every = ours.select("name", "primary_id", F.struct("last", "first").alias("_kind"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(deals - 1).cast("long"))).alias("_deal"))
    return every.join(dealt.hint("merge"), ["_kind", "_deal"]).filter(~F.col("id").eqNullSafe(F.col("primary_id"))).select("name", "primary_id", "id", "works")
