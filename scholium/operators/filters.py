"""Filters: keywords, vectors, relevance, and the search language."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import cosine, has

# The terms that make a record a candidate, by tier.
PRIMARY_TERMS = [
    "artificial intelligence", "machine learning", "deep learning", "neural network", "natural language processing", "computer vision", "large language model", "generative AI",
    "generative artificial intelligence", "reinforcement learning", "transformer model", "GPT", "BERT", "LLM", "chatbot", "autonomous system", "autonomous vehicle", "robotics", "algorithmic",
    "algorithm bias", "algorithmic fairness", "algorithmic accountability", "algorithmic decision", "automated decision", "predictive model", "predictive analytics", "recommendation system",
    "knowledge graph", "expert system", "intelligent system", "intelligent agent", "multi-agent", "AI governance", "AI regulation", "AI policy", "AI ethics", "AI safety", "AI alignment",
    "responsible AI", "explainable AI", "interpretable machine learning", "fairness in machine learning", "foundation model", "diffusion model", "text-to-image", "speech recognition",
    "image recognition", "object detection", "sentiment analysis", "named entity recognition", "transfer learning", "few-shot learning", "zero-shot", "federated learning", "synthetic data",
    "data augmentation",
]
SECONDARY_TERMS = [
    "computational", "automated", "classification model", "clustering algorithm", "random forest", "support vector machine", "gradient boosting", "convolutional", "recurrent neural",
    "attention mechanism", "word embedding", "semantic similarity", "topic model", "Bayesian network", "Markov", "Monte Carlo", "optimization algorithm", "genetic algorithm",
    "evolutionary computation", "swarm intelligence", "fuzzy logic", "image segmentation", "medical imaging", "clinical decision support", "precision medicine", "drug discovery", "legal tech",
    "legal technology", "computational law", "RegTech", "FinTech", "robo-advisor", "smart contract", "blockchain", "Internet of Things", "edge computing", "natural language generation",
    "question answering", "information retrieval", "information extraction", "text mining", "bioinformatics", "proteomics", "genomics machine learning", "neural architecture",
    "model compression", "quantization", "knowledge distillation", "prompt engineering", "in-context learning", "retrieval augmented generation", "RAG", "vector database", "embedding model",
    "differential privacy", "differentially private", "secure computation", "secure multi-party", "zero-knowledge", "zero knowledge", "formal verification", "mechanism design",
    "homomorphic encryption", "federated learning", "privacy-preserving", "privacy preserving", "adversarial robustness", "adversarial attack", "malware detection", "intrusion detection",
    "anomaly detection", "bandit", "regret bound", "online learning", "stochastic optimization", "convex optimization", "distributional robust", "sample complexity", "PAC learning",
    "reward model", "reinforcement learning from human", "RLHF",
]
TERMS = PRIMARY_TERMS + SECONDARY_TERMS
RELEVANCE = {"primary": 0, "methodological": 1, "peripheral": 2, "not_relevant": 3, "unknown": 4, "error": 5}


def one_of(words: Iterable[str]) -> str:
    """A pattern for any of some words, in which those that begin alike share their beginning."""

    def branch(tails: list[str]) -> str:
        heads: dict[str, list[str]] = {}
        for t in tails:
            if t:
                heads.setdefault(t[0], []).append(t[1:])
        parts = [(c if c.isalnum() or c in " -" else re.escape(c)) + (branch(rest) if rest != [""] else "") for c, rest in heads.items()]
        whole = parts[0] if len(parts) == 1 else f"(?:{'|'.join(parts)})"
        return f"(?:{whole})?" if "" in tails else whole

    return branch(sorted(set(words)))


def has_term(text: Column, terms: Iterable[str] = TERMS, whole_words: bool = False) -> Column:
    """Whether a text has any of the terms, in either case; within words too unless whole_words."""
    low = {t.lower() for t in terms}
    if whole_words:
        return F.lower(text).rlike(rf"(?:^|[^\p{{L}}\p{{N}}_]){one_of(low)}(?:$|[^\p{{L}}\p{{N}}_])")
    return F.lower(text).rlike(one_of(t for t in low if not any(u in t for u in low - {t})))  # a part tells of the whole


def keyword_hit(title: str = "title", abstract: str = "abstract", terms: Iterable[str] = TERMS) -> Column:
    """Whether a paper's title or abstract has any of the terms."""
    return has_term(F.concat_ws(" ", F.coalesce(title, F.lit("")), F.coalesce(abstract, F.lit(""))), terms)


def keyword_filter(papers: DataFrame, title: str = "title", abstract: str = "abstract", terms: Iterable[str] = TERMS) -> DataFrame:
    return papers.filter(keyword_hit(title, abstract, terms))


def embedding_filter(rows: DataFrame, references: list[list[float]], vector: str = "embedding", least: float = 0.25) -> DataFrame:
    """Rows whose vector is near enough to one of a few reference vectors; adds `similarity`."""
    wanted = F.array(*[F.array(*[F.lit(float(x)) for x in r]) for r in references])
    return rows.withColumn("similarity", F.array_max(F.transform(wanted, lambda r: cosine(F.col(vector), r)))).filter(F.col("similarity") >= least)


def relevance_filter(papers: DataFrame, least: str = "methodological", domain: str | None = None, min_year: int | None = None, max_year: int | None = None, relevance: str = "ai_relevance", domains: str = "domains", year: str = "year") -> DataFrame:
    """By tier, by a part of a domain's name, by year; a missing or zero year passes."""
    rank = F.coalesce(F.create_map(*[F.lit(x) for pair in RELEVANCE.items() for x in pair])[F.coalesce(F.col(relevance), F.lit("unknown"))], F.lit(5))
    kept = rank <= RELEVANCE.get(least, 2)
    if domain:
        kept &= has(F.col(domains), lambda d: F.contains(F.lower(d), F.lit(domain.lower())))
    y = F.nullif(F.col(year), F.lit(0))
    if min_year:
        kept &= y.isNull() | (y >= min_year)
    if max_year:
        kept &= y.isNull() | (y <= max_year)
    return papers.filter(kept)


def needs_venue(papers: DataFrame, sources: Iterable[str], platforms: Iterable[str]) -> DataFrame:
    """Records from repositories whose venue is missing or the repository itself."""
    from ..functions.text import alphanumeric

    venue = alphanumeric(F.coalesce("venue", F.lit("")))
    return papers.filter(has(F.col("all_sources"), lambda s: s.isin(list(sources))) & ((venue == "") | venue.isin(list(platforms))))


def needs_classification(papers: DataFrame, flag: str = "needs_model", relevance: str = "ai_relevance") -> DataFrame:
    return papers.filter(F.coalesce(F.col(flag), F.lit(False)) | F.coalesce(F.col(relevance), F.lit("")).isin(""))


def split_relevance(papers: DataFrame, relevance: str = "ai_relevance", error: str = "parse_error") -> tuple[DataFrame, DataFrame]:
    """(kept, rejected) of the rows that were parsed."""
    parsed = papers.filter(~F.coalesce(F.col(error), F.lit(False)))
    rejected = F.coalesce(F.col(relevance), F.lit("")) == "not_relevant"
    return parsed.filter(~rejected), parsed.filter(rejected)


def ambiguous_surname(name: Column, surnames: Iterable[str]) -> Column:
    """Names of at most two parts that end in a common surname, and names without parts."""
    from ..functions.text import words

    parts = words(name)
    return (F.size(parts) == 0) | (F.coalesce(F.get(F.reverse(parts), 0), F.lit("")).isin(list(surnames)) & (F.size(parts) <= 2))


def window_start(as_of: Column, last_full: Column | None = None, days: int = 548, full_after: int = 90) -> Column:
    """Since when to look: everything if the last full sweep is long ago, else a number of days back."""
    start = F.date_sub(as_of, days)
    return start if last_full is None else F.when(last_full.isNull() | (F.datediff(as_of, last_full) >= full_after), F.to_date(F.lit("1990-01-01"))).otherwise(start)


TERM = re.compile(r'(-?)(?:(author|venue|year|school|domain|subfield):)?(?:"([^"]*)"|(\S+))')


def parse_search(query: str) -> list[tuple[bool, str, str]]:
    """(negated, field, value) of each term; a term without a field is free text."""
    return [(m[1] == "-", m[2] or "text", m[3] if m[3] is not None else m[4]) for m in TERM.finditer(query)]


def _author_pattern(value: str) -> str:
    """Names whose words begin with the query's words, in order."""
    parts = [re.escape(w) for w in re.sub(r"[^\w\s]", " ", value.lower()).split()]
    return r"(?:^|\s)" + r"\w*\s+(?:\S+\s+)*?".join(parts) if parts else ""


def search_predicate(query: str, title: str = "title", authors: str = "author_names", venue: str = "venue", year: str = "year", schools: str = "schools", domains: str = "domains", subfields: str = "subfields", summary: str = "summary") -> Column:
    """A search as a predicate; all terms must hold. Free text is looked for in title, authors and summary."""
    part = lambda c, v: F.coalesce(F.contains(F.lower(F.col(c)), F.lit(v.lower())), F.lit(False))
    holds = F.lit(True)
    for negated, field, value in parse_search(query):
        if field == "year":
            low, _, high = value.partition("..")
            found = F.coalesce(F.col(year).between(int(low), int(high or low)), F.lit(False))
        elif field == "author":
            plain = lambda a: F.regexp_replace(F.lower(a), r"(?U)[^\w\s]", " ")
            found = has(F.col(authors), lambda a: plain(a).rlike(_author_pattern(value)))  # noqa: B023
        elif field == "venue":
            found = part(venue, value)
        elif field == "text":
            found = part(title, value) | part(summary, value) | has(F.col(authors), lambda a: F.contains(F.lower(a), F.lit(value.lower())))  # noqa: B023
        else:
            column = {"school": schools, "domain": domains, "subfield": subfields}[field]
            found = has(F.col(column), lambda x: F.contains(F.lower(x), F.lit(value.lower())))  # noqa: B023
        holds &= ~found if negated else found
    return holds


def search(papers: DataFrame, query: str, **columns: str) -> DataFrame:
    return papers.filter(search_predicate(query, **columns))
