"""Terms of several lists at once: which terms of which list a text holds, and how often.

An automaton over all terms is built once in each Python worker and reads Arrow batches, so a text is gone through once
however many terms there are. The terms are a parameter, some thousands at most; they go to the workers with the
function. Spark splits the work by rows; nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .filters import TERMS

# The terms of the sweep over institutions.
SWEEP_TERMS = [
    "artificial intelligence", "machine learning", "deep learning", "neural network", "natural language processing", "nlp", "computer vision", "reinforcement learning", "transformer",
    "large language model", "llm", "gpt", "bert", "chatgpt", "generative ai", "ai model", "ai system", "convolutional neural", "recurrent neural", "attention mechanism", "image recognition",
    "object detection", "speech recognition", "text mining", "sentiment analysis", "named entity", "random forest", "gradient boosting", "support vector", "decision tree", "clustering",
    "classification algorithm", "feature extraction", "dimensionality reduction", "autonomous", "robotics", "robot learning", "recommendation system", "knowledge graph", "federated learning",
    "transfer learning", "explainable ai", "interpretable", "adversarial", "generative adversarial", "bayesian network", "data-driven", "data driven", "predictive model", "differential privacy",
    "formal verification", "homomorphic encryption", "online learning", "rlhf", "algorithm", "computational", "automated",
]
# The terms of the sweep by author.
AUTHOR_TERMS = [
    "artificial intelligence", "machine learning", "deep learning", "neural network", "natural language processing", "nlp", "computer vision", "reinforcement learning", "transformer",
    "large language model", "llm", "gpt", "bert", "chatgpt", "generative ai", "gen ai", "ai model", "ai system", "convolutional neural", "recurrent neural", "attention mechanism",
    "image recognition", "object detection", "speech recognition", "text mining", "sentiment analysis", "named entity", "random forest", "gradient boosting", "xgboost", "support vector",
    "decision tree", "clustering", "classification algorithm", "regression model", "feature extraction", "dimensionality reduction", "autonomous", "robotics", "robot learning",
    "recommendation system", "collaborative filtering", "knowledge graph", "ontology learning", "federated learning", "transfer learning", "explainable ai", "interpretable", "adversarial", "gan",
    "generative adversarial", "bayesian network", "probabilistic model", "data-driven", "data driven", "predictive model", "algorithm", "computational", "automated", "differential privacy",
    "secure computation", "zero-knowledge", "formal verification", "mechanism design", "homomorphic encryption", "bandit", "regret bound", "online learning", "rlhf",
]
# The terms of the audit of law papers.
LAW_TERMS = [
    "artificial intelligence", "machine learning", "deep learning", "neural network", "algorithm", "automated", "autonomous", "natural language processing", "computer", "data-driven", "predictive",
    "surveillance", "facial recognition", "robot", "big data", "data analytics", "technology", "digital", "platform", "cyber", "privacy", "encryption", "blockchain", "cryptocurrency", "fintech",
    "regtech", "generative ai", "chatgpt", "large language model", "ai governance", "algorithmic", "bias", "fairness", "autonomous vehicle", "self-driving", "drone", "deepfake", "synthetic media",
    "content moderation", "intellectual property", "patent", "copyright", "antitrust", "competition", "innovation",
]
LISTS: dict[str, Sequence[str]] = {"candidates": TERMS, "sweep": SWEEP_TERMS, "author": AUTHOR_TERMS, "law": LAW_TERMS}


def term_hits(rows: DataFrame, id: str, text: Column, lists: Mapping[str, Sequence[str]] = LISTS) -> DataFrame:
    """(id, list, term, hits): each term of each list that a text holds, letters of either case, once a row and list.

    hits counts places that don't overlap, from the left. Terms are in lower case in the result; one that stands twice
    in a list counts once. Null and empty texts hold nothing; so do empty lists, and the empty term is none.
    """
    of: dict[str, list[str]] = {}
    for name, terms in lists.items():
        for term in dict.fromkeys(t.lower() for t in terms if t):
            of.setdefault(term, []).append(name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = ahocorasick.Automaton()
        for term in of:
            automaton.add_word(term, term)
        if of:
            automaton.make_automaton()
        for batch in batches:
            at: list[int] = []
            names, terms, hits = [], [], []
            for i, t in enumerate(batch.column("text").to_pylist()):
                if not t or not of:
                    continue
                free: dict[str, int] = {}
                n: dict[str, int] = {}
                for end, term in automaton.iter(t):
                    if end - len(term) >= free.get(term, -1):  # it begins after the last one ended
                        free[term], n[term] = end, n.get(term, 0) + 1
                for term, count in n.items():
                    for name in of[term]:
                        at.append(i)
                        names.append(name)
                        terms.append(term)
                        hits.append(count)
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(at, pa.int64())), pa.array(names, pa.string()), pa.array(terms, pa.string()), pa.array(hits, pa.int64())], names=[id, "list", "term", "hits"])

    kind = rows.schema[id].dataType.simpleString()
    return rows.select(F.col(id).alias("id"), F.lower(text).alias("text")).mapInArrow(run, f"`{id}` {kind}, list string, term string, hits long")


def list_totals(hits: DataFrame, id: str) -> DataFrame:
    """(list, term, n, hits): how many rows hold a term, and how often."""
    return hits.groupBy("list", "term").agg(F.count(F.lit(1)).alias("n"), F.sum("hits").alias("hits"))
