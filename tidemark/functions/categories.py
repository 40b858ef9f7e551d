"""Keyword categories: the first category with a keyword inside the lower-cased text wins.

Keywords match as substrings, so ``ai`` also hits ``said``.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Categories of articles, in order of precedence.
ARTICLE_KEYWORDS = {
    "technology": [
        "ai",
        "artificial intelligence",
        "machine learning",
        "tech",
        "software",
        "computer",
        "digital",
    ],
    "business": [
        "market",
        "business",
        "economy",
        "finance",
        "company",
        "startup",
        "investment",
    ],
    "science": ["science", "research", "study", "discovery", "innovation", "breakthrough"],
    "entertainment": ["movie", "game", "entertainment", "music", "film", "gaming"],
    "sports": ["sport", "football", "basketball", "soccer", "olympic", "championship"],
    "health": [
        "health",
        "medical",
        "medicine",
        "doctor",
        "hospital",
        "disease",
        "treatment",
    ],
}

# Categories of images, in order of precedence.
IMAGE_KEYWORDS = {
    "nature": ["nature", "earth", "landscape", "mountain", "forest"],
    "technology": ["tech", "computer", "machine", "robot"],
    "urban": ["city", "urban", "building", "architecture"],
    "vehicles": ["car", "vehicle", "transport"],
}

DEFAULT_CATEGORY = "general"


def first_category(
    value: Column | str, keywords: dict[str, list[str]], default: str = DEFAULT_CATEGORY
) -> Column:
    """First key of ``keywords`` with a listed word in ``value``, else ``default``."""
    text = F.lower(F.col(value) if isinstance(value, str) else value)
    branches = [
        (reduce(or_, [F.contains(text, F.lit(word)) for word in words]), name)
        for name, words in keywords.items()
    ]
    condition, name = branches[0]
    chain = F.when(condition, name)
    for condition, name in branches[1:]:
        chain = chain.when(condition, name)
    return chain.otherwise(default)


class _Automaton:
    """All keywords as one Aho-Corasick automaton, built once in every Python worker."""

    def __init__(self, keywords: dict[str, list[str]]):
        self.names = list(keywords)
        self.words: dict[str, int] = {}
        for rank, words in enumerate(keywords.values()):
            for word in words:
                self.words.setdefault(word, rank)
        self.built = None

    def first(self, text: str) -> int:
        """The least rank of a keyword in the text; the number of categories if there is none.

        The text is read once, and no further than to a keyword of the first category.
        """
        best = self.words.get("", len(self.names))
        if self.built is None:
            import ahocorasick

            self.built = ahocorasick.Automaton()
            for word, rank in self.words.items():
                if word:
                    self.built.add_word(word, rank)
            self.built.make_automaton()
        if len(self.built):
            for _, rank in self.built.iter(text):
                if rank < best:
                    best = rank
                    if not best:
                        break
        return best

    def __getstate__(self):
        return {"names": self.names, "words": self.words, "built": None}


def first_of_many(
    value: Column | str, keywords: dict[str, list[str]], default: str = DEFAULT_CATEGORY
) -> Column:
    """:func:`first_category` for lists of thousands of words: one pass over a text for all.

    A keyword counts wherever it stands, as there; of a keyword in two categories the first
    counts. NULL is ``default``.
    """
    automaton = _Automaton(keywords)
    names = [*keywords, default]

    @F.pandas_udf("string")
    def category(texts: pd.Series) -> pd.Series:
        return pd.Series([names[-1] if t is None else names[automaton.first(t)] for t in texts])

    return category(F.lower(F.col(value) if isinstance(value, str) else value))


def categorize_content(value: Column | str) -> Column:
    return first_category(value, ARTICLE_KEYWORDS)


def categorize_image(value: Column | str) -> Column:
    return first_category(value, IMAGE_KEYWORDS)
