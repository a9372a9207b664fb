"""All queries of this subpackage. Importing the modules fills the registry."""

from hazeline.llm import (  # noqa: F401
    alignment, bpe, decontaminate, mixing, neighbours, ngram_join, passages, pii, prefixes, quality, secrets, sharding, toxicity,
)
from hazeline.llm.base import ORACLES, QUERIES  # noqa: F401
