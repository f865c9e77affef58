"""All corpus queries; importing this module registers them."""

from tallyhouse.llm import (  # noqa: F401
    byte_pairs, decontamination, fingerprints, lexical_search, line_dedup, line_quality, personal_data, secrets, sharding,
    shingle_join, spelling, substring_dedup, toxicity,
)
from tallyhouse.llm.common import QUERIES, SQL  # noqa: F401
