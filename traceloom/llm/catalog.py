"""All queries of this subpackage; importing a module registers its query."""

from traceloom.llm import decontaminate, fill_middle, language_id, maxent_lm, maxscore, ngram_join, pii, quality, secret_scan, sentencepiece_sample, toxicity, url_filter, variants  # noqa: F401
from traceloom.llm.registry import ORACLES, QUERIES  # noqa: F401
