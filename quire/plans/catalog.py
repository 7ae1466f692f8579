"""Imports every query family so that the registry is complete."""

from quire.plans import (q_features, q_generate, q_lm, q_matrix, q_models, q_ngrams, q_sources,  # noqa: F401
                         q_tables, q_text, q_vectors)  # noqa: F401
from quire.plans.registry import ORACLES, QUERIES  # noqa: F401
