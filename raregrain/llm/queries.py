"""All queries of the subpackage: importing the operators registers them."""

import corpus_pipeline

from . import (bpe, chat, dartminhash, decontaminate, exact, importance, langid, licenses, packing, simhash,  # noqa: F401
               spelling, substrings, tokenfiles)
from .common import ORACLES, QUERIES

QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
