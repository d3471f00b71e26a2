"""The registered queries of this subpackage, and their SQL where SQL expresses them."""

from __future__ import annotations

from curate.llm import (ann, chaining, conversation, decontaminate, exactdedup, fim, jaccard, langid, lmscore, mixing, suffixdedup,
                        toxicity, urlfilter)

_MODULES = (suffixdedup, jaccard, urlfilter, toxicity, exactdedup, lmscore, decontaminate, chaining, mixing, langid, conversation, fim, ann)
QUERIES = {name: fn for m in _MODULES for name, fn in m.QUERIES.items()}
ORACLE = {name: sql for m in _MODULES for name, sql in m.ORACLE.items()}
