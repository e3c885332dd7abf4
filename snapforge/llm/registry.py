"""All queries of the package and their SQL."""

from __future__ import annotations

from snapforge.llm import (alignment, bpe_codec, decontamination, language_id, merkle, near_duplicates, permutation_index, secret_scan,
                           sharding, suffix_dedup, token_counts, url_filter, warc)

MODULES = (decontamination, sharding, language_id, permutation_index, token_counts, bpe_codec, warc, secret_scan,
           near_duplicates, url_filter, suffix_dedup, merkle, alignment)
QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
SQL = {name: sql for module in MODULES for name, sql in module.SQL.items()}
