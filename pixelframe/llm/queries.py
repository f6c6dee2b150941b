"""The registered queries of the training-data operators, one for each."""

from __future__ import annotations

from .bpe import op7_bpe_encoding
from .decontamination import op1_decontamination
from .jaccard import op10_ngram_jaccard
from .language import op3_language_id
from .oracle import SQL
from .quality import op9_quality_rules
from .revisits import OP5_SQL, op5_warc_revisits
from .substring_dedup import op2_substring_dedup
from .suffix_dedup import op6_suffix_dedup
from .toxicity import op4_toxicity
from .wordpiece import op8_token_counts

QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_language_id": op3_language_id,
    "op4_toxicity": op4_toxicity,
    "op5_warc_revisits": op5_warc_revisits,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_bpe_encoding": op7_bpe_encoding,
    "op8_token_counts": op8_token_counts,
    "op9_quality_rules": op9_quality_rules,
    "op10_ngram_jaccard": op10_ngram_jaccard,
}

ORACLE_SQL: dict[str, str] = SQL | {"op5_warc_revisits": OP5_SQL}
