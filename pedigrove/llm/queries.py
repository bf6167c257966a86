"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from .chat_format import OP9_SQL, op9_chat_format
from .embedding_dedup import OP8_SQL, op8_embedding_dedup
from .hard_negatives import OP11_SQL, op11_hard_negatives
from .html_extract import op2_html_extract
from .media_columns import op7_media_columns
from .mixing import op6_mixing
from .ngram_jaccard import OP1_SQL, op1_ngram_jaccard
from .packing import op4_packing
from .quality import op3_quality
from .spelling import op13_spelling_variants
from .token_counts import op10_token_counts
from .topk_search import OP12_SQL, op12_topk_search
from .toxicity import op5_toxicity

QUERIES = {
    "op1_ngram_jaccard": op1_ngram_jaccard,
    "op2_html_extract": op2_html_extract,
    "op3_quality": op3_quality,
    "op4_packing": op4_packing,
    "op5_toxicity": op5_toxicity,
    "op6_mixing": op6_mixing,
    "op7_media_columns": op7_media_columns,
    "op8_embedding_dedup": op8_embedding_dedup,
    "op9_chat_format": op9_chat_format,
    "op10_token_counts": op10_token_counts,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_topk_search": op12_topk_search,
    "op13_spelling_variants": op13_spelling_variants,
}
SQL = {"op1_ngram_jaccard": OP1_SQL, "op8_embedding_dedup": OP8_SQL, "op9_chat_format": OP9_SQL, "op11_hard_negatives": OP11_SQL, "op12_topk_search": OP12_SQL}
