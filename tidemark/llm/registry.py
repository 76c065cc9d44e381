"""The queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from .ann import op6_ann
from .chat import op8_chat_formatting
from .exact_search import OP10_SQL, op10_exact_search
from .hard_negatives import OP12_SQL, op12_hard_negatives
from .line_dedup import OP9_SQL, op9_line_dedup
from .mixing import op7_mixing
from .near_dedup import OP3_SQL, op3_near_dedup
from .packing import op4_packing
from .pii import op5_pii
from .quality import op2_quality_classifier
from .repair import OP11_SQL, op11_conversation_repair
from .token_counts import op1_token_counts
from .toxicity import op13_toxicity

QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_near_dedup": op3_near_dedup,
    "op4_packing": op4_packing,
    "op5_pii": op5_pii,
    "op6_ann": op6_ann,
    "op7_mixing": op7_mixing,
    "op8_chat_formatting": op8_chat_formatting,
    "op9_line_dedup": op9_line_dedup,
    "op10_exact_search": op10_exact_search,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_toxicity": op13_toxicity,
}
SQL = {"op3_near_dedup": OP3_SQL, "op9_line_dedup": OP9_SQL, "op10_exact_search": OP10_SQL, "op11_conversation_repair": OP11_SQL, "op12_hard_negatives": OP12_SQL}
