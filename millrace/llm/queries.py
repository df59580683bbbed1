"""The subpackage's queries, each over its whole table with production parameters, and the SQL of those that SQL can express."""

from __future__ import annotations

from .chat import OP8_SQL, op8_chat
from .content_sort import OP12_SQL, op12_exact
from .divergence import OP13_SQL, op13_divergence
from .html_extract import op4_extract
from .jaccard_join import op7_jaccard
from .line_crf import op6_rules
from .lm_score import op5_lm
from .merkle import OP11_SQL, op11_merkle
from .mixing import op10_mix
from .packing import op2_pack
from .quality_rff import op3_quality
from .suffix_dedup import op1_suffix
from .tiff_media import op9_tiff

QUERIES = {
    "op1_suffix": op1_suffix,
    "op2_pack": op2_pack,
    "op3_quality": op3_quality,
    "op4_extract": op4_extract,
    "op5_lm": op5_lm,
    "op6_rules": op6_rules,
    "op7_jaccard": op7_jaccard,
    "op8_chat": op8_chat,
    "op9_tiff": op9_tiff,
    "op10_mix": op10_mix,
    "op11_merkle": op11_merkle,
    "op12_exact": op12_exact,
    "op13_divergence": op13_divergence,
}
ORACLE_SQL = {"op8_chat": OP8_SQL, "op11_merkle": OP11_SQL, "op12_exact": OP12_SQL, "op13_divergence": OP13_SQL}
