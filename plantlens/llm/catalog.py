"""The operators' queries and their reference SQL, by name."""

from __future__ import annotations

from .byte_bpe import op7_byte_bpe
from .decontamination import OP8_ORACLE, op8_decontamination
from .filter_audit import OP13_ORACLE, op13_filter_audit
from .jaccard_join import OP9_LINKS_ORACLE, OP9_ORACLE, op9_jaccard_join, op9_jaccard_links
from .kneser_ney import op5_kneser_ney
from .line_templates import op4_line_templates
from .packing import op12_best_fit_packing
from .quality import op3_quality
from .reply_trees import OP10_ORACLE, op10_reply_trees
from .secret_scan import op6_secret_scan
from .toxicity import op1_toxicity
from .whitening import op11_whitening
from .winnowing import op2_winnowing

QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_winnowing": op2_winnowing,
    "op3_quality": op3_quality,
    "op4_line_templates": op4_line_templates,
    "op5_kneser_ney": op5_kneser_ney,
    "op6_secret_scan": op6_secret_scan,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_decontamination": op8_decontamination,
    "op9_jaccard_join": op9_jaccard_join,
    "op9_jaccard_links": op9_jaccard_links,
    "op10_reply_trees": op10_reply_trees,
    "op11_whitening": op11_whitening,
    "op12_best_fit_packing": op12_best_fit_packing,
    "op13_filter_audit": op13_filter_audit,
}

ORACLES: dict[str, str] = {
    "op8_decontamination": OP8_ORACLE,
    "op9_jaccard_join": OP9_ORACLE,
    "op9_jaccard_links": OP9_LINKS_ORACLE,
    "op10_reply_trees": OP10_ORACLE,
    "op13_filter_audit": OP13_ORACLE,
}
