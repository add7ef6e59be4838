"""The registered queries of this package and their SQL checks."""
from .alignment import op13_alignment
from .bpe import op1_bpe
from .jaccard import op10_jaccard_join
from .language import op9_language_id
from .lines import OP4_SQL, op4_line_dedup
from .mixing import op6_mixing
from .neighbours import op8_ann
from .passages import op12_suffix_dedup
from .personal import op7_pii
from .resampling import op11_resampling
from .suffixtree import op3_lm_scoring
from .topk import OP5_SQL, op5_exact_topk
from .warc import OP2_SQL, op2_warc

QUERIES = {f.__name__: f for f in (op1_bpe, op2_warc, op3_lm_scoring, op4_line_dedup, op5_exact_topk, op6_mixing, op7_pii, op8_ann, op9_language_id, op10_jaccard_join,
                                op11_resampling, op12_suffix_dedup, op13_alignment)}
ORACLES = {"op2_warc": OP2_SQL, "op4_line_dedup": OP4_SQL, "op5_exact_topk": OP5_SQL}
