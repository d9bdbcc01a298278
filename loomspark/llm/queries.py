"""The queries of this subpackage, by the names that the entry module registers."""

from __future__ import annotations

from .bpe import op1_bpe
from .codes import OP12_SQL, op12_codes
from .hardneg import OP13_SQL, op13_hardneg
from .iblt import op7_fingerprints
from .induced_sorting import OP5_SQL, op5_byte_dedup
from .langid import op3_langid
from .mtree import OP9_SQL, op9_topk
from .packing import op4_packing
from .pieces import op11_pieces
from .secrets import op2_secrets
from .simhash import op6_simhash
from .suffix_trees import OP8_SQL, op8_substring_dedup
from .toxicity import op10_toxicity

QUERIES = {
    f.__name__: f
    for f in (op1_bpe, op2_secrets, op3_langid, op4_packing, op5_byte_dedup, op6_simhash, op7_fingerprints, op8_substring_dedup, op9_topk, op10_toxicity, op11_pieces, op12_codes, op13_hardneg)
}

ORACLES = {"op5_byte_dedup": OP5_SQL, "op8_substring_dedup": OP8_SQL, "op9_topk": OP9_SQL, "op12_codes": OP12_SQL, "op13_hardneg": OP13_SQL}
