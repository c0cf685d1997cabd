"""The queries of this folder's operators and their SQL twins."""

from __future__ import annotations

from linktally.llm.bottomk import OP11_SQL, op11_bottomk
from linktally.llm.bpe import op9_bpe
from linktally.llm.centroids import OP12_SQL, op12_centroids
from linktally.llm.exact_dedup import OP1_SQL, op1_exact_dedup
from linktally.llm.jaccard import OP4_SQL, op4_jaccard
from linktally.llm.merkle import OP10_SQL, op10_merkle_audit
from linktally.llm.mixing import op2_mixing
from linktally.llm.pairmax import OP13_SQL, op13_pairmax
from linktally.llm.ppm import op3_ppm
from linktally.llm.quality import op6_quality
from linktally.llm.quotes import op5_quotes
from linktally.llm.topk import OP7_SQL, op7_topk
from linktally.llm.toxicity import op8_toxicity

QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_mixing": op2_mixing,
    "op3_ppm": op3_ppm,
    "op4_jaccard": op4_jaccard,
    "op5_quotes": op5_quotes,
    "op6_quality": op6_quality,
    "op7_topk": op7_topk,
    "op8_toxicity": op8_toxicity,
    "op9_bpe": op9_bpe,
    "op10_merkle_audit": op10_merkle_audit,
    "op11_bottomk": op11_bottomk,
    "op12_centroids": op12_centroids,
    "op13_pairmax": op13_pairmax,
}

ORACLE_SQL = {
    "op1_exact_dedup": OP1_SQL,
    "op4_jaccard": OP4_SQL,
    "op7_topk": OP7_SQL,
    "op10_merkle_audit": OP10_SQL,
    "op11_bottomk": OP11_SQL,
    "op12_centroids": OP12_SQL,
    "op13_pairmax": OP13_SQL,
}
