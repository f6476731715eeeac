"""The queries of this package, and the DuckDB SQL of those that SQL can say."""

from __future__ import annotations

from tableflow.llm.conversations import op13_conversations
from tableflow.llm.decontamination import OP8_SQL, op8_decontamination
from tableflow.llm.jaccard import op4_jaccard
from tableflow.llm.language_id import op7_language_id
from tableflow.llm.licenses import op10_licenses
from tableflow.llm.line_dedup import OP2_SQL, op2_line_dedup
from tableflow.llm.minhash_forest import op11_minhash
from tableflow.llm.mixing import OP9_SQL, op9_mixing
from tableflow.llm.quality import op3_quality
from tableflow.llm.substring_dedup import op1_substring_dedup
from tableflow.llm.toxicity import op6_toxicity
from tableflow.llm.url_filter import OP5_SQL, op5_url_filter
from tableflow.llm.whitening import op12_whitening

QUERIES = {
    function.__name__: function
    for function in [
        op1_substring_dedup,
        op2_line_dedup,
        op3_quality,
        op4_jaccard,
        op5_url_filter,
        op6_toxicity,
        op7_language_id,
        op8_decontamination,
        op9_mixing,
        op10_licenses,
        op11_minhash,
        op12_whitening,
        op13_conversations,
    ]
}

ORACLES = {
    "op2_line_dedup": OP2_SQL,
    "op5_url_filter": OP5_SQL,
    "op8_decontamination": OP8_SQL,
    "op9_mixing": OP9_SQL,
}
