"""The training-data operators' registered queries and their SQL."""

from __future__ import annotations

from sievework.llm.binary_search import OP8_SQL, op8
from sievework.llm.decontaminate import OP7_SQL, op7
from sievework.llm.licenses import OP9_SQL, op9
from sievework.llm.mixing import OP2_SQL, op2
from sievework.llm.phrases import OP12_SQL, op12
from sievework.llm.quality import op3
from sievework.llm.runs import op13
from sievework.llm.sharding import OP11_SQL, op11
from sievework.llm.simhash import op5
from sievework.llm.substring_dedup import OP1_SQL, op1
from sievework.llm.suffix_dedup import op10
from sievework.llm.token_store import op4
from sievework.llm.unigram import op6

QUERIES = {
    "op1_substring_dedup": op1,
    "op2_mix_sources": op2,
    "op3_quality_classifier": op3,
    "op4_token_store": op4,
    "op5_simhash_near_dedup": op5,
    "op6_token_counts": op6,
    "op7_decontaminate": op7,
    "op8_topk_binary_codes": op8,
    "op9_license_scan": op9,
    "op10_suffix_array_dedup": op10,
    "op11_rendezvous_shards": op11,
    "op12_phrase_collocations": op12,
    "op13_periodic_runs": op13,
}

ORACLES = {"op1_substring_dedup": OP1_SQL, "op2_mix_sources": OP2_SQL, "op7_decontaminate": OP7_SQL, "op8_topk_binary_codes": OP8_SQL, "op9_license_scan": OP9_SQL, "op11_rendezvous_shards": OP11_SQL, "op12_phrase_collocations": OP12_SQL}
