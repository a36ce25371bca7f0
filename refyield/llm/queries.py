"""Registered queries of the corpus operators and their DuckDB statements."""

from __future__ import annotations

from refyield.llm.bpe import op6_byte_bpe
from refyield.llm.chat import OP4_SQL, op4_chat_branches
from refyield.llm.clustering import OP13_SQL, op13_vantage_clusters
from refyield.llm.counting import op7_token_counts
from refyield.llm.decontamination import OP12_SQL, op12_decontamination
from refyield.llm.fingerprints import op8_minhash_fingerprints
from refyield.llm.idstore import op3_token_id_files
from refyield.llm.jaccard import op10_jaccard_join
from refyield.llm.mixing import OP5_SQL, op5_mix_sources
from refyield.llm.resampling import OP11_SQL, op11_resample
from refyield.llm.sharding import OP2_SQL, op2_rendezvous_shards
from refyield.llm.toxicity import op9_toxicity
from refyield.llm.vectors import op1_near_vectors

QUERIES = {
    "op1_near_vectors": op1_near_vectors,
    "op2_rendezvous_shards": op2_rendezvous_shards,
    "op3_token_id_files": op3_token_id_files,
    "op4_chat_branches": op4_chat_branches,
    "op5_mix_sources": op5_mix_sources,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_token_counts": op7_token_counts,
    "op8_minhash_fingerprints": op8_minhash_fingerprints,
    "op9_toxicity": op9_toxicity,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_resample": op11_resample,
    "op12_decontamination": op12_decontamination,
    "op13_vantage_clusters": op13_vantage_clusters,
}

#: Operators 1, 3 and 6 to 10 have no statement: SQL has no such hashes,
#: tokenizers or networks. Their tests hold them against brute force.
ORACLE_SQL = {
    "op2_rendezvous_shards": OP2_SQL,
    "op4_chat_branches": OP4_SQL,
    "op5_mix_sources": OP5_SQL,
    "op11_resample": OP11_SQL,
    "op12_decontamination": OP12_SQL,
    "op13_vantage_clusters": OP13_SQL,
}
