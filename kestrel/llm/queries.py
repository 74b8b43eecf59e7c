"""The registered corpus queries and their DuckDB SQL."""

from __future__ import annotations

from kestrel.llm.caps import OP4_SQL, op4_embedding_near_dedup
from kestrel.llm.fingerprint import op3_order_minhash
from kestrel.llm.kmeans import OP13_SQL, op13_centroid_clusters
from kestrel.llm.lines import OP5_SQL, op5_line_dedup
from kestrel.llm.minhash import OP2_SQL, op2_minhash_near_dedup
from kestrel.llm.mixing import OP6_SQL, op6_mix_sources
from kestrel.llm.packing import op10_sequence_packing
from kestrel.llm.phrases import OP12_SQL, op12_collocations
from kestrel.llm.pii import op9_personal_data
from kestrel.llm.quality import op1_quality_classifier
from kestrel.llm.secrets import op11_secret_scan
from kestrel.llm.tokens import op7_token_counts
from kestrel.llm.windows import OP8_SQL, op8_substring_dedup

REGISTRY = {f.__name__: f for f in (
    op1_quality_classifier, op2_minhash_near_dedup, op3_order_minhash, op4_embedding_near_dedup, op5_line_dedup,
    op6_mix_sources, op7_token_counts, op8_substring_dedup, op9_personal_data, op10_sequence_packing,
    op11_secret_scan, op12_collocations, op13_centroid_clusters,
)}

ORACLES: dict[str, str] = {
    "op2_minhash_near_dedup": OP2_SQL, "op4_embedding_near_dedup": OP4_SQL, "op5_line_dedup": OP5_SQL,
    "op6_mix_sources": OP6_SQL, "op8_substring_dedup": OP8_SQL,
    "op12_collocations": OP12_SQL, "op13_centroid_clusters": OP13_SQL,
}
