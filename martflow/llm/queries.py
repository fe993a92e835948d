"""The registered queries of this subpackage, and their SQL where SQL has them."""

from __future__ import annotations

from martflow.llm.byte_language import op8_byte_language
from martflow.llm.centroids import OP12_SQL, op12_centroid_clusters
from martflow.llm.license_scan import op5_license_scan
from martflow.llm.line_frequency import OP9_SQL, op9_line_frequency
from martflow.llm.mixing import OP10_SQL, op10_systematic_mix
from martflow.llm.near_texts import op6_probminhash
from martflow.llm.near_vectors import op2_sorted_projections
from martflow.llm.packing import op3_cost_balanced_packing
from martflow.llm.periodic_runs import op11_periodic_runs
from martflow.llm.piece_counts import op7_viterbi_counts
from martflow.llm.site_quality import op4_site_quality
from martflow.llm.token_shards import op1_token_shards
from martflow.llm.warc import OP13_SQL, op13_warc_members

QUERIES = {
    "op1_token_shards": op1_token_shards,
    "op2_sorted_projections": op2_sorted_projections,
    "op3_cost_balanced_packing": op3_cost_balanced_packing,
    "op4_site_quality": op4_site_quality,
    "op5_license_scan": op5_license_scan,
    "op6_probminhash": op6_probminhash,
    "op7_viterbi_counts": op7_viterbi_counts,
    "op8_byte_language": op8_byte_language,
    "op9_line_frequency": op9_line_frequency,
    "op10_systematic_mix": op10_systematic_mix,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_centroid_clusters": op12_centroid_clusters,
    "op13_warc_members": op13_warc_members,
}

ORACLE: dict[str, str] = {
    "op9_line_frequency": OP9_SQL,
    "op10_systematic_mix": OP10_SQL,
    "op12_centroid_clusters": OP12_SQL,
    "op13_warc_members": OP13_SQL,
}
