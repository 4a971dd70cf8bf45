"""The queries of this subpackage, by name, and their SQL where SQL can express them."""

from __future__ import annotations

from .chat_format import OP8_SQL, op8_columnar_chat
from .embedding_dedup import OP10_SQL, op10_lattice_embeddings
from .exact_dedup import OP9_SQL, op9_exact_dedup
from .hard_negatives import OP12_SQL, op12_bit_sliced_negatives
from .html_extract import OP6_SQL, op6_page_differencing
from .minhash_dedup import OP5_SQL, op5_bottom_k_minhash
from .mixing import op4_raked_mixing
from .packing import op1_mixture_packing
from .periodic_runs import op13_periodic_runs
from .repeated_spans import op11_bucket_refinement
from .sharding import OP7_SQL, op7_jump_shards
from .toxicity import op3_ordinal_toxicity
from .url_filter import OP2_SQL, op2_url_rules

QUERIES = {
    "op1_mixture_packing": op1_mixture_packing,
    "op2_url_rules": op2_url_rules,
    "op3_ordinal_toxicity": op3_ordinal_toxicity,
    "op4_raked_mixing": op4_raked_mixing,
    "op5_bottom_k_minhash": op5_bottom_k_minhash,
    "op6_page_differencing": op6_page_differencing,
    "op7_jump_shards": op7_jump_shards,
    "op8_columnar_chat": op8_columnar_chat,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_lattice_embeddings": op10_lattice_embeddings,
    "op11_bucket_refinement": op11_bucket_refinement,
    "op12_bit_sliced_negatives": op12_bit_sliced_negatives,
    "op13_periodic_runs": op13_periodic_runs,
}
ORACLES = {"op2_url_rules": OP2_SQL, "op6_page_differencing": OP6_SQL, "op7_jump_shards": OP7_SQL, "op5_bottom_k_minhash": OP5_SQL, "op8_columnar_chat": OP8_SQL, "op9_exact_dedup": OP9_SQL, "op10_lattice_embeddings": OP10_SQL,
           "op12_bit_sliced_negatives": OP12_SQL}
