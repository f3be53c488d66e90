"""The corpus queries and their SQL, as __spark_entry__ registers them."""

from __future__ import annotations

from .decontaminate import op9_string_tiling
from .fim import OP13_SQL, op13_displacement_scatter
from .langid import op6_language_fusion
from .licences import op12_rare_token_index
from .lines import OP2_SQL, op2_site_spread
from .minhash import op10_near_duplicates
from .packing import op3_best_two_fit
from .quality import op4_empirical_bayes
from .rules import op1_distribution_divergence
from .store import op7_token_store
from .suffixes import op8_suffix_array
from .vectors import OP11_SQL, op11_hilbert_blocks
from .warc import op5_warc_derivatives

QUERIES = {
    f.__name__: f
    for f in (
        op1_distribution_divergence,
        op2_site_spread,
        op3_best_two_fit,
        op4_empirical_bayes,
        op5_warc_derivatives,
        op6_language_fusion,
        op7_token_store,
        op8_suffix_array,
        op9_string_tiling,
        op10_near_duplicates,
        op11_hilbert_blocks,
        op12_rare_token_index,
        op13_displacement_scatter,
    )
}

ORACLES = {"op2_site_spread": OP2_SQL, "op11_hilbert_blocks": OP11_SQL, "op13_displacement_scatter": OP13_SQL}
