"""Queries of this subpackage and their DuckDB twins."""

from ledgerlake.llm.decontaminate import op8_decontaminate
from ledgerlake.llm.html_extract import op12_html_extract
from ledgerlake.llm.lattice_lm import op5_lattice_lm
from ledgerlake.llm.licenses import op1_licenses
from ledgerlake.llm.mixing import op4_mixing
from ledgerlake.llm.near_join import op9_near_join
from ledgerlake.llm.oracle import ORACLE
from ledgerlake.llm.prefix_forest import op2_prefix_forest
from ledgerlake.llm.prefix_trie import op11_prefix_trie
from ledgerlake.llm.secrets import op10_secrets
from ledgerlake.llm.spelling_variants import op13_spelling_variants
from ledgerlake.llm.token_counts import op6_token_counts
from ledgerlake.llm.toxicity import op3_toxicity
from ledgerlake.llm.warc import op7_warc

LLM_QUERIES = {
    f.__name__: f
    for f in (
        op1_licenses,
        op2_prefix_forest,
        op3_toxicity,
        op4_mixing,
        op5_lattice_lm,
        op6_token_counts,
        op7_warc,
        op8_decontaminate,
        op9_near_join,
        op10_secrets,
        op11_prefix_trie,
        op12_html_extract,
        op13_spelling_variants,
    )
}
LLM_ORACLE: dict[str, str] = dict(ORACLE)
