"""The registered corpus queries and the SQL that some of them equal."""

from __future__ import annotations

from matchwright.llm.conversation_repair import OP11_SQL, op11_conversation_repair
from matchwright.llm.exact_dedup import OP5_SQL, op5_exact_dedup
from matchwright.llm.line_dedup import OP4_SQL, op4_line_dedup
from matchwright.llm.nbest import op8_nbest_segmentation
from matchwright.llm.ngram_join import OP9_SQL, op9_ngram_join
from matchwright.llm.packing import op3_mixture_packing
from matchwright.llm.pii import op13_personal_data
from matchwright.llm.quality_rules import OP10_SQL, op10_quality_rules
from matchwright.llm.ranked_search import OP12_SQL, op12_ranked_search
from matchwright.llm.sharding import op2_two_pass_shuffle
from matchwright.llm.suffix_dedup import OP7_SQL, op7_suffix_dedup
from matchwright.llm.suffix_tree_lm import op6_suffix_tree_lm
from matchwright.llm.toxicity import op1_toxicity

QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_two_pass_shuffle": op2_two_pass_shuffle,
    "op3_mixture_packing": op3_mixture_packing,
    "op4_line_dedup": op4_line_dedup,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_suffix_tree_lm": op6_suffix_tree_lm,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_nbest_segmentation": op8_nbest_segmentation,
    "op9_ngram_join": op9_ngram_join,
    "op10_quality_rules": op10_quality_rules,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_ranked_search": op12_ranked_search,
    "op13_personal_data": op13_personal_data,
}

ORACLE_SQL = {
    "op4_line_dedup": OP4_SQL,
    "op5_exact_dedup": OP5_SQL,
    "op7_suffix_dedup": OP7_SQL,
    "op9_ngram_join": OP9_SQL,
    "op10_quality_rules": OP10_SQL,
    "op11_conversation_repair": OP11_SQL,
    "op12_ranked_search": OP12_SQL,
}
