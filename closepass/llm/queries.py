"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from closepass.llm import chat, decontamination, merkle, vector_codes
from closepass.llm.chat import op6_relational_chat
from closepass.llm.decontamination import op5_prefix_decontamination
from closepass.llm.languages import op3_mixture_language
from closepass.llm.merkle import op12_slot_pivot_merkle
from closepass.llm.near_duplicates import op8_order_minhash
from closepass.llm.neighbours import op1_inverted_multi_index
from closepass.llm.packing import op4_best_two_fit
from closepass.llm.page_text import op13_minimum_cut_text
from closepass.llm.repeated_spans import op9_suffix_dedup
from closepass.llm.secrets import op2_structural_secrets
from closepass.llm.token_files import op7_patched_frame_token_files
from closepass.llm.toxicity import op10_convolutional_toxicity
from closepass.llm.vector_codes import op11_drake_hamerly_codes

QUERIES = {
    query.__name__: query
    for query in (
        op1_inverted_multi_index,
        op2_structural_secrets,
        op3_mixture_language,
        op4_best_two_fit,
        op5_prefix_decontamination,
        op6_relational_chat,
        op7_patched_frame_token_files,
        op8_order_minhash,
        op9_suffix_dedup,
        op10_convolutional_toxicity,
        op11_drake_hamerly_codes,
        op12_slot_pivot_merkle,
        op13_minimum_cut_text,
    )
}
ORACLE = {
    "op5_prefix_decontamination": decontamination.ORACLE,
    "op6_relational_chat": chat.ORACLE,
    "op11_drake_hamerly_codes": vector_codes.oracle(),
    "op12_slot_pivot_merkle": merkle.oracle(),
}
