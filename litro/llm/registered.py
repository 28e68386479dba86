"""The operators' queries over the test tables, and SQL where it can express them."""

from litro.llm import (
    chat_format,
    credentials,
    decontamination,
    filter_audit,
    html_text,
    minhash_dedup,
    packing,
    personal_data,
    quality,
    substring_dedup,
    suffix_dedup,
    toxicity,
    whitening,
)

QUERIES = {
    "op1_suffix_dedup": suffix_dedup.query,
    "op2_personal_data": personal_data.query,
    "op3_decontamination": decontamination.query,
    "op4_substring_dedup": substring_dedup.query,
    "op5_minhash_dedup": minhash_dedup.query,
    "op6_html_text": html_text.query,
    "op7_quality": quality.query,
    "op8_packing": packing.query,
    "op9_toxicity": toxicity.query,
    "op10_chat_format": chat_format.query,
    "op11_whitening": whitening.query,
    "op12_secrets": credentials.query,
    "op13_filter_audit": filter_audit.query,
}

ORACLES: dict[str, str] = {
    "op3_decontamination": decontamination.ORACLE,
    "op10_chat_format": chat_format.ORACLE,
    "op13_filter_audit": filter_audit.ORACLE,
}
