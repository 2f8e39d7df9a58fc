"""The registered queries of this subpackage and their DuckDB oracles."""

from __future__ import annotations

from fileflow.llm import decontaminate, langid, lexical, linededup, mixing, pseudonyms, rollup, simhash, sketch, tokenfile, toxicity, variants, warc

QUERIES = {
    "op1_langid": langid.op1_langid,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_mixing": mixing.op3_mixing,
    "op4_warc": warc.op4_warc,
    "op5_fingerprints": sketch.op5_fingerprints,
    "op6_decontaminate": decontaminate.op6_decontaminate,
    "op7_pseudonyms": pseudonyms.op7_pseudonyms,
    "op8_simhash": simhash.op8_simhash,
    "op9_line_dedup": linededup.op9_line_dedup,
    "op10_token_counts": rollup.op10_token_counts,
    "op11_lexical_search": lexical.op11_lexical_search,
    "op12_token_files": tokenfile.op12_token_files,
    "op13_spelling_variants": variants.op13_spelling_variants,
}

#: Where SQL can express the whole query; the others are tested against brute force.
ORACLE = {
    "op4_warc": warc.ORACLE,
    "op6_decontaminate": decontaminate.ORACLE,
    "op11_lexical_search": lexical.ORACLE,
}
