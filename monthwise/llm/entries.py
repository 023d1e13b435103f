"""The registered queries of this folder and their DuckDB statements."""

from __future__ import annotations

from monthwise.llm import oracles
from monthwise.llm.bpe import op3_bpe
from monthwise.llm.collocations import op13_collocations
from monthwise.llm.decontaminate import op4_decontaminate
from monthwise.llm.langid import op1_langid
from monthwise.llm.licenses import op10_licenses
from monthwise.llm.line_dedup import op7_line_dedup
from monthwise.llm.mixing import op12_mixing
from monthwise.llm.secrets_scan import op9_secrets
from monthwise.llm.simhash import op5_simhash
from monthwise.llm.spelling import op11_spelling
from monthwise.llm.token_files import op2_token_files
from monthwise.llm.topk import op8_topk
from monthwise.llm.toxicity import op6_toxicity

QUERIES = {
    "op1_langid": op1_langid,
    "op2_token_files": op2_token_files,
    "op3_bpe": op3_bpe,
    "op4_decontaminate": op4_decontaminate,
    "op5_simhash": op5_simhash,
    "op6_toxicity": op6_toxicity,
    "op7_line_dedup": op7_line_dedup,
    "op8_topk": op8_topk,
    "op9_secrets": op9_secrets,
    "op10_licenses": op10_licenses,
    "op11_spelling": op11_spelling,
    "op12_mixing": op12_mixing,
    "op13_collocations": op13_collocations,
}

#: Where DuckDB can express the operator; the others (trained models, XXH64
#: fingerprints, tokenizers) are held against brute-force versions, the
#: libraries and held-out rows in tests/llm.
ORACLE: dict[str, str] = {
    "op4_decontaminate": oracles.DECONTAMINATE,
    "op7_line_dedup": oracles.LINE_DEDUP,
    "op8_topk": oracles.TOP_K,
    "op9_secrets": oracles.SECRETS,
    "op10_licenses": oracles.LICENSES,
    "op13_collocations": oracles.COLLOCATIONS,
}
