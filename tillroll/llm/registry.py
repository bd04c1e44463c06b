"""The registered queries of this subpackage and their SQL."""

import corpus_pipeline
from tillroll.llm.conversations import OP12_SQL, op12_conversations
from tillroll.llm.decontaminate import OP8_SQL, op8_decontaminate
from tillroll.llm.license_rules import op4_license_rules
from tillroll.llm.packing import op7_packing
from tillroll.llm.pieces import op13_sentencepiece
from tillroll.llm.pii import op3_pii
from tillroll.llm.quality_rules import op10_quality_rules
from tillroll.llm.secrets import op6_secrets
from tillroll.llm.simhash import op1_simhash
from tillroll.llm.suffix_dedup import op2_suffix_dedup
from tillroll.llm.token_counts import op9_token_counts
from tillroll.llm.warc import OP5_SQL, op5_warc
from tillroll.llm.whitening import op11_whitening

QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_pii": op3_pii,
    "op4_license_rules": op4_license_rules,
    "op5_warc": op5_warc,
    "op6_secrets": op6_secrets,
    "op7_packing": op7_packing,
    "op8_decontaminate": op8_decontaminate,
    "op9_token_counts": op9_token_counts,
    "op10_quality_rules": op10_quality_rules,
    "op11_whitening": op11_whitening,
    "op12_conversations": op12_conversations,
    "op13_sentencepiece": op13_sentencepiece,
    "pipeline": corpus_pipeline.run,
}

ORACLES: dict[str, str] = {
    "op5_warc": OP5_SQL,
    "op8_decontaminate": OP8_SQL,
    "op12_conversations": OP12_SQL,
}
