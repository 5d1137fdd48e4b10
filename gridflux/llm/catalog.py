"""Queries of the training-data operators and the oracles that SQL can express."""

from gridflux.llm.decontam import op1_decontam
from gridflux.llm.jaccard import op8_jaccard
from gridflux.llm.langid import op5_langid
from gridflux.llm.media import op6_media
from gridflux.llm.negatives import op13_hard_negatives
from gridflux.llm.packing import op3_packing
from gridflux.llm.quality import op4_quality
from gridflux.llm.suffix_lm import op7_suffix_lm
from gridflux.llm.token_count import op2_token_count
from gridflux.llm.toxicity import op12_toxicity
from gridflux.llm.url_filter import OP9_SQL, op9_url_filter
from gridflux.llm.warc import OP10_SQL, op10_warc
from gridflux.llm.whitening import op11_whitening

QUERIES = {
    "op1_decontam": op1_decontam,
    "op2_token_count": op2_token_count,
    "op3_packing": op3_packing,
    "op4_quality": op4_quality,
    "op5_langid": op5_langid,
    "op6_media": op6_media,
    "op7_suffix_lm": op7_suffix_lm,
    "op8_jaccard": op8_jaccard,
    "op9_url_filter": op9_url_filter,
    "op10_warc": op10_warc,
    "op11_whitening": op11_whitening,
    "op12_toxicity": op12_toxicity,
    "op13_hard_negatives": op13_hard_negatives,
}
ORACLE_SQL = {"op9_url_filter": OP9_SQL, "op10_warc": OP10_SQL}
