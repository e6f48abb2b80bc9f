"""The queries of this subpackage and their SQL, where SQL can express them."""

from __future__ import annotations

from quarry.llm.codes import OP11_SQL, op11_codes
from quarry.llm.covertree import OP6_SQL, op6_covertree
from quarry.llm.decontaminate import OP10_SQL, op10_decontaminate
from quarry.llm.packing import op3_packing
from quarry.llm.pii import op2_pii
from quarry.llm.quality import op1_quality
from quarry.llm.simhash import op9_simhash
from quarry.llm.substring import OP5_SQL, op5_substring
from quarry.llm.suffixes import op8_suffixes
from quarry.llm.topk import OP12_SQL, op12_topk
from quarry.llm.toxicity import op7_toxicity
from quarry.llm.wand import OP13_SQL, op13_wand
from quarry.llm.warc import OP4_SQL, op4_warc

QUERIES = {
    "op1_quality": op1_quality,
    "op2_pii": op2_pii,
    "op3_packing": op3_packing,
    "op4_warc": op4_warc,
    "op5_substring": op5_substring,
    "op6_covertree": op6_covertree,
    "op7_toxicity": op7_toxicity,
    "op8_suffixes": op8_suffixes,
    "op9_simhash": op9_simhash,
    "op10_decontaminate": op10_decontaminate,
    "op11_codes": op11_codes,
    "op12_topk": op12_topk,
    "op13_wand": op13_wand,
}
ORACLES = {"op4_warc": OP4_SQL, "op5_substring": OP5_SQL, "op6_covertree": OP6_SQL, "op10_decontaminate": OP10_SQL, "op11_codes": OP11_SQL, "op12_topk": OP12_SQL, "op13_wand": OP13_SQL}
