"""Registered queries of the corpus operators, and the SQL of those that SQL can express on whole tables."""

from __future__ import annotations

from lodgecurve.llm import urls, warc
from lodgecurve.llm.alignment import op12_alignment
from lodgecurve.llm.minhash import op11_minhash
from lodgecurve.llm.mixing import op2_mixing
from lodgecurve.llm.multi_index import op1_multi_index
from lodgecurve.llm.packing import op10_packing
from lodgecurve.llm.quality import op7_quality
from lodgecurve.llm.runs import op13_runs
from lodgecurve.llm.simhash import op4_simhash
from lodgecurve.llm.substring_dedup import op8_substring_dedup
from lodgecurve.llm.suffix_dedup import op6_suffix_dedup
from lodgecurve.llm.toxicity import op5_toxicity
from lodgecurve.llm.urls import op3_urls
from lodgecurve.llm.warc import op9_warc

QUERIES = {
    f.__name__: f
    for f in (
        op1_multi_index, op2_mixing, op3_urls, op4_simhash, op5_toxicity, op6_suffix_dedup, op7_quality, op8_substring_dedup, op9_warc,
        op10_packing, op11_minhash, op12_alignment, op13_runs,
    )
}
ORACLE: dict[str, str] = {"op3_urls": urls.ORACLE, "op9_warc": warc.ORACLE}
