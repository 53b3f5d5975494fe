"""Registry of the package's queries and of their SQL."""

from __future__ import annotations

from parcelflow.llm import chosen_path, collocations, licenses, mixing, negatives, warc
from parcelflow.llm.bestfit import op7_best_fit
from parcelflow.llm.chaining import op3_chained_passages
from parcelflow.llm.chosen_path import op9_chosen_path
from parcelflow.llm.collocations import op13_setm_phrases
from parcelflow.llm.decontaminate import op6_simhash_windows
from parcelflow.llm.licenses import op4_license_scan
from parcelflow.llm.mixing import op11_pareto_mix
from parcelflow.llm.negatives import op12_slot_negatives
from parcelflow.llm.quality import op8_fertility
from parcelflow.llm.shards import op10_feistel_shards
from parcelflow.llm.suffixes import op2_suffix_array
from parcelflow.llm.toxicity import op1_kneser_ney
from parcelflow.llm.warc import op5_warc

_ALL = (
    op1_kneser_ney,
    op2_suffix_array,
    op3_chained_passages,
    op4_license_scan,
    op5_warc,
    op6_simhash_windows,
    op7_best_fit,
    op8_fertility,
    op9_chosen_path,
    op10_feistel_shards,
    op11_pareto_mix,
    op12_slot_negatives,
    op13_setm_phrases,
)
QUERIES = {f.__name__: f for f in _ALL}
SQL: dict[str, str] = {
    "op4_license_scan": licenses.SQL,
    "op5_warc": warc.SQL,
    "op9_chosen_path": chosen_path.SQL,
    "op11_pareto_mix": mixing.SQL,
    "op12_slot_negatives": negatives.SQL,
    "op13_setm_phrases": collocations.SQL,
}
