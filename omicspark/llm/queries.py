"""Queries of this subpackage: name -> callable(spark, sf_dir), and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from .backoff_lm import op8_backoff_lm
from .decontaminate import op7_decontaminate
from .line_templates import op5_line_templates
from .oracles import line_templates_sql, quality_sql, warc_sql
from .packing import op9_packing
from .periodic_runs import op11_periodic_runs
from .quality import op4_quality
from .repeats import op6_repeats
from .sentencepieces import op10_sentencepiece
from .simhash import op1_simhash
from .token_counts import op3_token_counts
from .toxicity import op2_toxicity
from .warc import op12_warc
from .whitening import op13_whitening

QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_toxicity": op2_toxicity,
    "op3_token_counts": op3_token_counts,
    "op4_quality": op4_quality,
    "op5_line_templates": op5_line_templates,
    "op6_repeats": op6_repeats,
    "op7_decontaminate": op7_decontaminate,
    "op8_backoff_lm": op8_backoff_lm,
    "op9_packing": op9_packing,
    "op10_sentencepiece": op10_sentencepiece,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_warc": op12_warc,
    "op13_whitening": op13_whitening,
}

ORACLE_SQL = {"op4_quality": quality_sql(), "op5_line_templates": line_templates_sql(), "op12_warc": warc_sql()}
