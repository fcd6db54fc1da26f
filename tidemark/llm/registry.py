"""Queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from functools import wraps

from .bpe import op6_bpe
from .common import share_code
from .exact_dedup import OP5_SQL, op5_exact_dedup
from .jaccard_join import op13_jaccard_join
from .language_model import op1_language_model
from .packing import op4_packing
from .quality_rules import OP7_SQL, op7_quality_rules
from .simhash import op8_simhash
from .token_counts import op10_token_counts
from .toxicity import op2_toxicity
from .vector_codes import OP11_SQL, op11_vector_codes
from .url_filters import OP9_SQL, op9_url_filters
from .warc import OP3_SQL, op3_warc
from .whitening import op12_whitening


def _query(f):
    @wraps(f)
    def run(spark, sf_dir):
        share_code(spark)
        return f(spark, sf_dir)

    return run


QUERIES = {
    f.__name__: _query(f)
    for f in (
        op1_language_model, op2_toxicity, op3_warc, op4_packing, op5_exact_dedup, op6_bpe, op7_quality_rules, op8_simhash, op9_url_filters,
        op10_token_counts, op11_vector_codes, op12_whitening, op13_jaccard_join,
    )
}
SQL = {"op3_warc": OP3_SQL, "op5_exact_dedup": OP5_SQL, "op7_quality_rules": OP7_SQL, "op9_url_filters": OP9_SQL, "op11_vector_codes": OP11_SQL}
