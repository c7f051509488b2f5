"""The jobs of this subpackage as queries, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from parlato.llm.bpe import op6_bpe_roundtrip
from parlato.llm.fingerprints import op4_fingerprints
from parlato.llm.hard_negatives import OP11_SQL, op11_hard_negatives
from parlato.llm.html_text import op10_html_text
from parlato.llm.langid import op9_language_id
from parlato.llm.mixing import op5_mix_sources
from parlato.llm.neardup import op7_near_duplicates
from parlato.llm.phrases import OP13_SQL, op13_phrase_collocations
from parlato.llm.repeats import OP3_SQL, op3_repeated_windows
from parlato.llm.secret_scan import op8_secret_scan
from parlato.llm.token_counts import op12_token_counts
from parlato.llm.topk import OP2_SQL, op2_exact_top_k
from parlato.llm.warc import OP1_SQL, op1_warc_revisits

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc_revisits": op1_warc_revisits,
    "op2_exact_top_k": op2_exact_top_k,
    "op3_repeated_windows": op3_repeated_windows,
    "op4_fingerprints": op4_fingerprints,
    "op5_mix_sources": op5_mix_sources,
    "op6_bpe_roundtrip": op6_bpe_roundtrip,
    "op7_near_duplicates": op7_near_duplicates,
    "op8_secret_scan": op8_secret_scan,
    "op9_language_id": op9_language_id,
    "op10_html_text": op10_html_text,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_token_counts": op12_token_counts,
    "op13_phrase_collocations": op13_phrase_collocations,
}

ORACLE: dict[str, str] = {
    "op1_warc_revisits": OP1_SQL,
    "op2_exact_top_k": OP2_SQL,
    "op3_repeated_windows": OP3_SQL,
    "op11_hard_negatives": OP11_SQL,
    "op13_phrase_collocations": OP13_SQL,
}
