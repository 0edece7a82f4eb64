"""Queries of this subpackage: name -> (spark, sf_dir) -> DataFrame, and their DuckDB SQL."""

from __future__ import annotations

from .webpages import op2_html_extraction
from . import copies, jaccard, mixing, phrases
from .copies import op13_exact_dedup
from .variants import op12_spelling_variants
from .jaccard import op6_ngram_jaccard_join
from .language_model import op3_lm_scoring
from .mixing import op8_mixing
from .neighbours import op4_nearest_neighbours
from .phrases import op11_phrase_mining
from .personal import op5_personal_data
from .pieces import op1_sentencepiece
from .quality import op9_quality_rules
from .repeats import op7_substring_dedup
from .sharding import op10_sharding

QUERIES = {f.__name__: f for f in (op1_sentencepiece, op2_html_extraction, op3_lm_scoring, op4_nearest_neighbours, op5_personal_data, op6_ngram_jaccard_join, op7_substring_dedup, op8_mixing, op9_quality_rules, op10_sharding,
                                    op11_phrase_mining, op12_spelling_variants, op13_exact_dedup)}
#: Only what SQL can express over whole tables; all other queries are tested against brute force.
ORACLE_SQL: dict[str, str] = {"op6_ngram_jaccard_join": jaccard.ORACLE_SQL, "op8_mixing": mixing.ORACLE_SQL,
                              "op11_phrase_mining": phrases.ORACLE_SQL, "op13_exact_dedup": copies.ORACLE_SQL}
