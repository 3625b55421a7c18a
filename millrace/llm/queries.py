"""The queries of this package: name to (query, SQL for DuckDB or None)."""

from __future__ import annotations

from . import queries_chat as chat
from . import queries_decontaminate as decontaminate
from . import queries_divergence as divergence
from . import queries_languages as languages
from . import queries_licenses as licenses
from . import queries_pieces as pieces
from . import queries_pitman_yor as pitman_yor
from . import queries_prefix_trie as prefix_trie
from . import queries_quality as quality
from . import queries_simhash as simhash
from . import queries_token_files as token_files
from . import queries_toxicity as toxicity
from . import queries_urls as urls

QUERIES = {
    "op1_sentencepiece_nbest": (pieces.op1_sentencepiece_nbest, None),
    "op2_pitman_yor_score": (pitman_yor.op2_pitman_yor_score, None),
    "op3_benchmark_decontamination": (decontaminate.op3_benchmark_decontamination, None),
    "op4_simhash_near_dedup": (simhash.op4_simhash_near_dedup, None),
    "op5_chat_format": (chat.op5_chat_format, None),
    "op6_quality_rules": (quality.op6_quality_rules, quality.OP6_SQL),
    "op7_toxicity": (toxicity.op7_toxicity, None),
    "op8_url_filter": (urls.op8_url_filter, None),
    "op9_license_scan": (licenses.op9_license_scan, None),
    "op10_token_files": (token_files.op10_token_files, None),
    "op11_source_divergence": (divergence.op11_source_divergence, divergence.OP11_SQL),
    "op12_prefix_trie": (prefix_trie.op12_prefix_trie, prefix_trie.OP12_SQL),
    "op13_language_id": (languages.op13_language_id, None),
}
