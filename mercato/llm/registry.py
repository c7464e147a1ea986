"""The registered queries of this folder and their DuckDB texts."""

from __future__ import annotations

from mercato.llm.common import workers_import_package
from mercato.llm.op1_license_scan import op1_license_scan
from mercato.llm.op2_source_mixing import ORACLE as ORACLE_2
from mercato.llm.op2_source_mixing import op2_source_mixing
from mercato.llm.op3_nearest_neighbours import op3_nearest_neighbours
from mercato.llm.op4_lm_scoring import op4_lm_scoring
from mercato.llm.op5_ngram_join import ORACLE as ORACLE_5
from mercato.llm.op5_ngram_join import op5_ngram_join
from mercato.llm.op6_bpe import op6_bpe
from mercato.llm.op7_sharding import ORACLE as ORACLE_7
from mercato.llm.op7_sharding import op7_sharding
from mercato.llm.op8_fingerprints import ORACLE as ORACLE_8
from mercato.llm.op8_fingerprints import op8_fingerprints
from mercato.llm.op9_warc import ORACLE as ORACLE_9
from mercato.llm.op9_warc import op9_warc
from mercato.llm.op10_language_id import op10_language_id
from mercato.llm.op11_ranked_search import ORACLE as ORACLE_11
from mercato.llm.op11_ranked_search import op11_ranked_search
from mercato.llm.op12_embedding_dedup import ORACLE as ORACLE_12
from mercato.llm.op12_embedding_dedup import op12_embedding_dedup
from mercato.llm.op13_conversation_trie import ORACLE as ORACLE_13
from mercato.llm.op13_conversation_trie import op13_conversation_trie

_QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_source_mixing": op2_source_mixing,
    "op3_nearest_neighbours": op3_nearest_neighbours,
    "op4_lm_scoring": op4_lm_scoring,
    "op5_ngram_join": op5_ngram_join,
    "op6_bpe": op6_bpe,
    "op7_sharding": op7_sharding,
    "op8_fingerprints": op8_fingerprints,
    "op9_warc": op9_warc,
    "op10_language_id": op10_language_id,
    "op11_ranked_search": op11_ranked_search,
    "op12_embedding_dedup": op12_embedding_dedup,
    "op13_conversation_trie": op13_conversation_trie,
}


def _with_package(query):
    def run(spark, sf_dir):
        workers_import_package(spark)
        return query(spark, sf_dir)

    return run


QUERIES = {name: _with_package(query) for name, query in _QUERIES.items()}

ORACLE_SQL = {
    "op2_source_mixing": ORACLE_2,
    "op5_ngram_join": ORACLE_5,
    "op7_sharding": ORACLE_7,
    "op8_fingerprints": ORACLE_8,
    "op9_warc": ORACLE_9,
    "op11_ranked_search": ORACLE_11,
    "op12_embedding_dedup": ORACLE_12,
    "op13_conversation_trie": ORACLE_13,
}
