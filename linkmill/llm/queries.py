"""The queries of the training-data operators and, where SQL can tell their result, the SQL."""

from linkmill.llm.bpe import op3_byte_bpe
from linkmill.llm.chat import OP4_SQL, op4_chat_windows
from linkmill.llm.langid import op1_language_id
from linkmill.llm.lines import OP9_SQL, op9_line_dedup
from linkmill.llm.mixing import OP5_SQL, op5_mix_sources
from linkmill.llm.near_vectors import OP6_SQL, op6_near_vectors
from linkmill.llm.ngram_join import OP8_SQL, op8_ngram_join
from linkmill.llm.quality import OP10_SQL, op10_quality_rules
from linkmill.llm.simple8b import op7_token_files
from linkmill.llm.warc import OP2_SQL, op2_warc


def queries() -> dict:
    return {f.__name__: f for f in (op1_language_id, op2_warc, op3_byte_bpe, op4_chat_windows, op5_mix_sources, op6_near_vectors, op7_token_files, op8_ngram_join, op9_line_dedup, op10_quality_rules)}


def oracle_sql() -> dict[str, str]:
    return {"op2_warc": OP2_SQL, "op4_chat_windows": OP4_SQL, "op6_near_vectors": OP6_SQL, "op8_ngram_join": OP8_SQL, "op5_mix_sources": OP5_SQL, "op9_line_dedup": OP9_SQL, "op10_quality_rules": OP10_SQL}
