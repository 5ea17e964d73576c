"""The queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from veilwork.llm.bpe_codec import op4_bpe_encoding
from veilwork.llm.chat_format import OP2_SQL, op2_chat_formatting
from veilwork.llm.embedding_dedup import OP1_SQL, op1_embedding_near_dedup
from veilwork.llm.language_id import op10_language_id
from veilwork.llm.line_dedup import OP3_SQL, op3_line_dedup
from veilwork.llm.packing import op9_packing
from veilwork.llm.repeat_removal import OP8_SQL, op8_suffix_array_dedup
from veilwork.llm.simhash_dedup import op5_simhash_near_dedup
from veilwork.llm.telephony_audio import op7_media_columns
from veilwork.llm.token_counts import op6_token_counts

QUERIES = {
    f.__name__: f
    for f in (
        op1_embedding_near_dedup, op2_chat_formatting, op3_line_dedup, op4_bpe_encoding, op5_simhash_near_dedup,
        op6_token_counts, op7_media_columns, op8_suffix_array_dedup, op9_packing, op10_language_id,
    )
}

SQL = {"op1_embedding_near_dedup": OP1_SQL, "op2_chat_formatting": OP2_SQL, "op3_line_dedup": OP3_SQL, "op8_suffix_array_dedup": OP8_SQL}
