"""The registered queries of the subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .alignment import op13_token_alignment
from .chat import ORACLE as _CHAT
from .chat import op10_chat_format
from .decontamination import ORACLE as _DECONTAMINATION
from .decontamination import op8_benchmark_matches
from .differencing import op12_differencing_packing
from .neardup import ORACLE as _NEARDUP
from .neardup import op5_jaccard_join
from .packing import op7_certified_packing
from .repeats import op2_repeat_removal
from .secret_scan import ORACLE as _SECRETS
from .secret_scan import op3_secret_scan
from .sharding import op6_minimax_shards
from .token_counts import op1_token_counts
from .toxicity import op9_toxicity
from .vector_codes import ORACLE as _VECTOR_CODES
from .vector_codes import op11_vector_codes
from .vectors import op4_embedding_links

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    found = (
        op1_token_counts, op2_repeat_removal, op3_secret_scan, op4_embedding_links, op5_jaccard_join, op6_minimax_shards,
        op7_certified_packing, op8_benchmark_matches, op9_toxicity, op10_chat_format,
        op11_vector_codes, op12_differencing_packing, op13_token_alignment,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {**_SECRETS, **_DECONTAMINATION, **_CHAT, **_NEARDUP, **_VECTOR_CODES}
