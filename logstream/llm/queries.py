"""Registered queries of this package and their DuckDB SQL."""

from __future__ import annotations

from .ann import op1_ann
from .bpe import digests
from .chat import OP6_SQL, op6_chat
from .common import read_table
from .decontaminate import OP12_SQL, op12_decontamination
from .exact_dedup import OP9_SQL, op9_exact_dedup
from .mixing import op2_mixing
from .near_dedup import op5_near_dedup
from .periodic import OP11_SQL, op11_periodic_runs
from .quality import op8_quality
from .sharding import op10_sharding
from .toxicity import op3_toxicity
from .warc import OP7_SQL, op7_warc
from .whitening import op13_whitening


def op4_bpe(spark, sf_dir):
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every whole text."""
    import public_tokenizers
    return digests(read_table(spark, sf_dir, "documents"),
                   public_tokenizers.path("byte_bpe_50k.tiktoken"))


QUERIES = {
    "op1_ann": op1_ann,
    "op2_mixing": op2_mixing,
    "op3_toxicity": op3_toxicity,
    "op4_bpe": op4_bpe,
    "op5_near_dedup": op5_near_dedup,
    "op6_chat": op6_chat,
    "op7_warc": op7_warc,
    "op8_quality": op8_quality,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_sharding": op10_sharding,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_decontamination": op12_decontamination,
    "op13_whitening": op13_whitening,
}
SQL = {"op6_chat": OP6_SQL, "op7_warc": OP7_SQL, "op9_exact_dedup": OP9_SQL,
       "op11_periodic_runs": OP11_SQL, "op12_decontamination": OP12_SQL}
