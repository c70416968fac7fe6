"""The queries of this folder by name, and their DuckDB SQL where there is one."""

from __future__ import annotations

import corpus_pipeline
from thermolake.llm import alignment, bitpack, ctw, decontaminate, hyperlang, linecrf, ngramjoin, oracle, sharding, suffixdedup, superminhash, telephony, whitening, wordbpe
from thermolake.session import ship_path

OPERATORS = [
    ctw.op1_context_tree,
    superminhash.op2_superminhash,
    suffixdedup.op3_sparse_suffixes,
    wordbpe.op4_word_bpe,
    decontaminate.op5_decontamination,
    linecrf.op6_line_crf,
    hyperlang.op7_hyperlang,
    telephony.op8_telephony,
    bitpack.op9_bit_packing,
    sharding.op10_balanced_shards,
    alignment.op11_diagonal_runs,
    whitening.op12_whitening,
    ngramjoin.op13_divide_skip,
]


def _ready(query):
    def run(spark, sf_dir):
        ship_path(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict:
    return {"pipeline": _ready(corpus_pipeline.run)} | {f.__name__: _ready(f) for f in OPERATORS}


def oracle_sql() -> dict[str, str]:
    return dict(oracle.SQL)
