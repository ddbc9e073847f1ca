"""Every query of the subpackage; importing the modules registers them."""

from gradeloom.llm import (  # noqa: F401
    best_two_fit,
    collision_projections,
    conversation_repair,
    decision_list,
    host_suffixes,
    license_rules,
    multi_order_join,
    noisy_channel,
    rank_array_bpe,
    run_index,
    sentence_spans,
    simhash,
    target_resampling,
)
from gradeloom.llm.catalog import ORACLES, QUERIES  # noqa: F401
