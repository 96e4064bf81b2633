"""Queries of this subpackage and the SQL that checks them, by name."""

from __future__ import annotations

from . import boosting, bytebpe, infill, langid, oracles, packing, pii, quality, rolling, sharding, simhash, suffixes, syncmers, tokenfile

QUERIES = {
    "op1_distribution_divergence": quality.op1_distribution_divergence,
    "op2_bidirectional_gru": langid.op2_bidirectional_gru,
    "op3_hypergeometric_shards": sharding.op3_hypergeometric_shards,
    "op4_closed_syncmers": syncmers.op4_closed_syncmers,
    "op5_distinct_word_bpe": bytebpe.op5_distinct_word_bpe,
    "op6_bootstrapped_contexts": pii.op6_bootstrapped_contexts,
    "op7_minimum_bin_slack": packing.op7_minimum_bin_slack,
    "op8_simple8b_files": tokenfile.op8_simple8b_files,
    "op9_simhash_anchors": simhash.op9_simhash_anchors,
    "op10_column_wise_suffixes": suffixes.op10_column_wise_suffixes,
    "op11_rolling_medians": rolling.op11_rolling_medians,
    "op12_boosted_quality": boosting.op12_boosted_quality,
    "op13_succinct_infill": infill.op13_succinct_infill,
}

#: The others use hashes, vocabularies, draws or iteration that SQL doesn't have, or are too slow in it; the tests hold
#: them against brute force.
ORACLES: dict[str, str] = oracles.ORACLES
