"""Brute-force forms that several tests share."""

from test_bpe_packing import check_packing
from test_simhash_ann import slow_components, slow_fingerprint
from test_substring_dedup import slow as slow_repeats

__all__ = ["check_packing", "slow_components", "slow_fingerprint", "slow_repeats"]
