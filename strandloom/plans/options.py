"""Options of a run and the defaults of its modes."""

from __future__ import annotations

import math
from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Options:
    mode: str = "strict"
    threshold: float = 0.98
    family_threshold: float = 0.7
    len_dif: float = 0.98
    family_len_dif: float = 0.0
    merge_paralogs: bool = False
    search_radius: int = 5000
    refind_share: float = 0.2
    refind: str = "default"
    min_trailing_support: int | None = None
    trailing_recursive: int | None = None
    min_edge_support_sv: int | None = None
    remove_by_consensus: bool | None = None
    edge_support_threshold: float | None = None
    length_outlier_share: float = 0.1
    clean_edges: bool = True
    remove_invalid: bool = False
    alignment: str | None = None
    core_threshold: float = 0.95
    core_subset: int | None = None
    entropy_filter: float | None = None
    code: int = 11
    codons: bool = False

    def for_genomes(self, n: int) -> Options:
        """With the mode's defaults for what isn't set; n is the number of genomes, also where a list names them."""
        one, five = max(2, math.ceil(0.01 * n)), max(2, math.ceil(0.05 * n))
        if self.mode not in ("strict", "moderate", "sensitive"):
            raise ValueError(f"no mode {self.mode}")
        if self.refind not in ("default", "strict", "off"):
            raise ValueError(f"no way {self.refind} of refinding")
        if self.alignment not in (None, "core", "pan"):
            raise ValueError(f"no alignment {self.alignment}")
        per = {
            "strict": {"min_trailing_support": five, "trailing_recursive": 99999999, "min_edge_support_sv": one, "remove_by_consensus": True, "edge_support_threshold": float(one)},
            "moderate": {"min_trailing_support": one, "trailing_recursive": 99999999, "min_edge_support_sv": one, "remove_by_consensus": False, "edge_support_threshold": float(one)},
            "sensitive": {"min_trailing_support": 2, "trailing_recursive": 0, "min_edge_support_sv": 2, "remove_by_consensus": False, "edge_support_threshold": 0.0},
        }[self.mode]
        return replace(self, **{k: v for k, v in per.items() if getattr(self, k) is None})
