"""Replicate-weight survey design (A1, A2): a plain config next to a DataFrame."""

from __future__ import annotations

from dataclasses import dataclass, replace

from repweave.constants import N_REPLICATES, SE_MULTIPLIER


@dataclass(frozen=True)
class ReplicateDesign:
    """BRR replicate design.

    weight        full-sample weight column
    repweights    ARRAY<DOUBLE> column with the R replicate weights
    n_replicates  R
    mse           centre the variance on the full-sample estimate (True) or on
                  the mean of the replicate estimates (False)
    scale         variance scale; BRR default 1/R
    se_multiplier factor applied to published SEs (2 for this survey)
    weight_factor multiply every weight (0.5 for two-week pooled samples, P36);
                  means are ratios, so it only matters for totals
    """

    weight: str = "pweight"
    repweights: str = "repw"
    n_replicates: int = N_REPLICATES
    mse: bool = True
    scale: float | None = None
    se_multiplier: float = SE_MULTIPLIER
    weight_factor: float = 1.0

    @property
    def var_scale(self) -> float:
        return self.scale if self.scale is not None else 1.0 / self.n_replicates

    def with_(self, **kw) -> "ReplicateDesign":
        return replace(self, **kw)


ROLLING = ReplicateDesign(weight_factor=0.5)
