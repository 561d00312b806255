"""Job parameters (the command-line flags of the original scripts)."""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class TriageConfig:
    """Relevance rules and encoder settings.

    Defaults are the original tool's flag defaults: a paper is related when
    its mean similarity to the reference papers is strictly above
    ``similarity_threshold``, or when at least ``min_top_papers`` of its
    ``top_k`` best similarities are at or above ``individual_sim_threshold``.
    """

    similarity_threshold: float = 0.9
    top_k: int = 3
    min_top_papers: int = 2
    individual_sim_threshold: float = 0.9
    # declared by the original tool but never applied; see operators.report.top_percentile
    top_percentile: float = 15.0
    batch_size: int = 64
    # compare in float32 like numpy>=2 does for float32 arrays (off: double)
    strict_float32: bool = False
    # largest reference matrix (bytes, float64) held in one broadcast
    max_reference_bytes: int = 64 * 1024 * 1024

    def __post_init__(self) -> None:
        if self.top_k < 1:
            raise ValueError("top_k must be >= 1")
        if self.min_top_papers < 0:
            raise ValueError("min_top_papers must be >= 0")

    def with_(self, **kw) -> "TriageConfig":
        return replace(self, **kw)


# Thresholds for the synthetic test tables: the original 0.9 defaults select
# nothing on random 64-d vectors, these make both rules fire alone and together.
FIXTURE_CONFIG = TriageConfig(
    similarity_threshold=0.05,
    top_k=3,
    min_top_papers=2,
    individual_sim_threshold=0.25,
)

# Fixed values that must equal the original tool's output text.
PROMPT_TEMPLATE = (
    "Instruct: Retrive papers in similar fields to Queries.\n"
    "Queries: \nTitle: {title}\nAbstract: {abstract}"
)

# Number of reference papers in the original tool's literal reference set.
REFERENCE_COUNT = 23
