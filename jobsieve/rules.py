"""Classification rules as data: what a posting must and must not mention, and which tier it gets."""

from __future__ import annotations

from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class Rules:
    version: str
    tiers: dict[int, tuple[str, ...]]
    relevance: tuple[str, ...]
    early: tuple[str, ...]
    senior: tuple[str, ...]
    sales: tuple[str, ...]
    marketing: tuple[str, ...]
    infrastructure: tuple[str, ...]
    most_years: int = 5
    #: A paragraph that so many postings of a source share is boilerplate, if they are also this share of its postings.
    boilerplate_postings: int = 3
    boilerplate_share: float = 0.5
    #: If set, a paragraph is boilerplate too if so many of 100 of its runs of words are that common: it may have been edited.
    boilerplate_percent: int | None = None
    #: Reclassification: tokens that move a posting to the last tier.
    demoted: tuple[str, ...] = field(default=())

    def with_version(self, version: str, **changes) -> Rules:
        return replace(self, version=version, **changes)


# The priorities and their terms; the lowest number that matches wins.
TIERS = {
    1: ("ai inference", "model serving", "llm infrastructure", "vllm", "sglang", "tensorrt-llm", "distributed inference"),
    2: ("cuda", "gpu systems", "triton", "nccl", "tensorrt", "ml compilers", "ml compiler", "accelerator runtimes", "accelerator runtime", "hpc"),
    3: ("ai", "ml", "machine learning", "artificial intelligence", "genai", "mlops", "computer vision", "nlp", "applied science", "applied scientist"),
}
BACKUP_TIER = 4

DEFAULT = Rules(
    version="1",
    tiers=TIERS,
    # Relevance terms; every tier's terms are relevant too.
    relevance=("ai", "ml", "machine learning", "inference", "gpu computing", "gpu", "cuda", "mlops", "deep learning"),
    early=("intern", "interns", "internship", "internships", "new grad", "new graduate", "new college grad", "entry level", "entry-level", "early career", "graduate", "junior", "university graduate"),
    senior=("senior", "sr", "staff", "principal", "lead", "director", "manager", "head", "vp", "distinguished", "fellow", "architect"),
    sales=("sales", "account executive", "account manager", "business development", "presales", "pre-sales"),
    marketing=("marketing", "brand", "advertising", "communications"),
    infrastructure=("network engineer", "help desk", "data center technician", "facilities", "it support", "system administrator", "storage administrator"),
)
