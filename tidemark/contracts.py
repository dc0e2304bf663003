"""Dataset contracts: schema, keys, temporal and usage policies, with their integrity checks."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import lru_cache
from importlib import resources

from pyspark.sql import DataFrame, SparkSession

# Controlled vocabularies.
TEMPORAL_MODES = ("reference", "eod", "event", "filing", "intraday_snapshot")
FINALITIES = ("final", "provisional", "revised")
AVAILABLE_AFTER = ("post_close", "realtime", "delayed", "on_demand")
DATASET_ROLES = ("core_fact", "financial_fact", "reference_fact", "enrichment_fact", "provisional_observation", "evidence_seed", "feature_signal")
USES = (
    "candidate_generation", "market_context", "feature_input", "market_validation", "context", "cross_market_context", "cross_market_validation", "evidence",
    "company_business_exposure", "evidence_triage", "research_prioritization", "ashare_primary_candidate_generation", "financial_analysis", "disclosure_context", "trade_execution",
)
AS_OF_POLICIES = ("exact", "latest_before", "range")
EMPTY_POLICIES = ("forbid_empty", "allow_empty")
CONFIDENCES = ("low", "medium", "high")
MATURITIES = ("fetched", "curated", "inferred")
SOURCE_TYPES = (
    "regulator", "exchange", "company_filing", "company_ir", "official", "official_platform", "industry_association",
    "gov_policy", "price_index", "tender_platform", "vendor", "media", "research_report", "other",
)
ENTITY_TYPES = (
    "company", "issuer", "security", "filing_entity", "industry", "industry_chain_node", "product", "theme",
    "evidence_source_group", "region", "country", "peer_group", "controller",
)
PREDICATES = (
    "alias_of", "belongs_to", "has_component", "has_product_exposure", "maps_to_concept", "preferred_source_for",
    "supplies_to", "listed_as", "has_filing_id", "customer_of", "supplier_to", "competes_with", "same_group_as",
    "maps_to_overseas_peer", "has_revenue_exposure", "has_geographic_exposure", "controlled_by",
)
DATE_KEYS = ("trade_date", "snapshot_date", "publish_date", "query_date", "ann_date", "end_date")
WINDOW_KEYS = ("trade_date", "query_date", "publish_date", "snapshot_date")


class ContractError(ValueError):
    """A contract, or data that breaks one."""


@dataclass(frozen=True)
class TemporalPolicy:
    temporal_mode: str
    finality: str
    available_after: str
    as_of_policy: str

    def __post_init__(self):
        if self.temporal_mode not in TEMPORAL_MODES or self.finality not in FINALITIES or self.as_of_policy not in AS_OF_POLICIES:
            raise ContractError(f"unknown temporal policy {self}")
        if self.available_after not in AVAILABLE_AFTER:
            raise ContractError(f"unknown availability {self.available_after!r}")


@dataclass(frozen=True)
class UsagePolicy:
    allowed: tuple[str, ...] = ()
    forbidden: tuple[str, ...] = ()

    def __post_init__(self):
        if both := set(self.allowed) & set(self.forbidden):
            raise ContractError(f"uses both allowed and forbidden: {sorted(both)}")
        if unknown := {*self.allowed, *self.forbidden} - set(USES):
            raise ContractError(f"unknown uses {sorted(unknown)}")

    def permits(self, use: str) -> bool:
        return use in self.allowed and use not in self.forbidden


@dataclass(frozen=True)
class DatasetContract:
    dataset_id: str
    role: str
    partition_keys: tuple[str, ...]
    primary_key: tuple[str, ...]
    required_columns: tuple[str, ...]
    temporal: TemporalPolicy
    usage: UsagePolicy = field(default_factory=UsagePolicy)
    analysis_columns: tuple[str, ...] = ()
    empty_policy: str = "forbid_empty"

    def __post_init__(self):
        if not set(self.primary_key) <= set(self.required_columns):
            raise ContractError(f"{self.dataset_id}: primary key columns must be required")
        if self.role not in DATASET_ROLES:
            raise ContractError(f"{self.dataset_id}: unknown role {self.role!r}")
        if self.empty_policy not in EMPTY_POLICIES:
            raise ContractError(f"{self.dataset_id}: unknown empty policy {self.empty_policy!r}")

    @property
    def domain(self) -> str:
        return self.dataset_id.split(".", 1)[0]

    def window_key(self) -> str | None:
        """The partition key that reading by window goes by."""
        return next((k for k in WINDOW_KEYS if k in self.partition_keys), self.partition_keys[0] if len(self.partition_keys) == 1 else None)


def _tuple(cell: str) -> tuple[str, ...]:
    return tuple(x for x in cell.split(",") if x)


def parse_contract(line: str) -> DatasetContract:
    name, role, parts, key, other, analysis, temporal, empty, allowed, forbidden = line.split("|")
    return DatasetContract(
        name, role, _tuple(parts), _tuple(key), (*_tuple(key), *_tuple(other)), TemporalPolicy(*temporal.split(",")), UsagePolicy(_tuple(allowed), _tuple(forbidden)), _tuple(analysis), empty
    )


class Registry:
    """Contracts by id. Unknown ids raise, registering an id twice too."""

    def __init__(self, contracts=()):
        self._by_id: dict[str, DatasetContract] = {}
        for c in contracts:
            self.register(c)

    def register(self, contract: DatasetContract) -> None:
        if contract.dataset_id in self._by_id:
            raise ContractError(f"dataset registered twice: {contract.dataset_id}")
        self._by_id[contract.dataset_id] = contract

    def require(self, dataset_id: str) -> DatasetContract:
        if dataset_id not in self._by_id:
            raise ContractError(f"unknown dataset {dataset_id!r}")
        return self._by_id[dataset_id]

    def check_dependencies(self, needs: dict[str, tuple[str, ...]]) -> None:
        """Raise if anything (a feature, say) depends on datasets that are not registered or states no use of its own."""
        for name, datasets in needs.items():
            if unknown := [d for d in datasets if d not in self._by_id]:
                raise ContractError(f"{name}: unknown datasets {unknown}")

    def __iter__(self):
        return iter(self._by_id.values())

    def __len__(self) -> int:
        return len(self._by_id)

    def frame(self, spark: SparkSession) -> DataFrame:
        """The contracts as rows, for queries over them."""
        rows = [
            (c.dataset_id, c.domain, c.role, list(c.partition_keys), list(c.primary_key), list(c.required_columns), list(c.analysis_columns), c.temporal.temporal_mode, c.temporal.as_of_policy, c.empty_policy, list(c.usage.allowed), list(c.usage.forbidden))
            for c in self
        ]
        arr = "array<string>"
        return spark.createDataFrame(
            rows,
            f"dataset_id string, domain string, role string, partition_keys {arr}, primary_key {arr}, required_columns {arr}, analysis_columns {arr}, temporal_mode string, as_of_policy string, empty_policy string, allowed {arr}, forbidden {arr}",
        )


@lru_cache(maxsize=1)
def default_registry() -> Registry:
    lines = resources.files("tidemark").joinpath("contracts.psv").read_text(encoding="utf-8").splitlines()
    return Registry(parse_contract(line) for line in lines if line and not line.startswith("#"))
