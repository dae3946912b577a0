"""Column roles of a decision table, passed to operators instead of hard-wired names."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class TableSpec:
    target: str
    id_cols: tuple[str, ...] = ()
    numeric: tuple[str, ...] = ()
    categorical: tuple[str, ...] = ()
    clip_negative: tuple[str, ...] = ()
    negative_check: tuple[str, ...] = ()
    positive_label: str | None = None
    negative_label: str | None = None

    @property
    def model_columns(self) -> list[str]:
        return list(self.numeric) + list(self.categorical)

    def with_(self, **kw) -> "TableSpec":
        d = {f: getattr(self, f) for f in self.__dataclass_fields__}
        d.update({k: tuple(v) if isinstance(v, list) else v for k, v in kw.items()})
        return TableSpec(**d)


# Column roles of the credit-application table the operators were designed for.
CREDIT_SPEC = TableSpec(
    target="loan_status",
    id_cols=("loan_id",),
    numeric=(
        "no_of_dependents", "income_annum", "loan_amount",
        "loan_term", "cibil_score", "residential_assets_value",
        "commercial_assets_value", "luxury_assets_value", "bank_asset_value",
    ),
    categorical=("education", "self_employed"),
    clip_negative=("residential_assets_value",),
    negative_check=(
        "income_annum", "loan_amount", "residential_assets_value",
        "commercial_assets_value", "luxury_assets_value", "bank_asset_value",
    ),
    positive_label="Approved",
    negative_label="Rejected",
)

# Derived-feature roles: the nine base numerics plus the four engineered ones.
CREDIT_FEATURE_SPEC = CREDIT_SPEC.with_(
    numeric=list(CREDIT_SPEC.numeric)
    + ["total_assets", "loan_to_income_ratio", "loan_to_assets_ratio", "net_worth_proxy"]
)
