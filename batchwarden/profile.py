"""Table profiles: everything the engine has to know about one feed.

A profile names the roles the columns of a table play (date, key, target, features) and the
thresholds its batches are held to.  Operators take a profile instead of hard-wired column names.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

ERROR = "ERROR"
WARN = "WARN"


@dataclass(frozen=True)
class ColumnRule:
    """One column of the technical schema: its kind and whether it may be null."""

    name: str
    kind: str  # "double", "int" or "string"
    nullable: bool = False


@dataclass(frozen=True)
class ConsistencyRule:
    """Cross-field rule: rows whose state is one of ``values`` must not exceed ``maximum``."""

    column: str
    values: tuple[str, ...]
    measure: str
    maximum: float


@dataclass(frozen=True)
class DriftSettings:
    """Signals compared between consecutive passing batches, and when they raise an alert."""

    psi_columns: tuple[str, ...] = ()
    category_columns: tuple[str, ...] = ()
    psi_bins: int = 10
    psi_alert: float = 0.2
    null_rate_alert: float = 0.10
    category_alert: float = 0.15
    max_staleness_days: float = 30.0
    reference_date: str | None = None


@dataclass(frozen=True)
class ModelSettings:
    """Hyper-parameters of the compared regressors."""

    tree_depth: int = 12
    tree_min_leaf: int = 5
    forest_trees: int = 200
    forest_depth: int = 16
    forest_min_leaf: int = 3


@dataclass(frozen=True)
class TableProfile:
    """Column roles and thresholds of one monitored table."""

    name: str
    date_column: str
    required: tuple[str, ...]
    key: str | None = None
    freq: str = "W"
    min_batch_rows: int = 100
    min_rows: int = 100
    schema: tuple[ColumnRule, ...] = ()
    ranges: dict[str, tuple[float, float]] = field(default_factory=dict)
    null_fraction_max: dict[str, float] = field(default_factory=dict)
    key_severity: str = ERROR
    category_column: str | None = None
    known_values: tuple[str, ...] = ()
    consistency: ConsistencyRule | None = None
    max_error_fraction: float = 0.25
    drift: DriftSettings = field(default_factory=DriftSettings)
    target: str | None = None
    numeric: tuple[str, ...] = ()
    categorical: tuple[str, ...] = ()
    max_categories: int | None = 40
    test_size: float = 0.2
    seed: int = 42
    models: ModelSettings = field(default_factory=ModelSettings)
    column_map: dict[str, str] = field(default_factory=dict)

    def but(self, **changes) -> "TableProfile":
        """A copy with some settings replaced."""
        return replace(self, **changes)

    def with_drift(self, **changes) -> "TableProfile":
        """A copy with some drift settings replaced."""
        return replace(self, drift=replace(self.drift, **changes))

    @property
    def numeric_columns(self) -> tuple[str, ...]:
        """Every column the profile treats as a number."""
        typed = [r.name for r in self.schema if r.kind in ("double", "int")]
        target = [self.target] if self.target else []
        names = typed + list(self.ranges) + list(self.numeric) + target
        return tuple(dict.fromkeys(names))

    @property
    def category_check(self) -> str:
        """Name of the category-membership check."""
        return f"category:{self.category_column}"
