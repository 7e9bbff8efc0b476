"""Names, thresholds and switches shared by every operator."""

from __future__ import annotations

from dataclasses import dataclass, field, fields


@dataclass(frozen=True)
class TelemetrySpec:
    """Column roles of a telemetry table: one row per (group, entity, order)."""

    group: str = "subset"
    entity: str = "unit_number"
    order: str = "time_cycles"
    target: str = "RUL"
    settings: tuple[str, ...] = ("setting_1", "setting_2", "setting_3")
    sensors: tuple[str, ...] = tuple(f"s_{i}" for i in range(1, 22))

    @property
    def keys(self) -> tuple[str, ...]:
        """Columns that identify one series."""
        return (self.group, self.entity)

    @property
    def base(self) -> tuple[str, ...]:
        """Measured columns, settings first."""
        return self.settings + self.sensors

    @property
    def non_features(self) -> tuple[str, ...]:
        return (self.group, self.entity, self.order, self.target)


SPEC = TelemetrySpec()


@dataclass(frozen=True)
class FeatureSwitches:
    """Which feature blocks `create_features` adds; no windows means no rolling block."""

    rolling_windows: tuple[int, ...] | None = (3, 5, 10, 20)
    delta: bool = True
    setting_pairs: bool = True
    setting_sensor: bool = True
    temperature: bool = True
    pressure: bool = True
    speed: bool = True
    fuel_air: bool = True
    cross_system: bool = True


@dataclass(frozen=True)
class DriftThresholds:
    """Warning and alert levels of the drift decision."""

    psi_warn: float = 0.1
    psi_alert: float = 0.25
    ks_warn: float = 0.1
    ks_alert: float = 0.2
    rmse_warn_factor: float = 1.1
    rmse_alert_factor: float = 1.3


# Inclusive band of remaining life kept for training, per group.
RUL_BANDS: dict[int, tuple[int, int]] = {1: (6, 145), 2: (6, 194), 3: (6, 145), 4: (6, 194)}

# Fixed value: entities of group g are renumbered by adding g times this stride.
UNIT_STRIDE = 1000


# Fixed value: share of the entities that a first training uses.
FIRST_FRACTION = 0.1


@dataclass(frozen=True)
class ForestParams:
    """Forest settings; the defaults are the production values."""

    num_trees: int = 500
    max_depth: int = 20
    min_instances: int = 2
    feature_subset: str = "sqrt"
    max_bins: int = 32
    seed: int = 46
    subsampling_rate: float = 1.0

    def as_map(self) -> dict[str, str]:
        return {f.name: str(getattr(self, f.name)) for f in fields(self)}


@dataclass(frozen=True)
class ModelMetadata:
    """What a stored model says about itself."""

    version: str
    feature_names: tuple[str, ...]
    test_rmse: float
    target: str = "RUL"
    model_type: str = "RandomForestRegressor"
    params: dict[str, str] = field(default_factory=dict)

    @property
    def n_features(self) -> int:
        return len(self.feature_names)
