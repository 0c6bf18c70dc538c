"""Configuration: which columns play which role, and the fixed parameters of each stage."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

# The daily air-quality schema and its category labels.
AIR_QUALITY_MEASURES = (
    "PM2.5", "PM10", "NO", "NO2", "NOx", "NH3", "CO", "SO2", "O3", "Benzene", "Toluene", "Xylene",
)
CATEGORY_LABELS = ("Good", "Satisfactory", "Moderate", "Poor", "Very Poor", "Severe")

# Upper-inclusive limits and colours of the hazard bands; the last band is open.
BAND_LIMITS = (50.0, 100.0, 200.0, 300.0, 400.0)
BAND_COLOURS = ("#10B981", "#84CC16", "#F59E0B", "#F97316", "#EF4444", "#7F1D1D")

# Meteorological season of each month (winter 0, summer 1, monsoon 2, post-monsoon 3).
MONTH_TO_SEASON = {12: 0, 1: 0, 2: 0, 3: 1, 4: 1, 5: 1, 6: 2, 7: 2, 8: 2, 9: 2, 10: 3, 11: 3}

SPLITS = ("train", "val", "test")


@dataclass(frozen=True)
class PanelSpec:
    """Roles of the columns of a panel with one row per (entity, time).

    ``bucket_days`` and ``block_rows`` bound how many rows of one entity are ever ordered in a single task: positions
    are counted per (entity, time bucket) and windows run per (entity, block of positions). Where an entity has very many rows a
    day, ``bucket_days`` may be a part of one.
    """

    entity: str = "City"
    time: str = "Date"
    measures: tuple[str, ...] = AIR_QUALITY_MEASURES
    target: str = "AQI"
    category: str = "AQI_Bucket"
    categories: tuple[str, ...] = CATEGORY_LABELS
    valid_flag: str = "aqi_target_valid"
    bucket_days: float = 64
    block_rows: int = 65_536

    @property
    def numeric(self) -> list[str]:
        return [*self.measures, self.target]

    @property
    def required(self) -> list[str]:
        return [self.entity, self.time, *self.measures, self.target, self.category]


# Shares of the first two splits.
TRAIN_SHARE, VAL_SHARE = 0.70, 0.15


@dataclass(frozen=True)
class SplitConfig:
    """Shares of an entity's rows in time order; the rows that ``train`` and ``val`` leave are the test split."""

    train: float = TRAIN_SHARE
    val: float = VAL_SHARE
    scale_target: bool = True

    @property
    def test(self) -> float:
        return round(1.0 - self.train - self.val, 9)

    def __post_init__(self) -> None:
        for name in ("train", "val", "test"):
            if not 0.0 < getattr(self, name) < 1.0:
                raise ValueError(f"the {name} split would get a share of {getattr(self, name)}; each needs one between 0 and 1")


# Fixed values of the feature families: columns, steps back, window lengths, guards against division by zero, and bounds.
INDICATORS = ("PM2.5", "PM10", "NO2", "AQI")
CHANGE_COLUMNS = ("PM2.5", "PM10", "NO2", "CO", "AQI")
VOLATILITY_COLUMNS = ("PM2.5", "PM10", "AQI")
STEPS_BACK, WEEK, FORTNIGHT = (1, 3, 7), 7, 14
GUARD, CHANGE_BOUNDS, VOLATILITY_BOUND = 1e-4, (-5.0, 5.0), 5.0


@dataclass(frozen=True)
class Lags:
    """Values some rows back."""

    columns: tuple[str, ...] = INDICATORS
    steps: tuple[int, ...] = STEPS_BACK

    @property
    def reach(self) -> int:
        return max(self.steps, default=0)


@dataclass(frozen=True)
class Rolling:
    """Statistics of the last rows: window lengths by statistic."""

    columns: tuple[str, ...] = INDICATORS
    windows: Mapping[str, tuple[int, ...]] = field(
        default_factory=lambda: {"mean": (3, WEEK, FORTNIGHT), "std": (WEEK, FORTNIGHT), "min": (WEEK,), "max": (WEEK,)})

    @property
    def reach(self) -> int:
        return max((w - 1 for lengths in self.windows.values() for w in lengths), default=0)


@dataclass(frozen=True)
class Change:
    """Relative change against some rows back, bounded."""

    columns: tuple[str, ...] = CHANGE_COLUMNS
    steps: tuple[int, ...] = STEPS_BACK
    guard: float = GUARD
    bounds: tuple[float, float] = CHANGE_BOUNDS

    @property
    def reach(self) -> int:
        return max(self.steps, default=0)


@dataclass(frozen=True)
class Volatility:
    """Coefficient of variation of the last rows, bounded."""

    columns: tuple[str, ...] = VOLATILITY_COLUMNS
    lengths: tuple[int, ...] = (WEEK, FORTNIGHT)
    guard: float = GUARD
    bound: float = VOLATILITY_BOUND

    @property
    def reach(self) -> int:
        return max((w - 1 for w in self.lengths), default=0)


@dataclass(frozen=True)
class FeatureConfig:
    """Engineered features by family; ``seasons`` maps a month to its season."""

    lags: Lags = Lags()
    rolling: Rolling = field(default_factory=Rolling)
    change: Change = Change()
    volatility: Volatility = Volatility()
    seasons: Mapping[int, int] = field(default_factory=lambda: dict(MONTH_TO_SEASON))
    scale_engineered: bool = True

    @classmethod
    def of(cls, lags: tuple[str, ...], rolling: tuple[str, ...], change: tuple[str, ...], volatility: tuple[str, ...]) -> FeatureConfig:
        """The usual features on other columns."""
        return cls(Lags(lags), Rolling(rolling), Change(change), Volatility(volatility))

    @property
    def reach(self) -> int:
        """Number of preceding rows any feature looks at."""
        return max(f.reach for f in (self.lags, self.rolling, self.change, self.volatility))


@dataclass(frozen=True)
class SequenceConfig:
    lookback: int = 30
    horizon: int = 1
    boundary: str = "continuous_history"
    filter_missing_targets: bool = True

    def __post_init__(self) -> None:
        if self.boundary not in ("continuous_history", "isolated_partition"):
            raise ValueError(f"unknown boundary mode: {self.boundary}")
        if self.lookback < 1 or self.horizon < 1:
            raise ValueError("lookback and horizon must be positive")
