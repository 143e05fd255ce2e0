"""Build settings as frozen dataclasses, checked when they are made."""

from __future__ import annotations

from dataclasses import asdict, dataclass, field

# --- Fixed values: they must equal the published defaults for equal results. ---
EVENT_TYPE_MAP = {
    "view": "view",
    "cart": "cart",
    "remove_from_cart": "remove",
    "purchase": "purchase",
}
PROVINCES = ("ID-JK", "ID-JB", "ID-JT", "ID-JI", "ID-PA", "ID-SN", "ID-SU", "ID-KI")
PROVINCE_WEIGHTS = (0.32, 0.21, 0.14, 0.13, 0.04, 0.06, 0.07, 0.03)
DEVICES = ("mobile", "desktop", "tablet")
DEVICE_WEIGHTS = (0.78, 0.18, 0.04)
SEED = 20260831
# --- End of fixed values. ---


def _check_rate(name: str, value: float) -> None:
    if not 0.0 <= value <= 1.0:
        raise ValueError(f"{name} must lie in [0, 1], got {value}")


@dataclass(frozen=True)
class DegradeConfig:
    """How strongly each degradation operator changes the events."""

    null_item_rate: float = 0.25
    cold_item_rate: float = 0.15
    jitter_rate_per_s: float = 0.5
    cart_drop_rate: float = 0.08
    bot_fraction: float = 0.05
    bot_rate_per_s: float = 150.0
    bot_gap_min_ms: int = 1
    bot_gap_max_ms: int = 10

    def __post_init__(self) -> None:
        for name in ("null_item_rate", "cold_item_rate", "cart_drop_rate", "bot_fraction"):
            _check_rate(name, getattr(self, name))
        for name in ("jitter_rate_per_s", "bot_rate_per_s"):
            if getattr(self, name) <= 0:
                raise ValueError(f"{name} must be positive")
        if not 0 <= self.bot_gap_min_ms <= self.bot_gap_max_ms:
            raise ValueError("bot gaps must satisfy 0 <= min <= max")


@dataclass(frozen=True)
class RatingConfig:
    """Weights and range of the implicit rating."""

    view: float = 1.0
    cart: float = 3.0
    buy: float = 5.0
    dwell: float = 0.5
    low: float = 1.0
    high: float = 5.0

    def __post_init__(self) -> None:
        if self.high < self.low:
            raise ValueError("high must not be below low")


@dataclass(frozen=True)
class BuildConfig:
    """Everything ``recprep.plans.build.build_dataset`` needs besides its inputs."""

    seed: int = SEED
    test_fraction: float = 0.15
    min_user_events: int = 5
    session_gap_minutes: int = 30
    provinces: tuple[str, ...] = PROVINCES
    devices: tuple[str, ...] = DEVICES
    device_weights: tuple[float, ...] = DEVICE_WEIGHTS
    degrade: DegradeConfig = field(default_factory=DegradeConfig)
    rating: RatingConfig = field(default_factory=RatingConfig)

    def __post_init__(self) -> None:
        _check_rate("test_fraction", self.test_fraction)
        if self.min_user_events < 1:
            raise ValueError("min_user_events must be at least 1")
        if not self.provinces:
            raise ValueError("provinces must not be empty")

    @property
    def dwell_cap_ms(self) -> int:
        return self.session_gap_minutes * 60_000

    def as_dict(self) -> dict:
        return asdict(self)
