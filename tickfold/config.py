"""Parameter sets. Operators take plain arguments; these dataclasses only group the usual values."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# ---------------------------------------------------------------------------
# Series whose rolling values and momentum are built.
# ---------------------------------------------------------------------------
CHANGE_INDEX = ("p_b", "p_fcf_ttm")
SUM_COLUMNS = ("return_index",)
AVG_COLUMNS = ("p_b_index", "p_fcf_ttm_index")
MEDIAN_COLUMNS = ("volume",)

# Momentum name -> rolling series it is built from.
MOMENTUM_SERIES = {
    "return": "sum_return_index",
    "pb": "avg_p_b_index",
    "fcf_ttm": "avg_p_fcf_ttm_index",
}
# Months back -> rolling window (days) used for numerator and denominator.
MOMENTUM_WINDOW = {1: 7, 3: 11, 6: 11, 12: 11}

TARGET = "target_1m_mom_lead"

# Bucket floors in dollars, largest first; below the last is "penny", missing is "other".
CAP_FLOORS = (("mega", 2e11), ("large", 1e10), ("mid", 2e9), ("small", 3e8), ("micro", 5e7))
CAP_EXCLUDED = ("other", "penny")


def rolling_name(days: int, series: str) -> str:
    """``rolling_name(7, "sum_return_index")`` -> ``roll_7day_sum_return_index``."""
    return f"roll_{days}day_{series}"


def lag_name(days: int, series: str, months: int) -> str:
    return f"{rolling_name(days, series)}_{months}m_lag"


def momentum_name(name: str, months: int) -> str:
    return f"{name}_mom_{months}_0"


def momentum_inputs() -> list[str]:
    """The 29 columns kept before the momentum ratios are taken."""
    keys = ["date", "ticker", "sector", "market_cap", "market_cap_cat", "p_b", "p_fcf_ttm", "roll_30day_med_volume",
            "return_index", "p_b_index", "p_fcf_ttm_index"]
    rolled = []
    for series in MOMENTUM_SERIES.values():
        rolled += [rolling_name(7, series), rolling_name(11, series)]
        rolled += [lag_name(days, series, months) for months, days in MOMENTUM_WINDOW.items()]
    return keys + rolled


def modeling_drops() -> list[str]:
    """Helper columns that do not reach the modeling table (22)."""
    keep = {"date", "ticker", "sector", "market_cap_cat", "p_b", "p_fcf_ttm", "roll_30day_med_volume"}
    return [c for c in momentum_inputs() if c not in keep]


def momentum_ratios() -> list[tuple[str, str, str]]:
    """(output, numerator, denominator) for the 12 momentum columns, shortest horizon first."""
    return [
        (momentum_name(name, months), rolling_name(days, series), lag_name(days, series, months))
        for months, days in MOMENTUM_WINDOW.items()
        for name, series in MOMENTUM_SERIES.items()
    ]


def model_features(lag_range: int = 25) -> list[str]:
    """Two categorical and 87 numeric features (for the default lag range)."""
    base = ["sector", "market_cap_cat", "p_b", "p_fcf_ttm", "roll_30day_med_volume"]
    ratios = [out for out, _, _ in momentum_ratios()]
    lags = [f"{momentum_name(n, 1)}_L{k}" for n in MOMENTUM_SERIES for k in range(1, lag_range)]
    return base + ratios + lags


CATEGORICAL = ("sector", "market_cap_cat")


# ---------------------------------------------------------------------------
# Hyper-parameter lists of the searches and the chosen model.
# ---------------------------------------------------------------------------
def even_ints(first: int, last: int, count: int) -> list[int]:
    """``count`` evenly spaced values from first to last, truncated to int."""
    return [int(first + (last - first) * i / (count - 1)) for i in range(count)]


COARSE_GRID = {
    "n_estimators": even_ints(50, 1000, 30),
    # 0.001 stands twice on purpose: it doubles that value's weight in the random search
    "learning_rate": [0.0004, 0.0005, 0.0006, 0.0007, 0.0008, 0.0009, 0.001, 0.002, 0.005, 0.001, 0.01],
    "max_depth": list(range(2, 21)),
    "num_leaves": [4, 6, 8, 16, 32, 64, 128, 256, 386, 512, 1024, 2048, 4096, 8192],
    "min_data_in_leaf": even_ints(50, 2500, 30),
}
FINE_GRID = {
    "n_estimators": [250, 350, 450, 550, 650, 750],
    "learning_rate": [0.0004, 0.0005, 0.0006, 0.0007],
    "max_depth": [3, 4, 5, 6, 7, 8, 9, 10],
    "num_leaves": [4, 6, 8, 16, 32, 64, 128, 256],
    "min_data_in_leaf": [150, 250, 750, 850, 950],
}
HALVING_GRID = {
    "n_estimators": [50, 70, 90, 120, 150, 175] + list(range(200, 1001, 50)),
    "learning_rate": COARSE_GRID["learning_rate"],
    "max_depth": COARSE_GRID["max_depth"],
    "num_leaves": [4, 6, 8, 12, 16, 24, 32, 64, 128, 256, 386, 424, 512, 728, 934, 1024, 1276, 1454, 1687, 1892, 2048,
                   4096, 8192],
    "min_data_in_leaf": [150, 175, 200] + list(range(250, 1001, 50)) + list(range(1100, 2501, 100)),
}
FOREST_GRID = {
    "n_estimators": list(range(50, 351, 10)),
    "max_depth": list(range(100, 351, 10)),
    "min_samples_leaf": list(range(2, 21, 2)),
    "min_samples_split": list(range(2, 21, 2)),
}
XGB_GRID = {
    "n_estimators": list(range(50, 351, 10)),
    "eta": [0.01, 0.012, 0.013, 0.014, 0.015, 0.016, 0.017, 0.018, 0.019, 0.02],
    "lambda": [5 + 0.625 * i for i in range(25)],
    "gamma": [5 + 0.625 * i for i in range(25)],
    "max_depth": [10, 30, 50, 70, 85] + list(range(100, 351, 10)),
}
BEST_PARAMS = {
    "n_estimators": 750,
    "learning_rate": 0.0004,
    "max_depth": 6,
    "num_leaves": 64,
    "min_data_in_leaf": 950,
    "random_state": 638552,
}
COARSE_ITERATIONS = 1000
EXPLORATORY_ITERATIONS = 50


def month_starts(first: str, count: int) -> list[str]:
    """``count`` first-of-month dates from ``first`` on."""
    year, month = int(first[:4]), int(first[5:7])
    return [f"{year + (month - 1 + i) // 12:04d}-{(month - 1 + i) % 12 + 1:02d}-01" for i in range(count)]


@dataclass(frozen=True)
class Fold:
    """Train on dates before ``train_before``; test on [test_from, test_to)."""

    train_before: str
    test_from: str
    test_to: str


@dataclass(frozen=True)
class Settings:
    """Dates and sizes of one run."""

    start_date: str = "2007-02-01"
    current_date: str = "2021-10-29"
    modeling_data_date: str = "2020-02-01"
    folds: tuple[Fold, ...] = (
        Fold("2013-01-01", "2015-01-01", "2016-07-01"),
        Fold("2014-01-01", "2016-07-01", "2018-01-01"),
        Fold("2015-01-01", "2018-01-01", "2019-07-01"),
        Fold("2016-01-01", "2019-07-01", "2020-02-01"),
    )
    walk_pairs: tuple[tuple[str, str], ...] = tuple(
        zip(month_starts("2020-02-01", 20), month_starts("2020-03-01", 20))
    )
    volume_floor: float = 20000.0
    lag_range: int = 25
    top_n: int = 100
    initial_amount: float = 100000.0
    confidence: float = 0.9
    schedule_start: str = "2020-02-01"
    schedule_end: str = "2021-12-31"
    last_prediction: str = "2021-09-30"
    production_train: str = "2021-10-01"
    production_test: str = "2021-11-01"
    production_start: str = "2021-10-01"
    production_end: str = "2022-01-31"
    last_production: str = "2021-10-29"
    holidays: bool = True
    best_params: dict = field(default_factory=lambda: dict(BEST_PARAMS))

    @property
    def features(self) -> list[str]:
        return model_features(self.lag_range)

    def with_(self, **changes) -> "Settings":
        return replace(self, **changes)


# Values for the TPC-H-shaped test tables, whose dates run from 1995 to 2001.
FIXTURE = Settings(
    start_date="1995-02-01",
    current_date="2001-10-31",
    modeling_data_date="2000-07-01",
    folds=(
        Fold("1998-07-01", "1999-01-01", "1999-07-01"),
        Fold("1998-10-01", "1999-07-01", "1999-10-01"),
        Fold("1999-01-01", "1999-10-01", "2000-01-01"),
        Fold("1999-04-01", "2000-01-01", "2000-07-01"),
    ),
    walk_pairs=tuple(zip(month_starts("2000-07-01", 15), month_starts("2000-08-01", 15))),
    schedule_start="2000-07-01",
    schedule_end="2001-10-31",
    last_prediction="2001-08-31",
    production_train="2001-07-01",
    production_test="2001-08-01",
    production_start="2001-07-01",
    production_end="2001-10-31",
    last_production="2001-07-31",
    holidays=False,
    best_params={"n_estimators": 5, "learning_rate": 0.1, "max_depth": 3, "num_leaves": 8, "min_data_in_leaf": 10,
                 "random_state": 638552},
)
