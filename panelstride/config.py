"""Column roles, feature parameters and the two rule presets.

Everything that the source pipeline hard-codes (column names, window lengths,
horizon, time cuts) is a parameter here; the source values are the defaults.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# ---------------------------------------------------------------------------
# Fixed values. These must equal the source pipeline's names for results and
# artifacts to line up; they are listed as-is, in the source's order.
# ---------------------------------------------------------------------------

# Gold feature list, in model-input order.
FEATURE_COLUMNS = (
    "return_5d",
    "return_20d",
    "volatility_20d",
    "volume_ratio_20d",
    "price_to_ma20",
    "price_to_ma50",
    "usdtry_return_20d",
    "bist100_return_20d",
    "volume",
    "usdtry",
    "market_cap_mn_tl",
    "market_cap_mn_usd",
    "free_float_market_cap_mn_tl",
    "free_float_market_cap_mn_usd",
    "capital_mn_tl",
)

# Gold base columns, before the features.
GOLD_BASE_COLUMNS = (
    "date",
    "ticker",
    "close",
    "future_return_20d",
    "future_bist100_return_20d",
    "target_outperform_20d",
)

# Bronze (cleaned header) -> silver name.
SILVER_RENAME = {
    "tarih": "date",
    "kapanis_tl": "close",
    "min_tl": "min_price",
    "max_tl": "max_price",
    "aof_tl": "avg_price",
    "hacim_tl": "volume",
    "sermaye_mn_tl": "capital_mn_tl",
    "usdtry": "usdtry",
    "bist_100": "bist100",
    "piyasadegeri_mn_tl": "market_cap_mn_tl",
    "piyasadegeri_mn_usd": "market_cap_mn_usd",
    "halkaacik_pd_mn_tl": "free_float_market_cap_mn_tl",
    "halkaacik_pd_mn_usd": "free_float_market_cap_mn_usd",
    "ticker": "ticker",
    "source_file": "source_file",
}

# Silver numeric columns, cast to DOUBLE.
SILVER_NUMERIC = (
    "close",
    "min_price",
    "max_price",
    "avg_price",
    "volume",
    "capital_mn_tl",
    "usdtry",
    "bist100",
    "market_cap_mn_tl",
    "market_cap_mn_usd",
    "free_float_market_cap_mn_tl",
    "free_float_market_cap_mn_usd",
)

# Raw header -> name dictionary of the script chain (tried before the
# generic rule).
HEADER_DICTIONARY = {
    "Tarih": "date",
    "Kapanış(TL)": "close",
    "Kapanis(TL)": "close",
    "Min(TL)": "min_price",
    "Max(TL)": "max_price",
    "AOF(TL)": "avg_price",
    "Hacim(TL)": "volume",
    "Sermaye(m": "capital",
    "Sermaye(m)": "capital",
    "USDTRY": "usdtry",
    "BIST 100": "bist100",
    "PiyasaDeğe": "market_cap",
    "PiyasaDeğer": "market_cap",
    "PiyasaDeğeri": "market_cap",
    "PiyasaDegeri": "market_cap",
    "HalkaAçık": "free_float",
    "HalkaAcik": "free_float",
    "HalkaAçık PD(m USD)": "free_float_market_cap_usd",
    "PD(m USD)": "market_cap_usd",
    "PD/DD": "pb_ratio",
}

# Letter pairs the script chain folds before its generic header rule.
HEADER_FOLD_FROM = "ğĞüÜşŞıİöÖçÇ"
HEADER_FOLD_TO = "gGuUsSiIoOcC"

# Prediction class -> text.
CLASS_LABELS = {1: "Outperform", 0: "Not Outperform"}

# Time cuts of the train / validation / test split.
DEFAULT_CUTS = ("2021-01-01", "2023-01-01")


@dataclass(frozen=True)
class PanelColumns:
    """Roles of the panel's columns."""

    entity: str = "ticker"
    time: str = "date"
    price: str = "close"
    benchmark: str = "bist100"
    fx: str = "usdtry"
    volume: str = "volume"
    #: Order of rows that share entity and time, as far as these columns are present.
    ties: tuple[str, ...] = ()

    def present_in(self, columns) -> "PanelColumns":
        return replace(self, ties=tuple(t for t in self.ties if t in columns))


@dataclass(frozen=True)
class FeatureConfig:
    """Feature, label and row-rule parameters.

    ``fill``: ``"ffill"`` forward-fills price, FX and benchmark inside each
    entity before percentage changes (pandas 2 ``pct_change``); ``"none"``
    does not. ``gold_rule``: ``"all"`` keeps rows where every gold column is
    non-null (notebook chain); ``"required"`` only checks features and forward
    returns (script chain).
    """

    cols: PanelColumns = field(default_factory=PanelColumns)
    return_periods: tuple[int, ...] = (1, 5, 20)
    volatility_window: int = 20
    ma_windows: tuple[int, ...] = (20, 50)
    volume_window: int = 20
    market_period: int = 20
    horizon: int = 20
    fill: str = "ffill"
    required: tuple[str, ...] = ("date", "ticker", "close")
    gold_rule: str = "all"
    features: tuple[str, ...] = FEATURE_COLUMNS
    extra_cols: tuple[str, ...] = ()

    def with_(self, **kw) -> "FeatureConfig":
        return replace(self, **kw)

    # derived names ------------------------------------------------------
    @property
    def label(self) -> str:
        return f"target_outperform_{self.horizon}d"

    @property
    def future_return(self) -> str:
        return f"future_return_{self.horizon}d"

    @property
    def future_benchmark_return(self) -> str:
        return f"future_{self.cols.benchmark}_return_{self.horizon}d"

    def return_name(self, k: int) -> str:
        return f"return_{k}d"

    @property
    def volatility(self) -> str:
        return f"volatility_{self.volatility_window}d"

    def ma_ratio(self, n: int) -> str:
        return f"price_to_ma{n}"

    @property
    def volume_ratio(self) -> str:
        return f"volume_ratio_{self.volume_window}d"

    @property
    def fx_return(self) -> str:
        return f"{self.cols.fx}_return_{self.market_period}d"

    @property
    def benchmark_return(self) -> str:
        return f"{self.cols.benchmark}_return_{self.market_period}d"

    @property
    def model_required(self) -> tuple[str, ...]:
        """Feature and forward-return columns the script chain requires."""
        return (
            *(self.return_name(k) for k in self.return_periods if k != 1),
            self.volatility,
            self.volume_ratio,
            *(self.ma_ratio(n) for n in self.ma_windows),
            self.fx_return,
            self.benchmark_return,
            self.future_return,
            self.future_benchmark_return,
        )

    @property
    def base_columns(self) -> tuple[str, ...]:
        c = self.cols
        return (c.time, c.entity, c.price, self.future_return,
                self.future_benchmark_return, self.label)


NOTEBOOK = FeatureConfig()
# The script chain does not dedupe: rows of one date are ordered by file and place in it.
LOCAL = FeatureConfig(cols=PanelColumns(ties=("source_file", "source_block", "source_row", "close", "volume")),
                      required=("date", "ticker", "close", "bist100"), gold_rule="required",
                      extra_cols=("bist100", "return_1d"))
PRESETS = {"notebook": NOTEBOOK, "local": LOCAL}
