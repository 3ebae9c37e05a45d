"""Output shape shared by a query and its oracle: same columns, doubles rounded."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, functions as F, types as T

# Price levels keep four decimals, everything else six. The cut lies off the middle,
# so a decimal price that falls exactly between two steps rounds alike in both engines.
_CUT = 0.41421356
_LEVEL = re.compile(r"price|^ma_\d+$|per_unit|average|^mean$|_sum$|^max$")


def _scale(name: str) -> float:
    return 1e4 if _LEVEL.search(name) and "ratio" not in name and "return" not in name else 1e6


# Names of double columns; the tests compare this rule with the real schemas.
_DOUBLE = re.compile(
    r"(_price(_raw|_adjusted)?$|^price_(before|after|factor|to_ma\d+)$|_return(_raw|_adjusted_price|_economic|_pct)?$"
    r"|^return_\d+d|^ma_\d+|^volatility_|^trades_(avg|ratio|median|vs)|^return_spread|_ratio$|_rate(_train)?$|_share$"
    r"|^ma_ratio|per_unit(_raw|_adjusted)?$|_multiplier$|_factor$|_relative_error$|_threshold$|threshold_pct$|^threshold$"
    r"|_score$|^score$|_mean$|^mean|_median$|^median|_std$|^std|^p\d\d$|^q\d\d$|^min$|^max$|_min$|_max$|^smd$|^abs_smd$"
    r"|_p\d\d$|_delta$|^delta$|_value$|^mae|^rmse|^r2|accuracy|_lift$|_lift_(mean|median)$|^prediction|_error$"
    r"|^economic_curve|^cumulative_economic|^target_price_next|^target_price_raw$|^target_(price_)?return_next"
    r"|^target_economic_vs|_growth_factor$|_effect$|^return_difference$|^absolute_|variation(_pct)?$|^price_range"
    r"|^price_volatility|^max_abs|^trimmed_mean$|^original_mean$|^min_target$|^share_|_pct$|^share$)")
_NOT_DOUBLE = re.compile(
    r"^(attribute_value$|flag_|has_|is_|informational_|detected_|confirmed_in_kind_asset)|(_count|_rows|_date|_class|_folds|_session_index|_semantics|_version"
    r"|_source|_status|_status_on_date|_days|_sessions|_match|_target_min|_target_max)$|^abs_ge_|^large_"
    r"|^validation_target_(min|max)$|^train_target_max$|^price_quality")


def is_double(name: str) -> bool:
    return bool(_DOUBLE.search(name)) and not _NOT_DOUBLE.search(name)


def pick(df: DataFrame, columns: list[str]) -> DataFrame:
    """Select the columns; doubles are cut to a fixed number of decimals."""
    kinds = {f.name: f.dataType for f in df.schema}
    return df.select(*[
        (F.floor(F.col(c) * _scale(c) + _CUT).cast("double") / _scale(c)).alias(c)
        if isinstance(kinds[c], (T.DoubleType, T.FloatType)) else F.col(c) for c in columns])


def select_list(columns: list[str]) -> str:
    return ", ".join(
        f"floor({c} * {_scale(c):g}::DOUBLE + {_CUT}::DOUBLE) / {_scale(c):g}::DOUBLE AS {c}" if is_double(c) else c
        for c in columns)
