"""Table schemas, with units as field metadata; features and support follow the configuration."""

from __future__ import annotations

from pyspark.sql import types as T

from tidegrid.config import FeatureConfig, digest
from tidegrid.operators.features import AGES, feature_names

_L, _D, _B, _S, _I, _H = T.LongType(), T.DoubleType(), T.BooleanType(), T.StringType(), T.IntegerType(), T.ShortType()
SHARES = T.DecimalType(38, 9)


def _field(name: str, kind: T.DataType, nullable: bool = True, unit: str | None = None) -> T.StructField:
    return T.StructField(name, kind, nullable, {"unit": unit} if unit else {})


KEYS = [_field("session_date", _S, False), _field("symbol", _S, False), _field("interval_end_ns", _L, False, "ns")]

VENDOR_TRADES = T.StructType([
    _field("conditions", T.ArrayType(_L)), _field("correction", _L), _field("decimal_size", _S), _field("exchange", _L), _field("id", _S), _field("participant_timestamp", _L, unit="ns"),
    _field("price", _D, unit="USD"), _field("sequence_number", _L), _field("sip_timestamp", _L, unit="ns"), _field("size", _D, unit="shares"), _field("tape", _L), _field("trf_id", _L), _field("trf_timestamp", _L, unit="ns"),
])
VENDOR_QUOTES = T.StructType([
    _field("ask_exchange", _L), _field("ask_price", _D, unit="USD"), _field("ask_size", _D), _field("bid_exchange", _L), _field("bid_price", _D, unit="USD"), _field("bid_size", _D),
    _field("conditions", T.ArrayType(_L)), _field("indicators", T.ArrayType(_L)), _field("participant_timestamp", _L, unit="ns"), _field("sequence_number", _L), _field("sip_timestamp", _L, unit="ns"), _field("tape", _L), _field("trf_timestamp", _L, unit="ns"),
])

BASE = T.StructType([
    *KEYS,
    *[_field(f"{k}_twap_usd", _D, unit="USD") for k in ("bid", "ask", "midpoint")], _field("price_valid_duration_ns", _L, False, "ns"), _field("price_twap_reason_mask", _I, False),
    _field("bid_end_usd", _D, unit="USD"), _field("ask_end_usd", _D, unit="USD"), _field("price_end_reason_mask", _I, False),
    _field("spread_integral_bps_seconds", _D, unit="bps*s"), _field("spread_valid_duration_ns", _L, False, "ns"), _field("spread_integral_reason_mask", _I, False),
    *[f for s in ("bid", "ask") for f in (_field(f"{s}_size_integral_shares_seconds", _D, unit="shares*s"), _field(f"{s}_size_valid_duration_ns", _L, False, "ns"), _field(f"{s}_size_integral_reason_mask", _I, False))],
    *[f for s in ("bid", "ask") for f in (_field(f"{s}_size_end_shares", _D, unit="shares"), _field(f"{s}_size_end_reason_mask", _I, False))],
    _field("trade_count_1s", _L), _field("share_volume_1s", SHARES, unit="shares"), _field("dollar_volume_1s_usd", _D, unit="USD"), _field("activity_valid_duration_ns", _L, False, "ns"), _field("activity_reason_mask", _I, False),
    *[f for a in AGES for f in (_field(f"{a}_age_seconds", _D, unit="s"), _field(f"{a}_age_reason_mask", _I, False))],
    _field("midpoint_age_status", _H, False), _field("midpoint_observation_start_ns", _L, unit="ns"), _field("midpoint_age_lower_bound_seconds", _D, unit="s"),
    *[f for s in ("quote", "trade") for f in (
        _field(f"{s}_source_status", _H, False), _field(f"{s}_observed_duration_ns", _L, False, "ns"), _field(f"{s}_continuity_id", _L, False), _field(f"{s}_continuity_break_in_second", _B, False),
    )],
    _field("halt_active", _B, False), _field("halt_id", _S),
])


def features_schema(config: FeatureConfig = FeatureConfig()) -> T.StructType:
    names = feature_names(config)
    return T.StructType([*KEYS, *[_field(n, _D, unit=u) for n, u, _, _ in names], *[_field(f"{n}_reason_mask", _I, False) for n, *_ in names]])


def support_schema(config: FeatureConfig = FeatureConfig()) -> T.StructType:
    fields = list(KEYS)
    for v in config.views:
        fields += [_field(f"return_{k}_weight_hl{v.half_life}s", _D, False) for k in ("usable", "possible")]
        fields += [_field(f"{f}_{k}_exposure_seconds_hl{v.half_life}s", _D, False, "s") for f in ("spread", "activity", "bid_size", "ask_size") for k in ("usable", "possible")]
    fields += [_field(f"{s}_ew_startup_elapsed_seconds", _L, False, "s") for s in ("quote", "trade")]
    return T.StructType(fields + [_field(f"{a}_age_{k}_window{w}s", _I, False) for w in config.age_windows for a in AGES for k in ("sample_count", "elapsed_slots")])


def schema_identity(schema: T.StructType) -> str:
    return digest(schema.jsonValue())


def named(df, schema: T.StructType):
    """``df``'s columns of a schema, in its order, types and metadata."""
    from pyspark.sql import functions as F

    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name, metadata=f.metadata) for f in schema.fields])
