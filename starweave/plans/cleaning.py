"""Clean, recode and split flat declaration records.

Order of steps follows the reference script: drop unused columns, drop rows
without an end date, fill NULLs with a marker, add the synthetic measure,
parse begin/end strictly, derive the duration, re-render dates, recode small
code lists and the large code table, rename, then split exactly 80:20.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starweave.functions.dates import ISO_Z, date_text, elapsed_days, parse_ts
from starweave.functions.hashing import hash_mod
from starweave.operators.clean import drop_columns, drop_null_keys, fill_unknown, recode, recode_lookup, synthetic_int
from starweave.operators.split import split_flag


# Fixed values (defaults below): NULL marker 'unknown', seed 1, synthetic
# measure in [0, 10000), zero-day durations imputed as 1..24 hours, ISO
# timestamps 'yyyy-MM-ddTHH:mm:ssZ', dates re-rendered 'yyyy-MM-dd', 20 % test
# share, column fips renamed country_name.


@dataclass(frozen=True)
class CleanConfig:
    row_key: tuple[str, ...]
    drop: tuple[str, ...] = ()
    required: tuple[str, ...] = ("incident_end_date",)
    fill_value: str = "unknown"
    seed: int = 1
    measure: str = "deaths"
    measure_range: tuple[int, int] = (0, 10000)
    begin: str = "incident_begin_date"
    end: str = "incident_end_date"
    duration: str = "incident_duration"
    lenient_dates: tuple[str, ...] = ("declaration_date",)
    ts_format: str = ISO_Z
    recodes: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    lookup_col: str | None = "fips"
    renames: Mapping[str, str] = field(default_factory=lambda: {"fips": "country_name"})
    test_fraction: float = 0.2
    flag: str = "is_test"


def clean_declarations(raw: DataFrame, cfg: CleanConfig, lookup: DataFrame | None = None) -> DataFrame:
    """Processed records with an exact-split flag column (``cfg.flag``)."""
    df = drop_columns(raw, [c for c in cfg.drop if c not in cfg.row_key])
    df = drop_null_keys(df, cfg.required)
    # the flag needs the row key only: it is set before any join, so the key table is a narrow scan
    df = split_flag(df, list(cfg.row_key), cfg.test_fraction, cfg.seed, cfg.flag)
    value_cols = [c for c in df.columns if c not in cfg.row_key and c != cfg.flag]
    df = fill_unknown(df, value_cols, cfg.fill_value)
    lo, hi = cfg.measure_range
    df = synthetic_int(df, cfg.measure, lo, hi, cfg.seed, cfg.row_key)

    b = parse_ts(cfg.begin, cfg.ts_format, strict=True)
    e = parse_ts(cfg.end, cfg.ts_format, strict=True)
    days = elapsed_days(b, e)
    imputed = F.lit(1) + hash_mod(cfg.seed, cfg.duration, 24, *cfg.row_key)
    df = df.withColumn(cfg.duration, F.when(days == 0, imputed).otherwise(days * 24).cast("int"))
    df = df.withColumns({cfg.begin: date_text(b), cfg.end: date_text(e)})
    for c in cfg.lenient_dates:
        df = df.withColumn(c, date_text(parse_ts(c, cfg.ts_format)))

    for col, mapping in cfg.recodes.items():
        df = recode(df, col, mapping)
    if lookup is not None and cfg.lookup_col:
        df = recode_lookup(df, cfg.lookup_col, lookup)
    df = df.withColumnsRenamed(dict(cfg.renames))
    return df.drop(*[c for c in cfg.row_key if c in cfg.drop])
