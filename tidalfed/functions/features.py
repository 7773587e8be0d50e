"""Features, keys, labels and time stamps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidalfed import settings as S

ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def zscore(voltage: str | Column, current: str | Column, *, v_mean: float = S.VOLTAGE_MEAN,
           v_std: float = S.VOLTAGE_STD, i_mean: float = S.CURRENT_MEAN,
           i_std: float = S.CURRENT_STD, power_scale: float | None = None) -> list[Column]:
    """Normalized voltage, current and power.

    Power is centred on the product of the means and divided by ``power_scale``, by
    default the product of the two spreads.
    """
    v, i = _col(voltage), _col(current)
    scale = v_std * i_std if power_scale is None else power_scale
    return [
        (v - F.lit(v_mean)) / F.lit(v_std),
        (i - F.lit(i_mean)) / F.lit(i_std),
        (v * i - F.lit(v_mean * i_mean)) / F.lit(scale),
    ]


def shift_scale(columns: Sequence[str | Column] = S.MACHINE_FEATURES,
                shift: Sequence[float] = S.MACHINE_SHIFT,
                scale: Sequence[float] = S.MACHINE_SCALE) -> list[Column]:
    """``(x - shift) / scale`` for each feature."""
    if not len(columns) == len(shift) == len(scale):
        raise ValueError("columns, shift and scale differ in length")
    return [(_col(c) - F.lit(float(a))) / F.lit(float(b))
            for c, a, b in zip(columns, shift, scale)]


def power(voltage: str | Column, current: str | Column, digits: int = 2) -> Column:
    """Power with fixed decimals; halves round away from zero."""
    return F.round(_col(voltage) * _col(current), digits)


def anomaly_type(voltage: str | Column, current: str | Column, *,
                 overvoltage: float = S.OVERVOLTAGE, undervoltage: float = S.UNDERVOLTAGE,
                 overcurrent: float = S.OVERCURRENT, surge_voltage: float = S.SURGE_VOLTAGE,
                 surge_current: float = S.SURGE_CURRENT) -> Column:
    """Name the kind of anomaly a reading shows; the first rule that holds decides."""
    v, i = _col(voltage), _col(current)
    return (
        F.when(v >= overvoltage, "overvoltage")
        .when(v <= undervoltage, "undervoltage")
        .when(i >= overcurrent, "overcurrent")
        .when((v >= surge_voltage) & (i >= surge_current), "power_surge")
        .otherwise("normal")
    )


def status_label(label: str | Column) -> Column:
    return F.when(_col(label) == 1, "ANOMALY").otherwise("NORMAL")


def with_default(column: str | Column, default) -> Column:
    """Value of an optional message field."""
    return F.coalesce(_col(column), F.lit(default))


def iso_text(timestamp: str | Column) -> Column:
    """Zone-aware ISO text of a timestamp."""
    return F.date_format(_col(timestamp), ISO_FORMAT)


def iso_time(text: str | Column) -> Column:
    """Timestamp of an ISO text, with or without a zone; null when it cannot be read."""
    return F.try_to_timestamp(_col(text))


def stamped(rows: DataFrame, name: str = "fog_timestamp") -> DataFrame:
    """Add the time of processing, the same for all rows of a batch."""
    return rows.withColumn(name, F.current_timestamp())


def prefixed_key(prefix: str, value: str | Column) -> Column:
    """Message key such as ``round_7``, ``node_2``, ``fog_node_1``."""
    return F.concat(F.lit(f"{prefix}_"), _col(value).cast("string"))


def machine_topic(node_id: str | Column) -> Column:
    """Topic of a machine node: the first node has its own, all others share one."""
    return F.when(_col(node_id) == 1, S.MACHINE_TOPICS[1]).otherwise(S.MACHINE_TOPICS[2])


def _col(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column
