"""Column expressions shared by the batch and the streaming programs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from flowlab.schema import FIN_OR_RST, TCP, UDP


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def number(c: str | Column) -> Column:
    """Text or number to double; unparsable becomes NULL."""
    return col(c).try_cast("double")


def finite(c: str | Column) -> Column:
    """NaN and infinities become NULL."""
    value = col(c)
    infinite = F.abs(value) == F.lit(float("inf"))
    return F.when(~(F.isnan(value) | infinite), value)


def or_zero(c: str | Column) -> Column:
    return F.coalesce(col(c), F.lit(0.0))


def at_least(c: str | Column, bound) -> Column:
    """Lower bound that keeps NULL (``greatest`` alone would skip it)."""
    value = col(c)
    return F.when(value.isNotNull(), F.greatest(value, F.lit(bound)))


def at_most(c: str | Column, bound) -> Column:
    value = col(c)
    return F.when(value.isNotNull(), F.least(value, F.lit(bound)))


def ratio(numerator: str | Column, denominator: str | Column, instead=1.0) -> Column:
    """Division in which a zero denominator counts as ``instead``."""
    d = col(denominator).cast("double")
    return col(numerator).cast("double") / F.when(d == 0.0, F.lit(instead)).otherwise(d)


def swapped(src_ip="src_ip", src_port="src_port", dst_ip="dst_ip", dst_port="dst_port") -> Column:
    """Is the source the larger endpoint? Addresses compare as strings."""
    s, d = col(src_ip), col(dst_ip)
    return (s > d) | ((s == d) & (col(src_port) > col(dst_port)))


def closes_flow(tcp_flags="tcp_flags", protocol="protocol") -> Column:
    """A FIN or RST packet of a TCP flow."""
    flagged = col(tcp_flags).bitwiseAND(F.lit(FIN_OR_RST)) != 0
    return F.coalesce(flagged & (col(protocol) == TCP), F.lit(False))


def header_bytes(protocol="protocol", tcp_data_offset="tcp_data_offset") -> Column:
    """IP header plus the transport header (data offset in 32-bit words)."""
    p = col(protocol)
    return (
        F.when(p == TCP, F.lit(20) + col(tcp_data_offset) * 4)
        .when(p == UDP, F.lit(28))
        .otherwise(F.lit(20))
        .cast("long")
    )


def protocol_text(protocol="protocol") -> Column:
    p = col(protocol)
    return F.when(p == TCP, "TCP").when(p == UDP, "UDP").otherwise(p.cast("string"))


def endpoint_text() -> Column:
    """``src:port → dst:port (PROTO)`` of a flow."""
    return F.concat(
        F.col("a_ip"), F.lit(":"), F.col("a_port").cast("string"), F.lit(" → "),
        F.col("b_ip"), F.lit(":"), F.col("b_port").cast("string"),
        F.lit(" ("), protocol_text(), F.lit(")"),
    )


def key_text() -> Column:
    """The flow key as one text."""
    return F.concat_ws(
        ",", "a_ip", "b_ip", F.col("a_port").cast("string"),
        F.col("b_port").cast("string"), F.col("protocol").cast("string"),
    )


def iso_time(epoch_seconds: str | Column) -> Column:
    micros = F.round(col(epoch_seconds) * 1e6).cast("long")
    return F.date_format(F.timestamp_micros(micros), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def snake(name: str) -> str:
    return name.strip().lower().replace(" ", "_")
