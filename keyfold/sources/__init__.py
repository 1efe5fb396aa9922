"""Sources: text lines (S1), Kafka (S3), JDBC (S4), synthetic listings (S5),
and the renderers that turn the driver's tables into report input lines."""

from keyfold.sources.text import (  # noqa: F401
    number_lines, read_lines, read_numbered_lines, stream_lines, with_arrival_order, with_place,
)
