"""Synthetic listings, one per input id, deterministic for a seed.

Every random choice is a 32-bit mix of the row's id, the seed and the choice's
number, modulo n: whole-number arithmetic that other engines have too and that
stays in generated code.  The output does not depend on partitioning or task
retries (unlike a stateful random generator), and generation runs fully in
parallel.  Categorical columns draw uniformly from weighted slot lists, so a
value listed k times is k times as likely.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyfold.schema import LISTING_COLUMNS

# Fixed values of the listing generator (choices and weighted slot lists).
TITLES = [
    "高层朝南2房，拎包入住，采光充足，进岛首站",
    "精装两室一厅，采光良好，地段优越",
    "南北通透三室两厅，拎包入住",
    "两房一厅，经典户型，环境优美",
    "小区绿化好，环境优美，物业管理也很规范",
    "自住装修，采光通风好，视野好，进岛方便，高楼层看海",
    "此房朝南通透格局，楼层好视野宽阔，居住环境舒适",
    "高层边套，景观视野良好，格局方正，采光好",
]
FLOOR_LEVELS = ["低楼层", "中楼层", "高楼层"]
ORIENTATIONS = ["南", "北", "东", "西", "东南", "西南", "东北", "西北"]
DECORATIONS = ["精装", "简装", "毛坯"]
COMMUNITY_SLOTS = [
    "东坑安居房", "禹洲卢卡小镇", "东坑安居房", "东坑安居房", "滨水二里", "黄金大厦",
    "禹洲卢卡小镇", "禹洲大学城", "禹洲大学城", "桃源大厦", "上东美地", "恒丰花园",
    "恒丰花园", "恒丰花园", "海晟维多利亚", "厦门中央公园", "莲花尚院",
]
DISTRICT_SLOTS = ["海沧", "海沧", "海沧", "翔安", "集美", "集美", "湖里", "同安", "同安", "思明"]
NEIGHBORHOOD_SLOTS = [
    "滨海社区", "滨海社区", "滨海社区", "新店", "集美新城", "杏林桥头", "杏林桥头",
    "翔安新城", "邮轮城", "邮轮城", "江头", "瑞景", "南山路",
]
ELEVATOR = ["有", "无"]
# Row target of the reference generator: 200 MiB at about 2 KiB per row.
DEFAULT_ROWS = (200 * 1024 * 1024) // (2 * 1024)


_MASK = 0xFFFFFFFF
_STEP = 0x9E3779B9  # parts the choices of a row


def _mixed(x: Column) -> Column:
    """A bijective mix of 32 bits, held in a long; no product reaches 2**63."""
    x = x.bitwiseXOR(F.shiftright(x, 16)) * F.lit(0x21F0AAAD)
    x = x.bitwiseAND(F.lit(_MASK))
    x = x.bitwiseXOR(F.shiftright(x, 15)) * F.lit(0x735A2D97)
    x = x.bitwiseAND(F.lit(_MASK))
    return x.bitwiseXOR(F.shiftright(x, 15))


def row_number32(id_col: Column, seed: int) -> Column:
    """The row's 32 mixed bits, from both halves of its id and the seed."""
    low = id_col.bitwiseAND(F.lit(_MASK)).bitwiseXOR(F.lit(seed & _MASK))
    high = F.shiftright(id_col, 32).bitwiseAND(F.lit(_MASK))
    return _mixed(_mixed(low).bitwiseXOR(high))


def _draw(row: Column, salt: int, n: int) -> Column:
    return _mixed(row.bitwiseXOR(F.lit(salt * _STEP & _MASK))) % F.lit(n)


def _pick(row: Column, salt: int, values: list[str]) -> Column:
    arr = F.array(*[F.lit(v) for v in values])
    return F.element_at(arr, (_draw(row, salt, len(values)) + 1).cast("int"))


def _num(row: Column, salt: int, n: int, base: int = 0) -> Column:
    return (_draw(row, salt, n) + base).cast("string")


def synth_listings(ids: DataFrame, id_col: str = "id", seed: int = 42,
                   date: str | None = "2024-12-01",
                   url_base: str = "https://example.com/listing/") -> DataFrame:
    """One synthetic listing per row of ``ids`` (columns as the listing layout).

    ``date`` fills both date columns; ``None`` renders today's date as
    ``yyyy-MM-dd`` (P19), at the price of run-to-run determinism.
    """
    r = F.col("_row")
    d = F.lit(date) if date is not None else F.date_format(F.current_date(), "yyyy-MM-dd")
    level = _pick(r, 7, FLOOR_LEVELS)
    cols = {
        "id": F.col("_id"),
        "title": _pick(r, 1, TITLES),
        "url": F.concat(F.lit(url_base), _num(r, 2, 1_000_000, 1_000_000_000)),
        "price": F.concat(_num(r, 3, 50, 50), F.lit("万元")),
        "unit_price": F.concat(_num(r, 4, 30_000), F.lit("元/平")),
        "focus": _draw(r, 5, 1000).cast("int"),
        "layout": F.concat(_num(r, 6, 5, 1), F.lit("室"), _num(r, 17, 3, 1), F.lit("厅")),
        "floor": F.concat(level, F.lit("/共"), _num(r, 18, 20, 10), F.lit("层")),
        "orientation": _pick(r, 8, ORIENTATIONS),
        "decoration": _pick(r, 9, DECORATIONS),
        "area": F.concat(_num(r, 10, 80, 50), F.lit("平米")),
        "year_built": F.concat(F.lit("20"), _num(r, 11, 10, 10), F.lit("年建")),
        "community": _pick(r, 12, COMMUNITY_SLOTS),
        "district": _pick(r, 13, DISTRICT_SLOTS),
        "neighborhood": _pick(r, 14, NEIGHBORHOOD_SLOTS),
        "elevator": _pick(r, 15, ELEVATOR),
        "elevator_ratio": F.concat(_num(r, 16, 2, 1), F.lit("梯"), _num(r, 19, 6, 1),
                                   F.lit("户")),
        "post_date": d,
        "update_date": d,
    }
    rows = ids.select(F.col(id_col).cast("long").alias("_id")).select("_id", row_number32(F.col("_id"), seed).alias("_row"))
    return rows.select(*[cols[c].alias(c) for c in LISTING_COLUMNS])


def synth_listings_range(spark: SparkSession, n: int = DEFAULT_ROWS, seed: int = 42,
                         partitions: int | None = None, **kw) -> DataFrame:
    """``n`` synthetic listings with ids 0..n-1 (for scaling runs)."""
    ids = spark.range(0, int(n), 1, partitions) if partitions else spark.range(int(n))
    return synth_listings(ids, "id", seed, **kw)


def to_listing_lines(listings: DataFrame) -> DataFrame:
    """Listing rows -> quoted CSV ``value`` lines in the listing layout."""
    q = [F.concat(F.lit('"'), F.col(c).cast("string"), F.lit('"')) for c in LISTING_COLUMNS]
    return listings.select(F.concat_ws(",", *q).alias("value"))

