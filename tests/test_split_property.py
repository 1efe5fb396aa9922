"""The linear quote-aware split equals the defining lookahead regex split."""

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from keyfold.functions.text import QUOTE_AWARE_COMMA, quote_split, plain_split

LINES = st.lists(st.text(alphabet='a,"b \t，', max_size=16), min_size=1, max_size=300)


@settings(max_examples=5, deadline=None)
@given(LINES)
def test_quote_split_matches_regex(spark, lines):
    lines = lines + ["", ",", '"', '","', "a,", ",a", '"a,b","c"', 'a"b,c"d', '"a""b",x']
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    diff = df.select(quote_split("value").alias("fast"),
                     F.split("value", QUOTE_AWARE_COMMA).alias("slow")) \
        .filter(F.col("fast") != F.col("slow"))
    assert diff.count() == 0


def test_plain_split_removes_quotes_first(spark):
    df = spark.createDataFrame([('"City, Hotel",1',)], "value string")
    assert df.select(plain_split("value").alias("f")).first().f == ["City", " Hotel", "1"]


FIELD = st.text(alphabet='ab ,，\t\x01梯户0123456789元/平"', max_size=8)


@settings(max_examples=4, deadline=None)
@given(st.lists(st.lists(FIELD, min_size=17, max_size=21), min_size=1, max_size=200))
def test_csv_fast_path_equals_exact_split(spark, rows):
    from keyfold.operators.parse import parse_listings
    lines = []
    for fields in rows:
        lines.append(",".join(f'"{x}"' for x in fields))          # all quoted (fast path if no inner quote)
        lines.append(",".join(fields))                             # unquoted
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    fast = parse_listings(df, on_bad="null", keep_line=True, price_type="string")
    exact = parse_listings(df, on_bad="null", keep_line=True, price_type="string", csv_fast_path=False)
    assert fast.exceptAll(exact).count() == 0 and exact.exceptAll(fast).count() == 0
