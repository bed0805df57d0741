"""Property tests: column expressions vs a Python model of the Java rules."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventlake.functions.text import csv_fields, java_bool, java_int, java_long


def java_split(s: str, d: str = ","):
    parts = s.split(d)
    if s == "":
        return [""]
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def java_int_model(s, lo=-2**31, hi=2**31 - 1):
    if s is None:
        return None
    body = s[1:] if s[:1] in "+-" else s
    if not body or not all(c in "0123456789" for c in body):
        return None
    v = int(s)
    return v if lo <= v <= hi else None


TEXT = st.text(alphabet=list("0123456789+-, abx"), max_size=24)


@settings(max_examples=15, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=40))
def test_csv_fields_and_numbers_match_java_rules(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    rows = df.select("s", csv_fields(F.col("s")).alias("f"), java_int(F.col("s")).alias("i"),
                     java_long(F.col("s")).alias("l"), java_bool(F.col("s")).alias("b")).collect()
    for r in rows:
        assert r.f == java_split(r.s), r.s
        assert r.i == java_int_model(r.s), r.s
        assert r.l == java_int_model(r.s, -2**63, 2**63 - 1), r.s
        assert r.b is (r.s.lower() == "true")
