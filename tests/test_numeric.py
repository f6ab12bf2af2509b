"""Text to whole numbers."""

import re

from pyspark.sql import functions as F

from tidemark.functions.numeric import lenient_int

TEXTS = [
    "1", "1.5", " 1.5 ", "\t1.5", "1.5\n", "+.5", "-.5", ".", "+.", "-.", "-", "+", "", "  ", " 7 ", "1e3", "1.5e3", "99999999999", "99999999999.5",
    "2147483647.9", "2147483648.1", "-2147483648.2", "-2147483649.0", "00012.3", "-0.9", "1.2.3", "--1.0", "1 .5", "٣.٥", "NaN", "1.5d", None, "+12.",
]


def expected(text):
    """Blanks around are cut off; digits before a point count, none as 0; 32 bits."""
    found = re.match(r"^([+-]?)([0-9]*)(\.[0-9]*)?\n?$", (text or "").strip(" "))
    if not found or not (found[2] or found[3]):
        return None
    number = int(f"{found[1]}0{found[2]}")
    return number if -(2**31) <= number < 2**31 else None


def test_fractions_are_cut_off_and_the_rest_is_null(spark):
    rows = spark.createDataFrame([(t,) for t in TEXTS], "t string").select("t", lenient_int(F.col("t")).alias("n")).collect()
    assert {r.t: r.n for r in rows} == {t: expected(t) for t in TEXTS}


def test_fractions_reach_no_cast_that_fails(spark):
    rows = spark.createDataFrame([("1.5",)], "t string").select(lenient_int(F.col("t")).alias("n"))
    plan = rows._jdf.queryExecution().analyzed().toString()
    # The text as it came is cast in the branch for texts without a point only.
    assert re.search(r"CASE WHEN Contains\(t#\d+, \.\)", plan) and plan.index("ELSE try_cast(t#") > plan.index("Contains(")
    assert plan.count("try_cast(t#") == 1
